"""The published parameters of the strategy, monitor and sources."""

# Sizing and trading.
BANKROLL_USD = 5000.0
KELLY_FRACTION = 0.3
KELLY_CAP = 0.025
FEE_RATE = 0.02
EDGE_THRESHOLD = 0.02
PROB_FLOOR = 1e-4

# Supervised dataset.
SEQ_LEN = 14
VAL_FRAC = 0.15
TEST_FRAC = 0.2
FEATURES = ["tmax_f", "tmin_f", "humidity", "wind_mph", "doy_sin", "doy_cos"]
LAKE_REQUIRED = ["tmax_lag1", "tmax_lag2", "tmax_lag3", "tmax_roll7", "normal_30"]

# Models and calibration.
GD_RATE = 0.05
GD_EPOCHS = 300
PLATT_REG = 10.0
FORECAST_STD_F = 7.0

# Parameter search.
N_WEIGHTS = 9
N_THRESHOLDS = 12
THRESHOLD_LO = 0.005
THRESHOLD_HI = 0.04
MIN_TRADES = 3

# Contract prices.
PRICE_LO = 0.02
PRICE_HI = 0.98
NAIVE_SPREAD = 0.06
INFORMED_SLOPE = 0.22
INFORMED_SHRINK = 0.92
INFORMED_NOISE = 0.02

# Quote monitor.
MIN_SPREAD_PCT = 0.0005
SIGNALS_KEPT = 200
LATENCY_SAMPLES = 8192
TICK_NS = 1_000_000_000
TOPIC_PREFIX = "book."

# Sources.
MIN_SOURCE_ROWS = 400
MIN_LAKE_ROWS = 100
NEUTRAL_HUMIDITY = 60.0
NEUTRAL_WIND_MPH = 8.0
LISTING_LIMIT = 20
LISTING_WORDS = ["temp", "weather", "high", "rain", "snow"]
CHUNK_DAYS = 366
STATION_IDS = {
    "KNYC": "GHCND:USW00094728",
    "KORD": "GHCND:USW00094846",
    "KMIA": "GHCND:USW00012839",
    "KLAX": "GHCND:USW00023174",
}

# Block sizes of the ordered operators (see operators/blocks.py). A block is the most one
# task must hold of a key; the block table has one row per key and block.
DAY_BLOCK = 1024
SEQ_BLOCK = 65536
