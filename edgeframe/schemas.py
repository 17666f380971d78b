"""One declared schema per record shape; every reader takes one of these."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
}


def record(**columns: str | T.DataType) -> T.StructType:
    """A schema from column names and type names (or types)."""
    return T.StructType(
        [T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in columns.items()]
    )


RAW_WEATHER = record(
    station="string", date="date", tmax_f="double", tmin_f="double", humidity="double",
    wind_mph="double",
)
CONTRACT_WEATHER = T.StructType(
    RAW_WEATHER.fields
    + record(label_high="int", market_yes_price="double", threshold_f="double").fields
)
OBSERVATION = record(station="string", date="string", datatype="string", value="double")
LISTING = record(
    markets=T.ArrayType(record(title="string", ticker="string", status="string"))
)
LAKE = T.StructType(
    RAW_WEATHER.fields
    + record(
        tmax_lag1="double", tmax_lag2="double", tmax_lag3="double", tmin_lag1="double",
        humidity_lag1="double", wind_lag1="double", tmax_roll7="double", tmax_roll30="double",
        doy="int", month="int", year="int", doy_sin="double", doy_cos="double",
        normal_30="double", target_high_f="double", label_high="int",
        market_yes_price="double", threshold_f="double",
    ).fields
)
QUOTE = record(
    venue="string", market="string", yes_bid="double", yes_ask="double", seq="long",
    ts_ns="long",
)
MESSAGE = record(topic="string", payload="string", recv_ns="long")
SIGNAL = record(
    market="string", buy_venue="string", sell_venue="string", buy_price="double",
    sell_price="double", spread_pct="double", latency_us="long", ts_ns="long",
)
ENGINE_STATS = record(
    started_at_ns="long", uptime_seconds="double", messages_processed="long",
    arb_opportunities="long", trades_executed="long", latency_us_p50="double",
    latency_us_p99="double", msgs_per_sec="double", uptime_pct="double",
)
FORECAST = record(
    city="string", market="string", target_date="string", threshold_f="double",
    lstm_prob="double", transformer_prob="double", ensemble_prob="double",
    predicted_high_f="double", ts_ns="long",
)
ODDS = record(
    market="string", model_prob="double", market_prob="double", edge="double",
    fair_yes_price="double", ts_ns="long",
)
SIZING = record(
    market="string", side="string", edge="double", kelly_fraction_full="double",
    kelly_fraction_used="double", stake_usd="double", bankroll_usd="double", ts_ns="long",
)
BACKTEST = record(
    n_trades="long", avg_edge="double", hit_rate="double", monthly_roi="double",
    total_return="double", max_drawdown="double", sharpe="double", final_bankroll="double",
    window_start="string", window_end="string",
    backends=T.MapType(T.StringType(), T.StringType()), opt_method="string",
    weight_lstm="double", edge_threshold="double",
)
STATUS = record(stage="string", detail="string", ts="double")
