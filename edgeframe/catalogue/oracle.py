"""The same queries in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

from edgeframe.fixtures import SQL as FIXTURE
from edgeframe.fixtures import VENUES

OBS, LONG, PREDS = FIXTURE["obs_daily"], FIXTURE["obs_long"], FIXTURE["preds"]
QUOTES, MARKETS = FIXTURE["quotes"], FIXTURE["markets"]
HOUR_NS = 3_600_000_000_000
FEATURES = ["tmax_f", "tmin_f", "humidity", "wind_mph", "doy_sin", "doy_cos"]


def r(expr: str, name: str) -> str:
    return f"floor(({expr}) * 1e6 + 0.5e0) / 1e6 as {name}"


def rs(*names: str) -> str:
    return ", ".join(r(n, n) for n in names)


def half_up(expr: str, places: int) -> str:
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38, 20)), {places}) as double)"


# --- features -----------------------------------------------------------------------

_LAGGED = f"""
    obs as ({OBS}),
    lagged as (
        select *, lag(tmax_f, 1) over w as tmax_lag1, lag(tmax_f, 2) over w as tmax_lag2,
               lag(tmax_f, 3) over w as tmax_lag3, lag(tmin_f, 1) over w as tmin_lag1,
               lag(humidity, 1) over w as humidity_lag1, lag(wind_mph, 1) over w as wind_lag1,
               avg(tmax_f) over (w rows between 7 preceding and 1 preceding) as tmax_roll7,
               avg(tmax_f) over (w rows between 30 preceding and 1 preceding) as tmax_roll30,
               count(*) over (w rows between 30 preceding and 1 preceding) as n30
        from obs window w as (partition by station order by date))"""

_DOY = "dayofyear(date)"


def _u(part: int) -> str:
    start = 1 + 13 * part
    text = f"md5(station || '|' || cast(date as varchar))"
    return f"(cast(cast('0x' || substr({text}, {start}, 13) as bigint) as double) / 4503599627370496e0)"


_NAIVE = half_up(f"least(greatest(0.5e0 + ({_u(0)} - 0.5e0) * 0.06e0, 0.02e0), 0.98e0)", 4)
_INFORMED = "0.5e0 + 0.92e0 * (1e0 / (1e0 + exp(-(0.22e0 * (tmax_roll7 - tmax_roll30)))) - 0.5e0)"
_NOISE = f"sqrt(-2e0 * ln(1e0 - {_u(0)})) * cos(2e0 * pi() * {_u(1)})"

_LAKE = f"""{_LAGGED},
    lake as (
        select *, tmax_roll30 as normal_30, tmax_f as target_high_f,
               sin(2e0 * pi() * {_DOY} / 365e0) as doy_sin,
               cos(2e0 * pi() * {_DOY} / 365e0) as doy_cos,
               cast(year(date) as integer) as year,
               cast(tmax_f > tmax_roll30 as integer) as label_high,
               {half_up("tmax_roll30", 2)} as threshold_f,
               {_NAIVE} as market_yes_price,
               row_number() over (partition by station order by date) - 1 as pos,
               count(*) over (partition by station) as n
        from lagged where tmax_lag3 is not null)"""


def _price(expr: str) -> str:
    clipped = half_up(f"least(greatest({expr}, 0.02e0), 0.98e0)", 4)
    return f"""with {_LAGGED} select station, date, {r(clipped, "market_yes_price")}
        from lagged where n30 = 30"""


def _split(place: str, n: str) -> str:
    test = f"greatest(1, cast(floor(({n}) * 0.2e0) as bigint))"
    val = f"greatest(1, cast(floor(({n}) * 0.15e0) as bigint))"
    return f"""case when {place} < {n} - {test} - {val} then 'train'
        when {place} < {n} - {test} then 'val' else 'test' end"""


_WINDOWED = f"""{_LAKE},
    windowed as (
        select *, {_split("pos - 14", "n - 14")} as split from lake
        where pos >= 14 and n - 14 >= 3)"""

# Train statistics straight from the definition: every step of every train window.
_TRAIN = f"""{_WINDOWED},
    steps as (
        select s.* from windowed w join lake s
        on s.station = w.station and s.pos between w.pos - 14 and w.pos - 1
        where w.split = 'train'),
    stats as (
        select station, {", ".join(
            f"avg({f}) as m_{f}, stddev_pop({f}) + 1e-6 as s_{f}" for f in FEATURES)}
        from steps group by station)"""

_SUMMARIES = f"""{_TRAIN},
    summaries as (
        select w.station, w.date, w.split, {", ".join(
            f"avg((s.{f} - m_{f}) / s_{f}) as avg_{f}, "
            f"max(case when s.pos = w.pos - 1 then (s.{f} - m_{f}) / s_{f} end) as last_{f}"
            for f in FEATURES)}
        from windowed w
        join lake s on s.station = w.station and s.pos between w.pos - 14 and w.pos - 1
        join stats t on t.station = w.station
        group by 1, 2, 3)"""

_SUMMARY_NAMES = [f"avg_{f}" for f in FEATURES] + [f"last_{f}" for f in FEATURES]


def _logistic(epochs: int = 300) -> str:
    """Member A: ``epochs`` full-batch steps from zero on the summaries, scaled a second time."""
    n = _SUMMARY_NAMES
    z = " + ".join(f"w{i} * x{i}" for i in range(len(n))) + " + b"
    return f"""with recursive {_SUMMARIES},
    again as (
        select station, {", ".join(
            f"avg({c}) as m{i}, stddev_pop({c}) + 1e-6 as s{i}" for i, c in enumerate(n))}
        from summaries where split = 'train' group by station),
    scaled as materialized (
        select u.station, u.date, u.split, cast(l.label_high as double) as y, {", ".join(
            f"(u.{c} - a.m{i}) / a.s{i} as x{i}" for i, c in enumerate(n))}
        from summaries u join again a on a.station = u.station
        join windowed l on l.station = u.station and l.date = u.date),
    fit as (
        select 0 as i, station, {", ".join(f"0e0 as w{i}" for i in range(len(n)))}, 0e0 as b
        from again
        union all
        select i + 1, station, {", ".join(f"w{i} - 0.05e0 * g{i}" for i in range(len(n)))},
               b - 0.05e0 * g
        from (select i, station, b, {", ".join(f"w{i}" for i in range(len(n)))}, avg(miss) as g,
                     {", ".join(f"avg(miss * x{i}) as g{i}" for i in range(len(n)))}
              from (select f.*, 1e0 / (1e0 + exp(-({z}))) - y as miss,
                           {", ".join(f"x{i}" for i in range(len(n)))}
                    from fit f join scaled s on s.station = f.station
                    where f.i < {epochs} and s.split = 'train')
              group by i, station, b, {", ".join(f"w{i}" for i in range(len(n)))}))
    select s.station, s.date, s.split, {r(f"1e0 / (1e0 + exp(-({z})))", "lstm_prob")}
    from scaled s join (select * from fit where i = {epochs}) f on f.station = s.station"""


# --- strategy -----------------------------------------------------------------------


def _backtest(source: str, threshold: str = "0.02e0", by: str = "market") -> str:
    """CTEs from ``src`` (market, date, model_prob, market_prob, outcome) to ``dd``."""
    return f"""
    src as ({source}),
    d as (select *, least(greatest(model_prob, 1e-4), 1 - 1e-4) as p,
                 least(greatest(market_prob, 1e-4), 1 - 1e-4) as q from src),
    t as (select *, case when p - q >= q - p and p - q > {threshold} then 'YES'
                         when q - p > {threshold} then 'NO' else 'PASS' end as side from d),
    k as (select *, case side when 'YES' then p - q when 'NO' then q - p else 0e0 end as edge,
                 p as fair_yes_price,
                 greatest(case side when 'YES' then (p - q) / (1 - q)
                                    when 'NO' then (q - p) / q else 0e0 end, 0e0) as kelly_full
          from t),
    u as (select *, least(kelly_full * 0.3e0, 0.025e0) as kelly_used from k),
    v as (select *, {half_up("kelly_used * 5000e0", 2)} as stake_usd,
                 side <> 'PASS' and kelly_used > 0 as taken,
                 (side = 'YES' and outcome = 1) or (side = 'NO' and outcome = 0) as hit from u),
    w as (select *, taken and hit as won,
                 case when not taken then 0e0 else
                     (case when not hit then -(kelly_used * 5000e0)
                           when side = 'YES' then kelly_used * 5000e0 * ((1 - q) / q)
                           else kelly_used * 5000e0 * (q / (1 - q)) end)
                     - kelly_used * 5000e0 * 0.02e0 end as pnl from v),
    eq as (select *, {half_up(
        f"5000e0 + sum(pnl) over (partition by {by} order by date)", 2)} as equity,
        pnl / 5000e0 as daily_return from w),
    pk as (select *, max(equity) over (partition by {by} order by date) as peak from eq),
    dd as (select *, (peak - equity) / peak as drawdown from pk)"""


_MIX = "least(greatest({w} * lstm_prob + (1e0 - {w}) * transformer_prob, 1e-4), 1 - 1e-4)"
_HALF = f"""select market, date, {_MIX.format(w="0.5e0")} as model_prob, market_prob, outcome
            from ({PREDS})"""
_BT = "with " + _backtest(_HALF)

_GRID = """
    ws as (select i / 8e0 as weight from range(9) t(i)),
    ths as (select case when j = 11 then 0.04e0
                        else j * ((0.04e0 - 0.005e0) / 11e0) + 0.005e0 end as threshold
            from range(12) t(j))"""

_VAL = f"""
    placed as (
        select *, row_number() over (partition by market order by date) - 1 as place,
               count(*) over (partition by market) as n from ({PREDS})),
    val as (select * from placed where {_split("place", "n")} = 'val')"""

_SCORES = f"""with {_GRID}, {_VAL}, {_backtest(
    f"select market, date, weight, threshold, {_MIX.format(w='weight')} as model_prob, "
    "market_prob, outcome from val, ws, ths", "threshold", "market, weight, threshold")},
    agg as (select market, weight, threshold, cast(sum(cast(taken as integer)) as bigint) as n_trades,
                   sum(pnl) / 5000e0 as total_return, max(drawdown) as max_drawdown
            from dd group by 1, 2, 3),
    scores as (select *, case when n_trades < 3 then -1e0 + 0.001e0 * n_trades
                              else total_return - 0.5e0 * max_drawdown end as score from agg)"""


def _platt(market: str = "market", steps: int = 8) -> str:
    """Newton steps of the penalised fit, unrolled."""
    text = f"""
    src as (select * replace ({market} as market), ln(lstm_prob / (1e0 - lstm_prob)) as z, cast(outcome as double) as y
            from ({PREDS})),
    f0 as (select distinct market, 1e0 as a, 0e0 as b from src)"""
    for i in range(steps):
        text += f""",
    g{i} as (select s.market, any_value(a) as a, any_value(b) as b,
                    avg((p - y) * z) + 10e0 / count(*) * (any_value(a) - 1e0) as ga,
                    avg(p - y) + 10e0 / count(*) * any_value(b) as gb,
                    avg(p * (1e0 - p) * z * z) + 10e0 / count(*) as haa,
                    avg(p * (1e0 - p) * z) as hab,
                    avg(p * (1e0 - p)) + 10e0 / count(*) as hbb
             from (select s.market, z, y, a, b, 1e0 / (1e0 + exp(-(a * z + b))) as p
                   from src s join f{i} f on f.market is not distinct from s.market) s group by s.market),
    f{i + 1} as (select market,
                        a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) as a,
                        b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) as b from g{i})"""
    return f"""with {text}
    select s.market, date, {r("1e0 / (1e0 + exp(-(a * z + b)))", "model_prob")}
    from src s join f{steps} f on f.market is not distinct from s.market"""


def _platt_bounded(steps: int = 3000) -> str:
    """The same minimum by steps that divide the gradient by a fixed bound of the curvature."""
    return f"""with recursive src as (
      select market, date, 8e0 * ln(lstm_prob / (1e0 - lstm_prob)) as z, cast(outcome as double) as y
      from ({PREDS})),
    bound as (
      select market, avg(z * z) / 4 + 10e0 / count(*) as baa, avg(z) / 4 as bab,
             0.25e0 + 10e0 / count(*) as bbb, 10e0 / count(*) as r from src group by 1),
    fit(i, market, a, b) as (
      select 0, market, 1e0, 0e0 from bound
      union all
      select i + 1, market, a - (bbb * ga - bab * gb) / (baa * bbb - bab * bab),
             b - (baa * gb - bab * ga) / (baa * bbb - bab * bab)
      from (select f.i, f.market, any_value(f.a) as a, any_value(f.b) as b, any_value(baa) as baa,
                   any_value(bab) as bab, any_value(bbb) as bbb,
                   avg((1e0 / (1e0 + exp(-(f.a * z + f.b))) - y) * z) + any_value(r) * (any_value(f.a) - 1e0) as ga,
                   avg(1e0 / (1e0 + exp(-(f.a * z + f.b))) - y) + any_value(r) * any_value(f.b) as gb
            from fit f join src s on s.market = f.market join bound o on o.market = f.market
            where f.i < {steps} group by 1, 2))
    select s.market, date, {r("1e0 / (1e0 + exp(-(a * z + b)))", "model_prob")}
    from src s join (select * from fit where i = {steps}) f on f.market = s.market"""


# Coefficients of the rational approximation of the inverse normal.
_A = ["-3.969683028665376e1", "2.209460984245205e2", "-2.759285104469687e2", "1.383577518672690e2",
      "-3.066479806614716e1", "2.506628277459239e0"]
_B = ["-5.447609879822406e1", "1.615858368580409e2", "-1.556989798598866e2", "6.680131188771972e1",
      "-1.328068155288572e1", "1e0"]
_C = ["-7.784894002430293e-3", "-3.223964580411365e-1", "-2.400758277161838e0", "-2.549732539343734e0",
      "4.374664141464968e0", "2.938163982698783e0"]
_D = ["7.784695709041462e-3", "3.224671290700398e-1", "2.445134137142996e0", "3.754408661907416e0",
      "1e0"]


def _poly(coefficients: list[str], x: str) -> str:
    n = len(coefficients) - 1
    return "(" + " + ".join(f"({c}) * pow({x}, {n - i})" for i, c in enumerate(coefficients)) + ")"


_INVERSE = f"""case when p < 0.02425e0 then {_poly(_C, "t")} / {_poly(_D, "t")}
    when p > 1 - 0.02425e0 then -({_poly(_C, "t")} / {_poly(_D, "t")})
    else {_poly(_A, "s")} * (p - 0.5e0) / {_poly(_B, "s")} end"""


def _invnorm(source: str, p: str) -> str:
    """``source`` with z = the normal quantile of p limited to [.001, .999]."""
    return f"""(select *, {_INVERSE} as z from (
        select *, sqrt(-2e0 * ln(least(p, 1e0 - p))) as t, (p - 0.5e0) * (p - 0.5e0) as s from (
            select *, least(greatest({p}, 1e-3), 1 - 1e-3) as p from {source})))"""


# --- monitor ------------------------------------------------------------------------


def _slots(kind: str) -> str:
    return ", ".join(f"{kind}_{v}" for v in VENUES)


def _first(kind: str, best: str) -> str:
    return " ".join(f"when {kind}_{v} = {best} then '{v}'" for v in sorted(VENUES))


_BOOK = f"""
    q as ({QUOTES}),
    carried as (
        select *, {", ".join(
            f"last_value(case when venue = '{v}' then yes_{k} end ignore nulls) over w as {k}_{v}"
            for v in VENUES for k in ("bid", "ask"))}
        from q window w as (partition by market order by seq)),
    priced as (select *, least({_slots("ask")}) as best_ask, greatest({_slots("bid")}) as best_bid,
                      {" + ".join(f"cast(ask_{v} is not null as integer)" for v in VENUES)}
                          as venue_count
               from carried),
    state as (select *, case {_first("ask", "best_ask")} end as ask_venue,
                     case {_first("bid", "best_bid")} end as bid_venue,
                     (best_bid - best_ask) / best_ask as spread_pct from priced),
    events_ as (select *, ask_venue <> bid_venue and best_bid > best_ask
                          and spread_pct >= 0.0005e0 as is_signal,
                       (recv_ns - ts_ns) / 1000e0 as us from state),
    signals as (select market, ask_venue as buy_venue, bid_venue as sell_venue,
                       best_ask as buy_price, best_bid as sell_price, spread_pct,
                       cast(trunc(us) as bigint) as latency_us, recv_ns as ts_ns, seq
                from events_ where is_signal)"""

_SIGNALS = f"""with {_BOOK} select market, buy_venue, sell_venue,
    {rs("buy_price", "sell_price", "spread_pct")}, latency_us, ts_ns, seq from signals"""

_LATEST = f"""with q as ({QUOTES})
    select market, venue, seq, ts_ns, {rs("yes_bid", "yes_ask")} from q
    qualify row_number() over (partition by market, venue order by seq desc) = 1"""


def _rolling(samples: int) -> str:
    """CTEs to ``rolled``: p50 and p99 of the last samples at the end of each tick."""
    return f"""
    sampled as (
        select market, recv_ns // {HOUR_NS} as tick, (recv_ns - ts_ns) / 1000e0 as us,
               row_number() over (partition by market order by recv_ns, seq) as o
        from ({QUOTES}) where recv_ns >= ts_ns),
    ends as (select market, tick, max(o) as c from sampled group by 1, 2),
    ranked as (
        select e.market, e.tick, e.c, s.us,
               row_number() over (partition by e.market, e.tick order by s.us) - 1 as place,
               count(*) over (partition by e.market, e.tick) as m
        from ends e join sampled s
        on s.market = e.market and s.o > e.c - {samples} and s.o <= e.c),
    rolled as (
        select market, tick, cast(c as bigint) as sample_count,
               max(case when place = floor(0.5e0 * (m - 1)) then us end) as latency_us_p50,
               max(case when place = floor(0.99e0 * (m - 1)) then us end) as latency_us_p99
        from ranked group by 1, 2, 3)"""


def _ticks(tick_ns: int, events: str = "events_") -> str:
    """CTEs to ``running``: all ticks of a market with cumulative counters."""
    return f"""
    counted as (
        select market, recv_ns // {tick_ns} as tick, count(*) as messages,
               cast(sum(cast(is_signal as integer)) as bigint) as signals,
               cast(sum(cast(recv_ns >= ts_ns as integer)) as bigint) as samples
        from {events} group by 1, 2),
    spine as (
        select market, unnest(range(lo, hi + 1)) as tick
        from (select market, min(tick) as lo, max(tick) as hi from counted group by 1)),
    filled as (
        select s.market, s.tick, coalesce(messages, 0) as messages,
               coalesce(signals, 0) as signals, coalesce(samples, 0) as samples
        from spine s left join counted c on c.market = s.market and c.tick = s.tick),
    running as (
        select *, cast(sum(messages) over w as bigint) as messages_processed,
               cast(sum(signals) over w as bigint) as arb_opportunities,
               cast(sum(samples) over w as bigint) as sample_count,
               100e0 * sum(cast(messages > 0 as integer)) over w / count(*) over w as uptime_pct
        from filled window w as (partition by market order by tick))"""


_STATS = f"""with {_BOOK}, {_ticks(HOUR_NS)}, {_rolling(8192)},
    started as (select market, min(recv_ns) as started_at_ns from q group by 1),
    stats as (
        select n.market, n.tick, started_at_ns,
               ((n.tick + 1) * {HOUR_NS} - started_at_ns) / 1e9 as uptime_seconds,
               messages_processed, arb_opportunities, arb_opportunities as trades_executed,
               coalesce((select max(latency_us_p50) from rolled l where l.market = n.market
                         and l.sample_count = n.sample_count), 0e0) as latency_us_p50,
               coalesce((select max(latency_us_p99) from rolled l where l.market = n.market
                         and l.sample_count = n.sample_count), 0e0) as latency_us_p99,
               messages / 3600e0 as msgs_per_sec, uptime_pct
        from running n join started s on s.market = n.market)"""

# Field values of the message fixture: which sequence numbers are cut off or incomplete.
_SENT = f"""
    sent as (
        select case when seq % 101 = 0 then 'stat.' else 'book.' end || venue as topic, *,
               seq % 97 = 0 as broken, seq % 89 = 0 as no_ask
        from ({QUOTES}))"""


ORACLE = {
    "observations_wide": f"""
        select station, date, {r("avg(case when datatype = 'TMAX' then value end)", "tmax_f")},
               {r("avg(case when datatype = 'TMIN' then value end)", "tmin_f")},
               60e0 as humidity, 8e0 as wind_mph
        from ({LONG}) group by 1, 2 having count(case when datatype = 'TMAX' then 1 end) > 0""",
    "backfill_resumed": f"""
        select station, date, {r("avg(case when datatype = 'TMAX' then value end)", "tmax_f")},
               {r("avg(case when datatype = 'TMIN' then value end)", "tmin_f")},
               60e0 as humidity, 8e0 as wind_mph
        from ({LONG}) group by 1, 2 having count(case when datatype = 'TMAX' then 1 end) > 0""",
    "source_gate": f"""
        with obs as ({OBS}), c as (select *, count(*) over (partition by station) as n from obs)
        select station, date, case when n > 400 then tmax_f else tmax_f + 100e0 end as tmax_f,
               case when n > 400 then 'primary' else 'fallback' end as source from c""",
    "station_lookup": f"""
        select o.station, o.date, n_name as external_id, r_name as region
        from ({OBS}) o left join (
            select * from nation join region on n_regionkey = r_regionkey) d
        on o.station = 'S' || cast(d.n_nationkey as varchar)""",
    "backfill_chunks": f"""
        with s as (select station, min(date) as lo, max(date) as hi from ({OBS}) group by 1)
        select station, cast(lo + 366 * cast(i as integer) as date) as chunk_start,
               cast(least(lo + 366 * cast(i as integer) + 365, hi) as date) as chunk_end
        from (select *, unnest(range((hi - lo) // 366 + 1)) as i from s)""",
    "listing_filter": f"""
        with m as ({MARKETS}),
        f as (select *, row_number() over (partition by listing order by pos) as k
              from m where status = 'open'),
        g as (select *, regexp_matches(lower(title || ticker), 'high|weather|rain|steel|brass')
                     as hit from f where k <= 20)
        select listing, cast(pos as integer) as pos, title, ticker, status from g
        where hit or not exists (select 1 from g h where h.listing = g.listing and h.hit)""",
    "lake_roundtrip": f"""
        with {_LAKE} select station, date, year, tmax_f, {r("normal_30", "normal_30")}, label_high
        from lake""",
    "quote_decode": f"""
        with {_SENT} select venue, market, yes_bid, yes_ask,
               case when seq % 83 = 0 then 0 else seq end as seq,
               case when seq % 79 = 0 then recv_ns else ts_ns end as ts_ns, recv_ns
        from sent where topic like 'book.%' and not broken and not no_ask""",
    "quote_quarantine": f"""
        with {_SENT} select seq, venue as topic_venue,
               case when broken then 'malformed' else 'unusable price' end as reason
        from sent where topic like 'book.%' and (broken or no_ask)""",
    "quote_mid": f"""
        select market, venue, seq, {r("(yes_bid + yes_ask) / 2e0", "yes_mid")} from ({QUOTES})""",
    "quote_encode": f"""
        select venue, market, yes_bid, yes_ask, seq, ts_ns, recv_ns from ({QUOTES})""",
    "lag_features": f"""
        with {_LAGGED} select station, date, tmax_lag1, tmax_lag2, tmax_lag3, tmin_lag1,
               humidity_lag1, wind_lag1 from lagged""",
    "rolling_normals_partial": f"""
        with {_LAGGED} select station, date, {rs("tmax_roll7", "tmax_roll30")},
               {r("tmax_roll30", "normal_30")}, tmax_f as target_high_f
        from lagged where tmax_lag3 is not null""",
    "rolling_normals_full": f"""
        with {_LAGGED} select station, date, {rs("tmax_roll7", "tmax_roll30")},
               {r("tmax_roll30", "normal_30")}, tmax_f as target_high_f
        from lagged where n30 = 30""",
    "calendar_encoding": f"""
        select station, date, cast({_DOY} as integer) as doy, cast(month(date) as integer) as month,
               cast(year(date) as integer) as year,
               {r(f"sin(2e0 * pi() * {_DOY} / 365e0)", "doy_sin")},
               {r(f"cos(2e0 * pi() * {_DOY} / 365e0)", "doy_cos")} from ({OBS})""",
    "contract_label": f"with {_LAKE} select station, date, label_high, threshold_f from lake",
    "contract_mixed_sources": f"""
        with {_LAKE}, few as (select station from ({OBS}) group by 1 having count(*) <= 400)
        select station, date,
               case when station in (from few) and day(date) % 2 = 1 then 1 else label_high end as label_high,
               case when station in (from few) and day(date) % 2 = 1 then 70e0 else threshold_f end as threshold_f
        from lake""",
    "price_naive": f"""
        with {_LAGGED} select station, date, {r(_NAIVE, "market_yes_price")}
        from lagged where n30 = 30""",
    "price_informed": _price(_INFORMED),
    "price_informed_noise": _price(f"{_INFORMED} + 0.02e0 * {_NOISE}"),
    "sequence_windows": f"""
        with {_WINDOWED} select w.station, w.date, w.split, cast(count(*) as integer) as steps,
               max(case when s.pos = w.pos - 14 then s.tmax_f end) as first_tmax,
               max(case when s.pos = w.pos - 1 then s.tmax_f end) as last_tmax,
               max(case when s.pos = w.pos - 1 then s.humidity end) as last_humidity,
               w.label_high as label, w.tmax_f as high
        from windowed w join lake s
        on s.station = w.station and s.pos between w.pos - 14 and w.pos - 1
        group by w.station, w.date, w.split, w.label_high, w.tmax_f""",
    "live_windows": f"""
        with {_LAKE}, l as (select * from lake where pos >= n - 14)
        select station, max(date) as date, cast(count(*) as integer) as steps,
               arg_min(tmax_f, date) as first_tmax, arg_max(tmax_f, date) as last_tmax_f,
               {r("avg(tmax_f)", "avg_tmax_f")}, arg_max(threshold_f, date) as threshold_f,
               arg_max(market_yes_price, date) as market_yes_price
        from l group by 1 having count(*) = 14""",
    "time_split": f"""
        select station, date, {_split("place", "n")} as split from (
            select station, date, row_number() over (partition by station order by date) - 1
                   as place, count(*) over (partition by station) as n from ({OBS}))""",
    "train_standardize": f"""
        with {_TRAIN} select l.station, date,
               {", ".join(r(f"({f} - m_{f}) / s_{f}", f) for f in FEATURES)}
        from lake l join stats t on t.station = l.station""",
    "window_summary_features": f"""
        with {_SUMMARIES} select station, date, split, {rs(*_SUMMARY_NAMES)} from summaries""",
    "logistic_scores": _logistic(),
    "external_model_scores": f"""
        with {_WINDOWED} select w.station, w.date,
            {r("1e0 / (1e0 + exp(-(0.05e0 * avg(s.tmax_f) - 0.04e0 * "
               "max(case when s.pos = w.pos - 1 then s.tmin_f end) - 2e0)))", "external_prob")}
        from windowed w join lake s
        on s.station = w.station and s.pos between w.pos - 14 and w.pos - 1
        group by w.station, w.date""",
    "blend_probs": f"""
        select market, date, {r(_MIX.format(w="0.7e0"), "ensemble_prob")} from ({PREDS})""",
    "model_accuracy": f"""
        with e as (select *, {_MIX.format(w="0.5e0")} as ensemble_prob from ({PREDS}))
        select market, {", ".join(
            r(f"avg(cast(cast({p}_prob >= 0.5e0 as integer) = outcome as integer))",
              f"accuracy_{p}") for p in ("lstm", "transformer", "ensemble"))}
        from e group by 1""",
    "calibrated_probs": _platt(),
    "calibrated_null_market": _platt("nullif(market, 'HUB')"),
    "calibrated_overconfident": _platt_bounded(),
    "trade_decisions": f"{_BT} select market, date, side, {rs('edge', 'fair_yes_price')} from k",
    "kelly_sizing": f"""{_BT} select market, date, side, {rs("kelly_full", "kelly_used")},
        stake_usd from v""",
    "trade_pnl": f"{_BT} select market, date, taken, won, {rs('pnl')} from w",
    "equity_curve": f"{_BT} select market, date, equity, {rs('daily_return')} from eq",
    "equity_view": f"{_BT} select market, date, equity from eq",
    "drawdown": f"{_BT} select market, date, peak, {rs('drawdown')} from dd",
    "backtest_metrics": f"""{_BT}, m as (
        select market, cast(sum(cast(taken as integer)) as bigint) as n_trades,
               coalesce(avg(case when taken then edge end), 0e0) as avg_edge,
               sum(cast(won as integer)) as wins, 5000e0 + sum(pnl) as final, count(*) as days,
               max(drawdown) as max_drawdown, avg(daily_return) as mean,
               stddev_pop(daily_return) as std, min(date) as lo, max(date) as hi
        from dd group by 1)
        select market, n_trades, {rs("avg_edge")},
               {r("case when n_trades > 0 then wins / n_trades else 0e0 end", "hit_rate")},
               {r("pow(final / 5000e0, 1e0 / (days / 30e0)) - 1", "monthly_roi")},
               {r("final / 5000e0 - 1", "total_return")}, {rs("max_drawdown")},
               {r("case when std > 1e-12 then mean / std * sqrt(252e0) else 0e0 end", "sharpe")},
               {half_up("final", 2)} as final_bankroll,
               strftime(lo, '%Y-%m-%d') as window_start, strftime(hi, '%Y-%m-%d') as window_end
        from m""",
    "grid_search_scores": f"""{_SCORES} select market, {rs("weight", "threshold")}, n_trades,
        {rs("total_return", "max_drawdown", "score")} from scores""",
    "grid_search_best": f"""{_SCORES}
        select market, {r("weight", "weight_lstm")}, {r("threshold", "edge_threshold")},
               {rs("score")}, 'grid-search' as opt_method from scores
        qualify row_number() over (partition by market
                                   order by score desc, weight, threshold) = 1""",
    "point_forecast": f"""
        select market, cast(date + 1 as date) as target_date,
               {r("70e0 + 7e0 * z", "predicted_high_f")},
               printf('%.1f', market_prob * 100e0) || '%' as market_pct
        from {_invnorm(f"({PREDS})", "(lstm_prob - 0.2e0) / 0.6e0")}""",
    "live_records": f"""
        with newest as (
            select * from ({PREDS}) qualify row_number() over (
                partition by market order by date desc) = 1),
        {_backtest(f'''select *, {_MIX.format(w="0.5e0")} as model_prob from newest''')
         .replace("src as", "mixed as", 1).replace("from src", "from mixed", 1)}
        select market, strftime(date + 1, '%Y-%m-%d') as target_date,
               {half_up("lstm_prob", 4)} as lstm_prob, {half_up("model_prob", 4)} as ensemble_prob,
               {half_up("70.5e0 + 7e0 * z", 1)} as predicted_high_f,
               {half_up("market_prob", 4)} as market_prob,
               {half_up("model_prob - market_prob", 4)} as odds_edge, side,
               {half_up("edge", 4)} as edge, {half_up("kelly_full", 4)} as kelly_fraction_full,
               {half_up("kelly_used", 4)} as kelly_fraction_used, stake_usd,
               printf('%.2f', {half_up("model_prob - market_prob", 4)} * 100e0) || '%' as edge_pct
        from {_invnorm("(select * exclude (p) from v)", "model_prob")}""",
    "book_carry_forward": f"""
        with {_BOOK} select market, seq, {rs("best_ask", "best_bid")}, ask_venue, bid_venue,
               venue_count from state""",
    "arb_signals": _SIGNALS,
    "arb_signals_bucketed": _SIGNALS,
    "arb_nanosecond_seq": f"""
        select * replace (seq * 1000003 + 1700000000000000000 as seq) from ({_SIGNALS})""",
    "asof_forecast": f"""
        with q as ({QUOTES}),
        f as (select market, ts_ns + 1000000000 as ts_ns, (seq % 997) / 997e0 as ensemble_prob,
                     seq + 1 as version from q where venue = 'signup')
        select q.market, q.seq, {r("f.ensemble_prob", "ensemble_prob")}, f.version
        from q asof left join f on q.market = f.market and q.ts_ns >= f.ts_ns""",
    "latest_quote": _LATEST,
    "capped_signals": f"""
        with {_BOOK} select market, cast(place as integer) as place, seq, ts_ns, {rs("spread_pct")}
        from (select *, row_number() over (partition by market order by ts_ns desc, seq desc)
                     as place from signals) where place <= 200""",
    "newest_decoded": f"""
        with {_SENT}, l as (
            select *, row_number() over (partition by topic order by seq desc) as place from sent)
        select topic, cast(place as integer) as place, seq as sent, market, {rs("yes_bid")}
        from l where place <= 60 and not broken""",
    "point_read": f"""
        with {_SENT}
        select 'q:' || cast(w.seq * 2 as varchar) as key,
               case when s.seq is null or s.broken then '?' else s.market end as market,
               {r("case when s.seq is null or s.broken then -1e0 else s.yes_bid end", "yes_bid")}
        from sent w left join sent s on s.seq = w.seq * 2""",
    "signal_view": f"""
        with {_BOOK} select market, buy_venue, sell_venue, {rs("buy_price", "sell_price")},
               {half_up("spread_pct * 100e0", 3)} as spread_percent, latency_us
        from (select * from signals order by ts_ns desc, seq desc limit 25)""",
    "venue_quotes": f"""
        with q as ({QUOTES}) select venue, market, seq, {rs("yes_bid")} from q
        where venue in (select case when event_type = 'view' then 'nowhere' else event_type end
                        from events)
        qualify row_number() over (partition by venue order by seq desc) = 1""",
    "latency_percentiles": f"""
        with s as (select market, (recv_ns - ts_ns) / 1000e0 as us from ({QUOTES})
                   where recv_ns >= ts_ns),
        k as (select *, row_number() over (partition by market order by us) - 1 as place,
                     count(*) over (partition by market) as n from s)
        select market, max(case when place = floor(0.5e0 * (n - 1)) then us end) as latency_us_p50,
               max(case when place = floor(0.99e0 * (n - 1)) then us end) as latency_us_p99
        from k group by 1""",
    "rolling_latency": f"with {_rolling(8192)} select * from rolled",
    "rolling_latency_ring": f"with {_rolling(256)} select * from rolled",
    "second_spine_counts": f"""
        with {_BOOK}, {_ticks(HOUR_NS)} select market, tick, messages, signals, samples
        from filled""",
    "availability": f"""
        with q as (select *, false as is_signal from ({QUOTES})), {_ticks(HOUR_NS // 4, "q")}
        select market, tick, messages_processed, {rs("uptime_pct")} from running""",
    "engine_stats": f"""{_STATS}
        select market, tick, started_at_ns, messages_processed, arb_opportunities,
               trades_executed, {rs("uptime_seconds", "latency_us_p50", "latency_us_p99",
                                    "msgs_per_sec", "uptime_pct")} from stats""",
    "health_view": f"""{_STATS}
        select market, tick, messages_processed, arb_opportunities, trades_executed,
               {rs("latency_us_p99", "uptime_pct")} from stats
        qualify row_number() over (partition by market order by tick desc) = 1""",
    "stream_counts": f"""
        with q as ({QUOTES}), w as (select max(recv_ns // 1000000) * 1000000 - {HOUR_NS} as mark from q)
        select market, recv_ns // {HOUR_NS} * {HOUR_NS} as tick_start_ns, count(*) as messages,
               cast(sum(cast(recv_ns >= ts_ns as integer)) as bigint) as samples
        from q group by 1, 2 having tick_start_ns + {HOUR_NS} <= (select mark from w)""",
    "stream_counts_all": f"""
        with q as ({QUOTES})
        select market, recv_ns // {HOUR_NS} * {HOUR_NS} as tick_start_ns, count(*) as messages,
               cast(sum(cast(recv_ns >= ts_ns as integer)) as bigint) as samples
        from q group by 1, 2""",
    "stream_arb": _SIGNALS,
    "stream_signal_feed": f"""{_SIGNALS}
        qualify row_number() over (partition by market order by ts_ns desc, seq desc) <= 200""",
    "stream_engine_stats": f"""{_STATS}
        select market, tick, started_at_ns, messages_processed, arb_opportunities,
               trades_executed, {rs("uptime_seconds", "latency_us_p50", "latency_us_p99",
                                    "msgs_per_sec", "uptime_pct")} from stats""",
    "stream_latest": _LATEST,
    "stream_capped": f"""
        with q as ({QUOTES}) select market, venue, seq from q
        qualify row_number() over (partition by market order by seq desc) <= 50""",
}
