"""The library's inputs derived from the TPC-H-like test tables, as DataFrames and as SQL.

The number of stations and markets grows with the tables; one station (``HUB``) takes a
third of all orders, and each of the four quote markets a quarter of all events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VENUES = ["click", "error", "purchase", "signup", "view"]
CUSTOMERS_PER_STATION = 50


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _station():
    number = F.expr(f"o_custkey div {CUSTOMERS_PER_STATION}").cast("string")
    return F.when(F.col("o_orderkey") % 3 == 0, "HUB").otherwise(F.concat(F.lit("S"), number))


def obs_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Raw daily weather without contract columns, in quarter degrees (sums are exact)."""
    orders = table(spark, sf, "orders")
    return orders.groupBy(_station().alias("station"), F.to_date("o_orderdate").alias("date")).agg(
        (F.floor(F.max("o_totalprice") / 1250.0) / 4.0).alias("tmax_f"),
        (F.floor(F.min("o_totalprice") / 1250.0) / 4.0 - 15.0).alias("tmin_f"),
        (F.sum("o_custkey") % 86 + 15).cast("double").alias("humidity"),
        ((F.count(F.lit(1)) * 7 + F.min("o_orderkey")) % 40).cast("double").alias("wind_mph"),
    )


def obs_long(spark: SparkSession, sf: str) -> DataFrame:
    """Long observations with duplicates and missing days."""
    datatype = F.when(F.col("l_linestatus") == "O", "TMAX").otherwise("TMIN")
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("station"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        datatype.alias("datatype"),
        F.col("l_quantity").alias("value"),
    )


def preds(spark: SparkSession, sf: str) -> DataFrame:
    """Member probabilities, market price and outcome per (market, date)."""
    orders = table(spark, sf, "orders")
    keyed = orders.groupBy(
        _station().alias("market"), F.to_date("o_orderdate").alias("date")
    ).agg(F.min("o_orderkey").alias("k"))

    def noise(m: int):
        return (F.col("k") * m % 1000) / 1000.0

    q = F.lit(0.3) + F.lit(0.4) * noise(104729)
    luck = noise(31337) < F.col("market_prob") + 0.05 * (noise(7919) - 0.5)
    return keyed.withColumn("market_prob", q).select(
        "market",
        "date",
        "market_prob",
        (F.col("market_prob") + 0.2 * (noise(7919) - 0.5)).alias("lstm_prob"),
        (F.col("market_prob") + 0.2 * (noise(6101) - 0.5)).alias("transformer_prob"),
        F.when(luck, 1).otherwise(0).alias("outcome"),
    )


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes of five venues on four markets with a receive time; delays may be negative."""
    return quotes_of(table(spark, sf, "events"))


def quotes_of(events: DataFrame) -> DataFrame:
    fair = F.lit(0.5) + (F.col("value") % 10 - 5) / 500.0
    us = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    delay = F.col("event_id") * 7919 % 20000 - 50
    key = F.get_json_object("props", "$.k").cast("int") % 4
    return events.select(
        F.col("event_type").alias("venue"),
        F.concat(F.lit("M"), key.cast("string")).alias("market"),
        (fair - 0.006).alias("yes_bid"),
        (fair + 0.006).alias("yes_ask"),
        F.col("event_id").alias("seq"),
        (us * 1000).alias("ts_ns"),
        ((us + delay) * 1000).alias("recv_ns"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes as topic and JSON payload; every 97th is cut off, some lack an ask."""
    q = quotes(spark, sf)
    body = F.to_json(
        F.struct(
            "venue",
            "market",
            "yes_bid",
            F.when(F.col("seq") % 89 != 0, F.col("yes_ask")).alias("yes_ask"),
            F.when(F.col("seq") % 83 != 0, F.col("seq")).alias("seq"),
            F.when(F.col("seq") % 79 != 0, F.col("ts_ns")).alias("ts_ns"),
        )
    )
    cut = F.when(F.col("seq") % 97 == 0, F.substring(body, 1, 20)).otherwise(body)
    prefix = F.when(F.col("seq") % 101 == 0, "stat.").otherwise("book.")
    return q.select(
        F.concat(prefix, F.col("venue")).alias("topic"), cut.alias("payload"), "recv_ns", "seq"
    )


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """Listing documents: pages of 30 parts as {"markets": [...]}."""
    part = table(spark, sf, "part").select(
        F.expr("p_partkey div 30").alias("listing"),
        "p_partkey",
        F.struct(
            F.col("p_name").alias("title"),
            F.col("p_type").alias("ticker"),
            F.when(F.col("p_size") % 5 == 0, "closed").otherwise("open").alias("status"),
        ).alias("m"),
    )
    page = F.sort_array(F.collect_list(F.struct("p_partkey", "m")))
    return part.groupBy("listing").agg(
        F.to_json(F.struct(F.transform(page, lambda p: p["m"]).alias("markets"))).alias("body")
    )


_STATION_SQL = (
    "case when o_orderkey % 3 = 0 then 'HUB' "
    f"else 'S' || cast(o_custkey // {CUSTOMERS_PER_STATION} as varchar) end"
)

SQL = {
    "obs_daily": f"""
        select {_STATION_SQL} as station, cast(o_orderdate as date) as date,
               floor(max(o_totalprice) / 1250e0) / 4e0 as tmax_f,
               floor(min(o_totalprice) / 1250e0) / 4e0 - 15e0 as tmin_f,
               cast(sum(o_custkey) % 86 + 15 as double) as humidity,
               cast((count(*) * 7 + min(o_orderkey)) % 40 as double) as wind_mph
        from orders group by 1, 2""",
    "obs_long": """
        select 'S' || cast(l_suppkey as varchar) as station,
               cast(l_shipdate as date) as date,
               case when l_linestatus = 'O' then 'TMAX' else 'TMIN' end as datatype,
               l_quantity as value
        from lineitem""",
    "preds": f"""
        select market, date, q as market_prob,
               q + 0.2e0 * ((k * 7919 % 1000) / 1000e0 - 0.5e0) as lstm_prob,
               q + 0.2e0 * ((k * 6101 % 1000) / 1000e0 - 0.5e0) as transformer_prob,
               cast(case when (k * 31337 % 1000) / 1000e0
                         < q + 0.05e0 * ((k * 7919 % 1000) / 1000e0 - 0.5e0)
                    then 1 else 0 end as integer) as outcome
        from (select {_STATION_SQL} as market, cast(o_orderdate as date) as date,
                     min(o_orderkey) as k,
                     0.3e0 + 0.4e0 * ((min(o_orderkey) * 104729 % 1000) / 1000e0) as q
              from orders group by 1, 2)""",
    "quotes": """
        select event_type as venue,
               'M' || cast(cast(json_extract_string(props, '$.k') as integer) % 4 as varchar)
                   as market,
               0.5e0 + (value % 10e0 - 5e0) / 500e0 - 0.006e0 as yes_bid,
               0.5e0 + (value % 10e0 - 5e0) / 500e0 + 0.006e0 as yes_ask,
               event_id as seq,
               epoch_us(ts) * 1000 as ts_ns,
               (epoch_us(ts) + event_id * 7919 % 20000 - 50) * 1000 as recv_ns
        from events""",
    "markets": """
        select p_partkey // 30 as listing,
               row_number() over (partition by p_partkey // 30 order by p_partkey) - 1 as pos,
               p_name as title, p_type as ticker,
               case when p_size % 5 = 0 then 'closed' else 'open' end as status
        from part""",
}
