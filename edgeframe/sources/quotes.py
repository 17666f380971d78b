"""Quote messages: stream and batch sources, decoding with quarantine, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe import schemas
from edgeframe.defaults import TOPIC_PREFIX
from edgeframe.functions.numeric import mid, number

CORRUPT = "_corrupt_record"
_PAYLOAD = T.StructType([*schemas.QUOTE.fields, T.StructField(CORRUPT, T.StringType())])


def message_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    schema: T.StructType = schemas.MESSAGE,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of files landing under ``path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def kafka_messages(spark: SparkSession, servers: str, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Stream of all topics with the prefix; needs the Kafka package on the class path."""
    pattern = prefix.replace(".", "\\.") + ".*"
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .load()
        .select(
            "topic",
            F.col("value").cast("string").alias("payload"),
            (F.unix_micros("timestamp") * 1000).alias("recv_ns"),
        )
    )


def subscribe(messages: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Messages whose topic starts with the prefix, with the venue named by the topic."""
    return messages.where(F.col("topic").startswith(prefix)).withColumn(
        "topic_venue", F.expr(f"substring(topic, {len(prefix) + 1})")
    )


def _parse(messages: DataFrame) -> DataFrame:
    # Exploding a one-element array keeps later filters above the parse; pushed below it
    # they would each carry a copy of the parse and read the text several times.
    parsed = F.from_json("payload", _PAYLOAD, {"mode": "PERMISSIVE"})
    return messages.select("*", F.explode(F.array(parsed)).alias("_q"))


def _usable() -> Column:
    """Parsed completely, with positive bid and ask."""
    parsed = F.col("_q").isNotNull() & F.col(f"_q.{CORRUPT}").isNull()
    prices = (number(F.col("_q.yes_bid")) > 0) & (number(F.col("_q.yes_ask")) > 0)
    return parsed & F.coalesce(prices, F.lit(False))


def decode_quotes(messages: DataFrame, arrival: bool = False) -> DataFrame:
    """Quotes of the well-formed messages; missing seq, time and names get defaults.

    A missing sequence number becomes 0, or with ``arrival`` stays null: a stream then orders the
    quotes of feeds without numbers by their receive time.
    """
    quotes = _parse(messages).where(_usable())
    return quotes.select(
        F.coalesce("_q.venue", F.lit("")).alias("venue"),
        F.coalesce("_q.market", F.lit("")).alias("market"),
        "_q.yes_bid",
        "_q.yes_ask",
        F.coalesce("_q.seq", F.lit(None if arrival else 0)).cast("long").alias("seq"),
        F.coalesce("_q.ts_ns", "recv_ns").alias("ts_ns"),
        "recv_ns",
    )


def quarantine(messages: DataFrame) -> DataFrame:
    """Messages ``decode_quotes`` leaves out, with the reason."""
    rejected = _parse(messages).where(~_usable())
    malformed = F.col("_q").isNull() | F.col(f"_q.{CORRUPT}").isNotNull()
    reason = F.when(malformed, "malformed").otherwise("unusable price")
    return rejected.withColumn("reason", reason).drop("_q")


def encode(df: DataFrame, name: str = "payload", columns: list[str] | None = None) -> DataFrame:
    """Add the JSON text of the given columns (default all)."""
    return df.withColumn(name, F.to_json(F.struct(*(columns or df.columns))))


def latency_us() -> Column:
    """Microseconds from the quote's own time to its receipt; may be negative."""
    return (F.col("recv_ns") - F.col("ts_ns")) / F.lit(1000.0)


def with_mid(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("yes_mid", mid(F.col("yes_bid"), F.col("yes_ask")))
