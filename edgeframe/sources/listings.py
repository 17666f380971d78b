"""Market listings: JSON documents to rows, and the open-weather-market filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe import schemas
from edgeframe.defaults import LISTING_LIMIT, LISTING_WORDS


def parse_listings(documents: DataFrame, key: str = "listing", body: str = "body") -> DataFrame:
    """One row per market of each listing document, numbered in document order."""
    parsed = F.from_json(body, schemas.LISTING)
    return documents.select(key, F.posexplode(parsed["markets"]).alias("pos", "m")).select(
        key, "pos", "m.title", "m.ticker", "m.status"
    )


def mentions(words: list[str], *columns: str) -> Column:
    """True where the joined lower-case text contains any of ``words``."""
    text = F.lower(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in columns]))
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def weather_listings(
    markets: DataFrame,
    key: str = "listing",
    limit: int = LISTING_LIMIT,
    words: list[str] | None = None,
) -> DataFrame:
    """First ``limit`` open markets per listing, narrowed to weather if any of them match.

    A listing has at most ``limit`` rows when the second window sees it, so it is bounded.
    """
    order = Window.partitionBy(key).orderBy("pos")
    return (
        markets.where(F.col("status") == "open")
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= limit)
        .withColumn("_match", mentions(words or LISTING_WORDS, "title", "ticker"))
        .withColumn("_any", F.max("_match").over(Window.partitionBy(key)))
        .where(F.col("_match") | ~F.col("_any"))
        .drop("_n", "_match", "_any")
    )
