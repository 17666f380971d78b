"""WARC archives: writing records, reading them back, and a globally ordered capture index.

Records are text rows: Spark's text writer puts the blank lines that end a record between them,
commits each file once, and writes to any store. Every record begins with the version line and
the identifier of this archive, drawn anew for each, so no payload can hold it; the reader
splits at it, record by record, and then checks every length and digest.

Of equal payloads of at least ``LEAST`` bytes the one with the smallest id is stored, the others
are revisit records that refer to it.

The index is merged from runs. Each input task writes its captures sorted by URL key and time (a
run); keys are then split into ranges over all runs, and each range merges the runs' pieces with
a loser tree. A key with very many captures is split too, since ranges are over key, time and id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeframe.llm.common import staged, text_of
from edgeframe.llm.sharding import positioned
from edgeframe.storage import scratch

#: Shortest payload that a revisit record may stand for.
LEAST = 100
#: Captures that one task merges, on average.
RANGE_ROWS = 200_000
#: Where a table has no capture time: seconds after this one, by id.
EPOCH = 1_700_000_000
YEARS = 10 * 365 * 86_400

BREAK = "\r\n"
VERSION = "WARC/1.0"


def url_key(url: Column) -> Column:
    """Host labels from the right, then what follows: ``org,example)/en/1``; '' for null."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[^:/?#]*://", "")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    labels = F.concat_ws(",", F.reverse(F.split(F.lower(host), r"\.", -1)))
    after = F.substr(rest, F.length(host) + 1)
    return F.when(url.isNull(), F.lit("")).otherwise(F.concat(labels, F.lit(")"), after))


def _captured(key: Column) -> Column:
    seconds = F.lit(EPOCH) + F.coalesce(F.pmod(key, F.lit(YEARS)), F.lit(0))
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def planned(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Records to write: id, URL, payload, digest, and what a revisit refers to."""
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        text_of(html).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    # Many copies are one row per task before they are shuffled.
    shared = (
        rows.where(F.octet_length("payload") >= LEAST)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and first is not null")
        .drop("_n")
    )
    # A written table has no partitioning of its own, so Spark may split a payload's many copies.
    shared = staged(shared, "warc-shared")
    later = F.coalesce(F.col("page_id") > F.col("first"), F.col("first").isNotNull())
    return rows.join(shared, "digest", "left").withColumn("refers_to", F.when(later, F.col("first")))


def _start(archive: str) -> str:
    return f"{VERSION}{BREAK}WARC-Warcinfo-ID: <urn:uuid:{archive}>{BREAK}"


def _name(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">"))


def write(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html"
) -> str:
    """Write an archive of ``pages`` under ``path`` (gzip); the identifier of the archive."""
    archive = str(uuid.uuid4())
    rows = planned(pages, key, url, html)
    revisit = F.col("refers_to").isNotNull()
    payload = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    # A line break in a URL would end its header line.
    safe = F.translate("url", "\r\n", "  ")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(BREAK))

    def line_if(test: Column, name: str, value: Column) -> Column:
        return F.when(test, line(name, value)).otherwise(F.lit(""))

    record = F.concat(
        F.lit(_start(archive)),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _name(F.col("page_id"))),
        line("WARC-Date", _captured(F.col("page_id"))),
        line_if(safe.isNotNull(), "WARC-Target-URI", safe),
        line_if(revisit, "WARC-Refers-To", _name(F.col("refers_to"))),
        line_if(
            revisit,
            "WARC-Profile",
            F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
        ),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(payload).cast("string")),
        F.lit(BREAK),
        payload,
    )
    rows.select(record.alias("value")).write.option("lineSep", BREAK * 2).option(
        "compression", "gzip"
    ).text(path)
    return archive


def read(spark: SparkSession, path: str, archive: str) -> DataFrame:
    """Records of an archive: ids, URL, date, type, digest, length and payload.

    A record whose length or digest does not hold is an error.
    """
    lines = spark.read.option("lineSep", _start(archive)).text(path).where("value != ''")
    cut = F.instr("value", BREAK * 2)
    parts = lines.withColumn("_head", F.concat(F.substr("value", F.lit(1), cut - 1), F.lit(BREAK)))

    def field(name: str, pattern: str = "([^\r\n]*)") -> Column:
        found = F.regexp_extract("_head", f"(?:^|\n){name}: {pattern}\r\n", 1)
        return F.when(F.col("_head").rlike(f"(?:^|\n){name}: "), found)

    first = F.octet_length("_head") + 2
    body = F.substring(F.col("value").cast("binary"), first + 1, F.col("length").cast("int"))
    whole = F.octet_length("value") == first + F.col("length") + 4
    rows = parts.select(
        "value",
        "_head",
        F.expr("try_cast(regexp_extract(_head, 'WARC-Record-ID: <urn:page:(-?[0-9]+)>', 1) as long)").alias("page_id"),
        F.expr("try_cast(regexp_extract(_head, 'WARC-Refers-To: <urn:page:(-?[0-9]+)>', 1) as long)").alias("refers_to"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Date").alias("captured"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]*)").alias("digest"),
        field("Content-Length").cast("long").alias("length"),
    ).withColumn("payload", F.when(whole, body))
    sound = F.col("payload").isNotNull() & (
        (F.col("record_type") == "revisit") | (F.sha2("payload", 256) == F.col("digest"))
    )
    message = F.concat(F.lit("damaged record "), F.coalesce(F.col("page_id").cast("string"), F.lit("without id")))
    return rows.withColumn(
        "payload", F.when(sound, F.col("payload")).otherwise(F.raise_error(message).cast("binary"))
    ).drop("value", "_head")


def captures(records: DataFrame) -> DataFrame:
    """The index rows of records; a revisit takes its length from the record it refers to."""
    rows = records.select(
        url_key(F.col("url")).alias("url_key"),
        "captured",
        "page_id",
        "record_type",
        "refers_to",
        "digest",
        F.octet_length("payload").cast("long").alias("_bytes"),
    )
    rows = staged(rows, "warc-captures")
    stored = (
        rows.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), "digest")
        .agg(F.max("_bytes").alias("_stored"))
    )
    stored = staged(stored, "warc-stored")
    revisits = rows.where("record_type = 'revisit'").join(stored, ["refers_to", "digest"], "left")
    sizes = F.coalesce("_stored", F.raise_error("a revisit of a record that is not there").cast("long"))
    return (
        rows.where("record_type = 'response'")
        .withColumn("bytes", F.col("_bytes"))
        .unionByName(revisits.withColumn("bytes", sizes).drop("_stored"))
        .drop("_bytes")
    )


def loser_tree(runs: Sequence[Iterator]) -> Iterator[tuple[int, object]]:
    """(run, item) in ascending order of items; every run ascends. Of equal items the first run wins."""
    count = len(runs)
    heads = [next(run, None) for run in runs]
    tree = [-1] * max(1, count)  # losers of the matches; the overall winner at 0

    def beats(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[a] is not None or (heads[b] is None and a < b)
        return heads[a] < heads[b] or (heads[a] == heads[b] and a < b)

    def play(winner: int) -> None:
        node = (winner + count) // 2
        while node:
            if tree[node] < 0:
                tree[node] = winner
                return
            if beats(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2
        tree[0] = winner

    for run in range(count):
        play(run)
    while count and heads[tree[0]] is not None:
        winner = tree[0]
        yield winner, heads[winner]
        heads[winner] = next(runs[winner], None)
        play(winner)


KEYS = ("url_key", "captured", "page_id")


def merged(index: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``index`` in the order of URL key, time and id over all rows, with ``position``."""
    runs = staged(
        index.sortWithinPartitions(*KEYS).withColumn("_run", F.spark_partition_id()), "warc-runs"
    )
    partitions = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, -(-runs.count() // range_rows))
    dealt = runs.repartitionByRange(ranges, *KEYS, "_run").sortWithinPartitions("_run", *KEYS)
    names = index.columns

    def run(batches) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if rows is None or not len(rows):
            return
        numbers = rows.column("_run").to_numpy()
        columns = [rows.column(k).to_pylist() for k in KEYS]
        edges = [0, *(i for i in range(1, len(numbers)) if numbers[i] != numbers[i - 1]), len(numbers)]

        def piece(first: int, last: int) -> Iterator[tuple]:
            for i in range(first, last):
                page = columns[2][i]
                yield columns[0][i], columns[1][i], page is not None, page or 0, i

        order = [item[-1] for _, item in loser_tree([piece(a, b) for a, b in zip(edges, edges[1:])])]
        result = rows.take(pa.array(order, pa.int64())).select(names)
        yield from result.to_batches(max_chunksize=10_000)

    ordered = dealt.mapInArrow(run, index.schema)
    placed = staged(ordered.withColumn("_place", F.monotonically_increasing_id()), "warc-index")
    numbered = positioned(placed.withColumn("_one", F.lit(1)), "_one")
    return numbered.select(*names, F.col("_number").alias("position"))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` to an archive in the shared folder, read it back and merge its index.

    Null payloads count as empty and null URLs have an empty key; rows without an id are stored
    but nothing refers to them. Repeated rows with the smallest id of a payload are all
    responses. An empty table gives no rows. Lengths and digests are those of the payloads read.
    """
    path = scratch(pages.sparkSession, "warc")
    archive = write(pages, path, key, url, html)
    return merged(captures(read(pages.sparkSession, path, archive)))


def report(pages: DataFrame, **columns: str) -> DataFrame:
    """One row per page, with the columns of the contract, ``url_key`` and ``position``."""
    return round_trip(pages, **columns).select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        "url_key",
        "position",
    )
