"""Secret scans with credential linking. DataFrame functions only.

Strong patterns are reported wherever they match. Weak ones - identifiers, secrets and endpoints
that mean little alone - are reported only if complementary parts lie within ``REACH`` code
points. Matches are found as arrays of lengths in one scan of the texts (what ``split`` leaves
between matches and the matches themselves); positions are running sums over the exploded
lengths. Parts are joined as intervals: each is entered in the cells of width ``REACH`` that it
touches, cells are reduced to the first start and last end of each class, and a weak part looks
at its own and the neighbouring cells, so the work is linear in the number of parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.llm.common import free_name, staged, text_of

#: Code points between complementary parts, at most.
REACH = 400


@dataclass(frozen=True)
class Kind:
    """A kind of match; ``part`` is what it adds to a credential: id, secret or endpoint."""

    name: str
    part: str
    pattern: str
    hint: str  # a cheaper pattern that every text with a match has
    group: int = 0  # the group that ``least`` and ``mixed`` look at
    least: int = 0
    mixed: bool = False  # upper case, lower case and digits are asked for
    strong: bool = False


KINDS = (
    Kind(
        "assign",
        "secret",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"(?i)(?:passw|secret|token|api_?key)",
        group=2,
        least=8,
        strong=True,
    ),
    Kind("access", "id", r"AKIA[A-Z0-9]+", "AKIA", least=16, strong=True),
    Kind("hex", "secret", r"[0-9a-f]+", r"[0-9a-f]{32}", least=32, strong=True),
    Kind(
        "key_id",
        "id",
        r"""(?i)(?:client|access|account|user)_?(?:key_?)?(?:id|name)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]+)""",
        r"(?i)(?:client|access|account|user)_?(?:key_?)?(?:id|name)",
        group=1,
        least=6,
    ),
    Kind(
        "key_secret",
        "secret",
        r"[A-Za-z0-9+/=_-]{32,}",
        r"[A-Za-z0-9+/=_-]{32}",
        mixed=True,
    ),
    Kind(
        "endpoint",
        "endpoint",
        r"""(?i)[a-z][a-z0-9+]*://[^\x00-\x20"'<>]+""",
        "://",
    ),
)
ORDER = {kind.name: i for i, kind in enumerate(KINDS)}

#: A weak part of one kind is reported if any of these sets of classes is near it.
NEEDS = {
    "id": [["secret"]],
    "secret": [["id"], ["endpoint"]],
    "endpoint": [["id", "secret"]],
}


def _accepted(kind: Kind, text: Column) -> Column:
    """Whether each match of the pattern counts."""
    looked = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    test = F.lit(True)

    def accept(match: Column) -> Column:
        held = (F.length(match) >= kind.least) if kind.least else test
        if kind.mixed:
            for letters in ("[A-Z]", "[a-z]", "[0-9]"):
                held = held & match.rlike(letters)
        return held

    return F.transform(looked, accept)


def _matches(kind: Kind, text: Column) -> Column:
    """Array of (kind, gap, size, ok): each match and what lies between it and the one before."""
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.length)
    rows = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"),
        sizes.alias("size"),
        _accepted(kind, text).alias("ok"),
    )
    rows = F.transform(
        rows,
        lambda r, i: F.struct(
            F.lit(ORDER[kind.name]).alias("kind"), i.alias("at"), r["gap"].alias("gap"),
            r["size"].alias("size"), r["ok"].alias("ok"),
        ),
    )
    return F.when(F.contains(text, F.lit(kind.hint)) if _plain(kind.hint) else text.rlike(kind.hint), rows)


def _plain(hint: str) -> bool:
    return not set(hint) & set(r"\[](){}?*+.|^$")


def parts(scanned: DataFrame) -> DataFrame:
    """(``_row``, ``kind``, ``start``, ``end``) of the matches that count, in code points."""
    found = None
    for kind in KINDS:
        rows = scanned.where(F.size(f"_{kind.name}") > 0).select(
            "_row", F.explode(f"_{kind.name}").alias("m")
        )
        found = rows if found is None else found.unionAll(rows)
    # The matches of one document are at most its text, which is one row of the input.
    before = Window.partitionBy("_row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        found.select("_row", "m.*")
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
        .where("ok")
        .select("_row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    )


def _class(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k.part) for k in KINDS]), kind + 1)


def _in_cells(spans: DataFrame, reach: int, around: int) -> DataFrame:
    """Spans once for each cell they touch, and ``around`` cells more on both sides."""
    cells = F.sequence(
        (F.floor(F.col("start") / reach) - around), (F.floor((F.col("end") - 1) / reach) + around)
    )
    return spans.withColumn("cell", F.explode(cells))


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak spans near complementary parts; those inside a strong span are left out.

    Two spans are near if at most ``reach`` code points lie between them. A weak secret that ends
    with an assignment, as in ``my_token=...``, is the same one with more of its name, and left
    out too; other weak spans that contain or cross a strong one are kept.
    """
    strong = [ORDER[k.name] for k in KINDS if k.strong]
    weak = spans.where(~F.col("kind").isin(strong))
    cells = _in_cells(spans, reach, 0).withColumn("part", _class(F.col("kind")))
    # A cell of ``reach`` code points is one row per class, however many parts it has.
    summary = cells.groupBy("_row", "cell", "part").agg(
        F.min("start").alias("first"), F.max("end").alias("last")
    )
    wide = _in_cells(weak, reach, 1)
    near = wide.join(summary, ["_row", "cell"]).where(
        (F.col("first") - F.col("end") <= reach) & (F.col("start") - F.col("last") <= reach)
    )
    seen = near.groupBy("_row", "kind", "start", "end").agg(F.collect_set("part").alias("near"))
    held = F.lit(False)
    for part, options in NEEDS.items():
        for option in options:
            asked = F.array(*[F.lit(p) for p in option])
            held = held | (
                (_class(F.col("kind")) == part) & (F.size(F.array_except(asked, F.col("near"))) == 0)
            )
    held_spans = seen.where(held).select("_row", "kind", "start", "end")
    covers = cells.where(F.col("kind").isin(strong)).select(
        "_row", "cell", F.col("start").alias("from"), F.col("end").alias("to"),
        (F.col("kind") == ORDER["assign"]).alias("assigned"),
    )
    named = F.col("assigned") & (F.col("end") == F.col("to")) & (F.col("kind") == ORDER["key_secret"])
    inside = (
        _in_cells(held_spans, reach, 0)
        .join(covers, ["_row", "cell"])
        .where(((F.col("from") <= F.col("start")) & (F.col("end") <= F.col("to"))) | named)
        .select("_row", "kind", "start", "end")
    )
    return held_spans.join(inside, ["_row", "kind", "start", "end"], "left_anti")


def scan(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = (), reach: int = REACH
) -> tuple[DataFrame, DataFrame]:
    """Rows (``carry``, ``_row``) of all documents, and their spans (``_row``, ``kind``, ...).

    Whole texts are read; null counts as empty. Repeated rows are told apart by ``_row``.
    """
    body = text_of(text)
    scanned = staged(
        docs.select(
            *[F.col(c) for c in carry],
            F.monotonically_increasing_id().alias("_row"),
            *[_matches(kind, body).alias(f"_{kind.name}") for kind in KINDS],
        ),
        "secrets-scanned",
    )
    found = staged(parts(scanned), "secrets-parts")
    strong = found.where(F.col("kind").isin([ORDER[k.name] for k in KINDS if k.strong]))
    return scanned.select(*carry, "_row"), strong.unionByName(linked(found, reach))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    entry = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(entry, ",")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document with the counts and spans of the contract.

    Documents without spans have counts of 0 and empty lists; a null key stays null; repeated
    rows give repeated rows; an empty table gives none.
    """
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows, spans = scan(named, "text", ["doc_id"], reach)
    span = F.struct("start", "kind", "end")
    strong = F.col("kind").isin([ORDER[k.name] for k in KINDS if k.strong])

    def many(name: str) -> Column:
        return F.count_if(F.col("kind") == ORDER[name]).alias(f"n_{name}")

    per_row = spans.groupBy("_row").agg(
        many("assign"), many("access"), many("hex"),
        F.array_sort(F.collect_list(F.when(strong, span))).alias("_base"),
        F.array_sort(F.collect_list(span)).alias("_all"),
    )
    empty = F.lit("")
    return (
        rows.join(per_row, "_row", "left")
        .select(
            "doc_id",
            *[F.coalesce(f"n_{n}", F.lit(0).cast("long")).alias(f"n_{n}") for n in ("assign", "access", "hex")],
            F.sha2(F.coalesce(_listed(F.col("_base")), empty), 256).alias("base_sha256"),
            F.coalesce(_listed(F.col("_all")), empty).alias("spans"),
        )
    )


def redacted(
    docs: DataFrame, text: str = "text", mark: str = "[REDACTED]", reach: int = REACH
) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; rows and columns stay.

    Overlapping spans count as one. A column ``n_chars``, if there, follows the new text.
    """
    row = free_name(docs, "_place")
    placed = staged(docs.withColumn(row, F.monotonically_increasing_id()), "secrets-docs")
    rows, spans = scan(placed, text, [row], reach)
    in_doc = Window.partitionBy("_row").orderBy("start", "end")
    earlier = in_doc.rowsBetween(Window.unboundedPreceding, -1)
    merged = (
        spans.withColumn("_reached", F.max("end").over(earlier))
        .withColumn("_new", (F.col("_reached").isNull() | (F.col("start") > F.col("_reached"))).cast("int"))
        .withColumn("_nr", F.sum("_new").over(in_doc.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_row", "_nr")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    )
    cuts = rows.join(merged, "_row").select(row, "_spans")
    joined = placed.join(cuts, row, "left")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_spans", lambda s: s["end"]))
    starts = F.concat(
        F.transform("_spans", lambda s: s["start"]), F.array(F.length(text).cast("long"))
    )
    kept = F.transform(
        F.arrays_zip(ends.alias("a"), starts.alias("b")),
        lambda s: F.substring(F.col(text), (s["a"] + 1).cast("int"), (s["b"] - s["a"]).cast("int")),
    )
    clean = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(F.array_join(kept, mark))
    columns = {text: clean}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length(clean))
    return joined.select(
        *[columns[c].cast(docs.schema[c].dataType).alias(c) if c in columns else F.col(c) for c in docs.columns]
    )
