"""URL filters: a trie over reversed host labels, then over path segments; the longest rule wins.

A rule has a host and a path prefix. It fits its host and all subdomains if the path starts with
its own. Rules on longer hosts win over rules on shorter ones, then longer paths over shorter;
of equal rules, block wins. Host labels are walked from the right; every node on the way may
hold a trie of paths, whose edges are whole segments and whose last edge is the beginning of
one.

A trie is broadcast only up to ``MOST`` rules. Larger lists are cut into tries of that size,
applied one after the other, each keeping the better of its rule and the one found before.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules in a broadcast trie, at most.
MOST = 100_000
ALLOW, BLOCK = "allow", "block"

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def length(self) -> tuple[int, int, int]:
        """What the longest match is judged by: host, path, then block before allow."""
        return len(self.host), len(self.path), int(self.verdict == BLOCK)


def rule(verdict: str, text: str) -> Rule:
    """A rule from a text like ``example.org/en/``."""
    if verdict not in (ALLOW, BLOCK):
        raise ValueError(f"a verdict is {ALLOW} or {BLOCK}, not {verdict}")
    host, slash, path = text.partition("/")
    return Rule(verdict, host.translate(_LOWER), slash + path)


class _Paths:
    """Path prefixes: whole segments lead on, the rest of a rule is the beginning of one."""

    def __init__(self) -> None:
        self.segments: dict[str, _Paths] = {}
        self.beginnings: dict[str, Rule] = {}
        self.most = 0

    def add(self, path: str, entry: Rule) -> None:
        *whole, rest = path.split("/")
        node = self
        for segment in whole:
            node = node.segments.setdefault(segment, _Paths())
        before = node.beginnings.get(rest)
        if before is None or entry.length > before.length:
            node.beginnings[rest] = entry
            node.most = max(node.most, len(rest))

    def longest(self, path: str) -> Rule | None:
        node: _Paths | None = self
        found = None
        start = 0
        while node is not None:
            stop = path.find("/", start)
            segment = path[start:] if stop < 0 else path[start:stop]
            if node.beginnings:
                for size in range(min(len(segment), node.most), -1, -1):
                    if segment[:size] in node.beginnings:
                        found = node.beginnings[segment[:size]]
                        break
            if stop < 0:
                break
            node, start = node.segments.get(segment), stop + 1
        return found


class Trie:
    def __init__(self, rules: Iterable[Rule]) -> None:
        self._root: list = [{}, None]  # labels that go on, and the paths of the rules that end here
        for entry in rules:
            node = self._root
            for label in reversed(entry.host.split(".")):
                node = node[0].setdefault(label, [{}, None])
            if node[1] is None:
                node[1] = _Paths()
            node[1].add(entry.path, entry)

    def longest(self, host: str, path: str) -> Rule | None:
        """The rule that wins for a URL; None if none fits."""
        found, node = None, self._root
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            if node[1] is not None:
                found = node[1].longest(path) or found
        return found


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lowered) and path of a URL; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    cut = min(ends, default=len(rest))
    path = rest[cut:]
    ends = [i for i in (path.find(c) for c in "?#") if i >= 0]
    return rest[:cut].translate(_LOWER), path[: min(ends, default=len(path))]


def judged(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    default: str = ALLOW,
    carry: Sequence[str] | None = None,
    most: int = MOST,
) -> DataFrame:
    """Columns ``carry`` (all if not given), then ``host``, ``path``, ``rule``, ``verdict``.

    ``rule`` is null and ``verdict`` the ``default`` where none fits. Null URLs and those without
    ``://`` have an empty host and path. Repeated rows are judged alike; an empty table gives no
    rows; own columns named like the new ones are replaced.
    """
    new = ("host", "path", "rule", "verdict")
    kept = [c for c in (pages.columns if carry is None else carry) if c.lower() not in new]
    frame = pages.select(*kept, F.col(url).cast("string").alias("_url_"))
    parts = [rules[i : i + most] for i in range(0, len(rules), most)] or [[]]
    for number, part in enumerate(parts):
        frame = _applied(frame, Trie(part), kept, default, number)
    return frame.drop("_url_", "_length_")


def _applied(frame: DataFrame, trie: Trie, kept: list[str], default: str, number: int) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast(trie)
    schema = frame.select(*kept, "_url_").schema
    for name in ("host", "path", "rule", "verdict"):
        schema = schema.add(name, T.StringType())
    schema = schema.add("_length_", T.ArrayType(T.IntegerType()))

    def run(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            earlier = batch.column("_length_").to_pylist() if number else []
            for row, value in enumerate(batch.column("_url_").to_pylist()):
                host, path = host_and_path(value)
                found = shared.value.longest(host, path)
                best = list(found.length) if found else None
                if number and earlier[row] is not None and (best is None or earlier[row] >= best):
                    rest = [batch.column(c)[row].as_py() for c in ("rule", "verdict")] + [earlier[row]]
                else:
                    rest = [found.text, found.verdict, best] if found else [None, default, None]
                for column, item in zip(columns, (host, path, *rest)):
                    column.append(item)
            own = [batch.column(c) for c in (*kept, "_url_")]
            made = [pa.array(c, pa.string()) for c in columns[:4]]
            lengths = pa.array(columns[4], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*own, *made, lengths], names=schema.names)

    return frame.mapInArrow(run, schema)


def filtered(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` whose URL is allowed; columns as they were."""
    slim = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(pages.columns)])
    place = pages.columns.index(url)
    kept = judged(slim, rules, f"c{place}", default).where(F.col("verdict") == ALLOW)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(pages.columns)])
