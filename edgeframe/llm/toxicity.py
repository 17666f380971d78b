"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as symbols: insult, threat, target, negation, report, or nothing. Five small
transducers watch the symbols of a clause - one per symbol kind - and are composed into one
automaton whose states are tuples of theirs. At the end of a clause the state tells which
pattern matched: an insult or a threat, aimed at somebody or not, denied or reported or neither.
A text's features are the weights of its matched clauses by pattern; a logistic model turns them
into a score. An insult that is denied or quoted so counts apart from one that is meant.

Insult words are fixed seeds plus stems learned from labelled texts: beginnings of words that
are surely more frequent in toxic texts. The learning sample has a bounded number of labelled
rows; scores read whole texts of all rows.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.llm.bpe import utf8
from edgeframe.llm.common import free_name, kept_in_worker, staged, text_of

#: Labelled rows that are learned from, at most.
SAMPLE = 20_000
#: Learned stems, at most.
STEMS = 4096
#: Letters of a learned stem.
SHORTEST, LONGEST = 4, 10
#: Lower bound of the log odds of a learned stem.
SURE = 2.2
#: Score from which a text counts as toxic.
THRESHOLD = 0.3
#: Pieces a worker remembers, and stems it counts before it hands its counts on.
MEMORY = 200_000
HELD = 200_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

# Word lists in English, German, French and Spanish.
SEEDS = {
    INSULT: "idiot moron loser scum trash pathetic worthless disgusting stupid clown dumb "
    "imbecile jerk fool dumm dummkopf trottel abschaum wertlos erbärmlich widerlich "
    "imbécile crétin débile minable ordure raclure abruti idiota imbécil estúpido basura "
    "escoria patético inútil asqueroso",
    THREAT: "kill hurt destroy beat shoot stab töten umbringen schlagen vernichten tuer "
    "frapper détruire matar golpear destruir",
    TARGET: "you your yours u he she they them him her du dich dir ihr euch sie er tu te toi "
    "vous il ils elle tú usted ustedes él ella ellos",
    NEGATION: "not no never isn aren don doesn without nicht kein keine nie niemals ne pas "
    "jamais aucun nunca jamás ningún",
    REPORT: "said says told wrote writes called quoted reported claims sagte sagt schrieb "
    "nannte behauptet dit disait écrit appelle dijo dice escribió llamó",
}

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_ENDS = frozenset(".!?;:,|")


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer: moves by (state, symbol); what is not listed stays."""

    start: int
    moves: dict[tuple[int, int], int]

    def step(self, state: int, symbol: int) -> int:
        return self.moves.get((state, symbol), state)


# Insult: seen or not, and before or after a negation or report (only what precedes governs).
GRAMMAR = {
    "insult": Transducer(0, {(0, INSULT): 1}),
    "threat": Transducer(0, {(0, THREAT): 1}),
    "target": Transducer(0, {(0, TARGET): 1}),
    "negation": Transducer(0, {(0, NEGATION): 1, (0, INSULT): 2, (0, THREAT): 2}),
    "report": Transducer(0, {(0, REPORT): 1, (0, INSULT): 2, (0, THREAT): 2}),
}
PATTERNS = ("insult", "insult_aimed", "threat", "threat_aimed", "denied", "reported")
FEATURES = len(PATTERNS) + 2


def pattern(insult: int, threat: int, target: int, negation: int, report: int) -> int:
    """The pattern a clause matched, from the final states; -1 for none."""
    if not insult and not threat:
        return -1
    if negation == 1:
        return 4
    if report == 1:
        return 5
    if insult:
        return 1 if target else 0
    # A threat word without a target is ordinary prose.
    return 3 if target else 2


def composed() -> tuple[dict[tuple[int, int], int], dict[int, int]]:
    """Moves and final patterns of the product of the transducers, over its reachable states."""
    parts = tuple(GRAMMAR.values())
    start = tuple(p.start for p in parts)
    names, todo, moves = {start: 0}, [start], {}
    while todo:
        state = todo.pop()
        for symbol in (INSULT, THREAT, TARGET, NEGATION, REPORT):
            after = tuple(p.step(s, symbol) for p, s in zip(parts, state))
            if after not in names:
                names[after] = len(names)
                todo.append(after)
            moves[names[state], symbol] = names[after]
    return moves, {name: pattern(*state) for state, name in names.items()}


@dataclass
class Model:
    """Stems with weights, and the logistic weights of the features."""

    stems: dict[str, float]
    weights: list[float]
    bias: float

    def to_json(self) -> str:
        return json.dumps([self.stems, self.weights, self.bias])

    @staticmethod
    def from_json(text: str) -> Model:
        return Model(*json.loads(text))


class Reader:
    """Features of texts. The events of a distinct piece of text are found once."""

    def __init__(self, stems: dict[str, float], memory: int = MEMORY) -> None:
        self._stems, self._memory = stems, memory
        self._sizes = sorted({len(s) for s in stems}, reverse=True)
        self._symbols = {w: s for s, words in SEEDS.items() for w in words.split()}
        self._moves, self._patterns = composed()
        self._forget()

    def _forget(self) -> None:
        self._place: dict[bytes, int] = {}
        self._codes = np.empty(0, np.int8)  # 0 nothing, 1 clause end, 2 events
        self._events: dict[int, list[tuple[int, float]]] = {}

    def symbol(self, word: str) -> tuple[int, float]:
        """Symbol and weight of a lower-case word."""
        for size in self._sizes:
            weight = self._stems.get(word[:size]) if len(word) >= size else None
            if weight is not None:
                return INSULT, weight
        found = self._symbols.get(word, OTHER)
        return found, 1.0 if found else 0.0

    def _learn(self, fresh: list[bytes]) -> None:
        codes = np.zeros(len(fresh), np.int8)
        first = len(self._place)
        for i, piece in enumerate(fresh):
            text = piece.decode("utf-8", "replace").lower()
            events = [e for e in map(self.symbol, _WORD.findall(text)) if e[0]]
            last = text[-1] in _CLAUSE_ENDS
            if events:
                codes[i] = 2
                self._events[first + i] = [*events, (END, 0.0)] if last else events
            elif last:
                codes[i] = 1
        self._place.update(zip(fresh, range(first, first + len(fresh))))
        self._codes = np.concatenate([self._codes, codes])

    def features(self, text: bytes) -> list[float]:
        """Log of one plus the weight of each pattern, matched clauses, and their share."""
        pieces = text.split()
        fresh = set(pieces).difference(self._place)
        if fresh:
            if len(self._place) + len(fresh) > self._memory:
                self._forget()
                fresh = set(pieces)
            self._learn(list(fresh))
        which = np.fromiter(map(self._place.__getitem__, pieces), np.int64, len(pieces))
        codes = self._codes[which]
        clause = np.cumsum(codes == 1)
        totals = [0.0] * len(PATTERNS)
        matched, state, weight, current, extra = 0, 0, 0.0, -1, 0
        at = np.flatnonzero(codes == 2)

        def close() -> None:
            nonlocal matched, state, weight
            found = self._patterns[state]
            if found >= 0:
                totals[found] += weight
                matched += 1
            state, weight = 0, 0.0

        for position, number in zip(which[at].tolist(), clause[at].tolist()):
            if number != current:
                close()
                current = number
            for symbol, value in self._events[position]:
                if symbol == END:
                    close()
                    extra += 1
                    continue
                state = self._moves[state, symbol]
                if symbol in (INSULT, THREAT):
                    weight += value
        close()
        clauses = 1 + extra + (int(clause[-1]) if len(clause) else 0)
        return [*(math.log1p(t) for t in totals), math.log1p(matched), 10.0 * matched / clauses]


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[list[float], float]:
    """Ridge logistic regression by damped Newton steps, to a small gradient."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(rows.shape[1], ridge)
    penalty[-1] = 1e-3
    theta = np.zeros(rows.shape[1])

    def loss(t: np.ndarray) -> float:
        z = rows @ t
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(penalty * t * t))

    now = loss(theta)
    while True:
        p = 1 / (1 + np.exp(-np.clip(rows @ theta, -40, 40)))
        gradient = rows.T @ (p - y) + penalty * theta
        if np.abs(gradient).max() < 1e-6 * max(1, len(y)):
            break
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty), gradient)
        size = 1.0
        while size > 1e-9 and loss(theta - size * step) >= now:
            size /= 2
        if size <= 1e-9:
            break
        theta = theta - size * step
        now = loss(theta)
    return theta[:-1].tolist(), float(theta[-1])


#: Without labelled rows of both kinds: a meant clause is enough, a denied or quoted one is not.
DEFAULT_WEIGHTS = [1.5, 2.5, 0.5, 2.0, -0.5, -0.5, 0.5, 0.0]
DEFAULT_BIAS = -2.0


def held_out(key: Column) -> Column:
    """Rows never learned from; a null key is learned from."""
    name = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(name), F.lit(4)) == 2


def _sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(``text``, ``toxic``) of at most ``bound`` labelled keys, picked by a hash of the key.

    Of rows with the same key one is taken, by a hash of its text, so that ``bound`` holds for rows.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # At most ``bound`` rows of two numbers, whatever the corpus: small enough to broadcast.
    joined = docs.join(F.broadcast(chosen), docs["_key"] == chosen["doc_id"])
    one = joined.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("_row"))
    return staged(one.select("_row.text", "toxic"), "toxicity-sample")


def _beginnings(text: bytes) -> set[str]:
    words = set(_WORD.findall(text.decode("utf-8", "replace").lower()))
    return {w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)}


def _stem_counts(sample: DataFrame) -> DataFrame:
    """(``stem``, ``toxic``, ``clean``): texts of the sample that have the stem."""

    def told(counts):
        names = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(names), 50_000):
            some = names[at : at + 50_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "stem": some,
                    "toxic": pa.array([counts[1][n] for n in some], pa.int64()),
                    "clean": pa.array([counts[0][n] for n in some], pa.int64()),
                }
            )

    def run(batches):
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                counts[bool(toxic)].update(_beginnings(text))
                if len(counts[0]) + len(counts[1]) > HELD:
                    yield from told(counts)
                    counts = (Counter(), Counter())
        yield from told(counts)

    found = sample.mapInArrow(run, "stem string, toxic long, clean long")
    return found.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _odds(a: Column, b: Column, toxic: int, clean: int) -> Column:
    """Lower bound (95 %) of the log odds ratio of a stem."""
    half = F.lit(0.5)
    no_a, no_b = F.lit(toxic) - a + half, F.lit(clean) - b + half
    ratio = F.log((a + half) / no_a) - F.log((b + half) / no_b)
    error = F.sqrt(1 / (a + half) + 1 / no_a + 1 / (b + half) + 1 / no_b)
    return ratio - 1.64 * error


def _stems(sample: DataFrame, toxic: int, clean: int, most: int) -> dict[str, float]:
    counts = _stem_counts(sample).withColumn(
        "odds", _odds(F.col("toxic"), F.col("clean"), toxic, clean)
    )
    sure = counts.where((F.col("odds") >= SURE) & (F.col("toxic") >= 3))
    rows = sure.orderBy(F.desc("odds"), "stem").limit(most).select("stem", "toxic", "odds").collect()
    seen = {r.stem: r.toxic for r in rows}
    # Of beginnings of one another, the longest that loses next to no text stands for all.
    longer = {t[:-1] for t, n in seen.items() if t[:-1] in seen and n >= 0.95 * seen[t[:-1]]}
    kept: dict[str, float] = {}
    for row in sorted(rows, key=lambda r: len(r.stem)):
        if row.stem not in longer and not any(row.stem[:k] in kept for k in range(len(row.stem))):
            kept[row.stem] = round(float(row.odds), 6)
    return kept


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    stems: int = STEMS,
) -> Model:
    """A model from at most ``sample`` labelled rows outside the held-out quarter.

    ``labels`` has ``doc_id`` and ``toxic``. Without rows of both labels, seeds and fixed weights.
    """
    rows = _sample(docs.select(F.col(key).alias("_key"), text_of(text).alias("text")), labels, sample)
    by_label = dict(rows.groupBy("toxic").count().collect())
    toxic, clean = by_label.get(1, 0), by_label.get(0, 0)
    seeds = {w: 1.0 for w in SEEDS[INSULT].split()}
    if not toxic or not clean:
        return Model(seeds, DEFAULT_WEIGHTS, DEFAULT_BIAS)
    model = Model({**seeds, **_stems(rows, toxic, clean, stems)}, [0.0] * FEATURES, 0.0)
    known = model.to_json()

    def run(batches):
        reader = _reader(known)
        for batch in batches:
            lists = [reader.features(t) for t in utf8(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(lists, pa.list_(pa.float64()))], names=["toxic", "x"]
            )

    found = rows.mapInArrow(run, "toxic int, x array<double>").collect()  # at most ``sample`` rows
    x = np.array([r.x for r in found])
    model.weights, model.bias = fitted(x, np.array([r.toxic for r in found], float))
    return model


def _reader(model: str) -> Reader:
    return kept_in_worker(("toxicity", model), lambda: Reader(Model.from_json(model).stems))


def scored(
    docs: DataFrame, model: Model, text: str = "text", score: str = "score", carry: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``carry``) with a score from 0 to 1; null text counts as empty."""
    kept = [c for c in (docs.columns if carry is None else carry) if c.lower() != score.lower()]
    known, weights, bias = model.to_json(), np.array(model.weights), model.bias
    # A text that is carried along is sent once.
    read = text if text in kept else free_name(docs.select(*kept), "_text_")
    rows = docs.select(*kept, *([] if text in kept else [F.col(text).cast("string").alias(read)]))
    schema = docs.select(*kept).schema.add(score, T.DoubleType())

    def run(batches) -> Iterator[pa.RecordBatch]:
        reader = _reader(known)
        for batch in batches:
            lists = [reader.features(t) for t in utf8(batch.column(read))]
            z = np.array(lists).reshape(-1, FEATURES) @ weights + bias
            values = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(values, pa.float64())], names=[*kept, score]
            )

    return rows.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Null keys stay null, repeated rows give repeated rows, an empty table gives none.
    """
    model = train(docs, labels, key, text, **options)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return scored(rows, model, carry=["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the texts whose score reaches the threshold; columns as they were."""
    model = train(docs, labels, key, text, **options)
    marked = scored(docs, model, text, score="_toxicity")
    return marked.where(F.col("_toxicity") < THRESHOLD).select(*docs.columns)
