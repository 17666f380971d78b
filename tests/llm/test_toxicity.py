import zlib

import pytest

from edgeframe.llm import toxicity as tox


@pytest.fixture(scope="module")
def reader():
    return tox.Reader({w: 1.0 for w in tox.SEEDS[tox.INSULT].split()})


@pytest.mark.parametrize(
    ("text", "pattern"),
    [
        ("what a fine idiot", "insult"),
        ("You are an IDIOT!", "insult_aimed"),
        ("an idiot you are", "insult_aimed"),
        ("they kill time", "threat_aimed"),
        ("to kill a process", "threat"),
        ("you are not an idiot", "denied"),
        ("he said idiot", "reported"),
        ("er ist kein trottel", "denied"),
        ("a fine day", None),
        ("", None),
        ("you said not", None),
    ],
)
def test_patterns(reader, text, pattern):
    found = reader.features(text.encode())
    matched = {p for p, value in zip(tox.PATTERNS, found) if value}
    assert matched == ({pattern} if pattern else set())


def test_clauses_are_apart(reader):
    found = dict(zip(tox.PATTERNS, reader.features(b"I said no. You idiot, not here: moron")))
    assert found["insult_aimed"] and found["insult"] and not found["reported"] and not found["denied"]


def test_what_follows_does_not_govern(reader):
    found = dict(zip(tox.PATTERNS, reader.features(b"idiot not said")))
    assert found["insult"] and not found["denied"] and not found["reported"]


def test_composition_equals_running_the_parts():
    import itertools

    moves, patterns = tox.composed()
    parts = list(tox.GRAMMAR.values())
    for symbols in itertools.product(range(1, 6), repeat=4):
        state, own = 0, [p.start for p in parts]
        for s in symbols:
            state = moves[state, s]
            own = [p.step(x, s) for p, x in zip(parts, own)]
        assert patterns[state] == tox.pattern(*own)


def test_forgetting_changes_nothing():
    text = b"You idiot. a b c moron, said scum. x y z"
    assert tox.Reader({"idiot": 1.0}, memory=2).features(text) == tox.Reader({"idiot": 1.0}).features(text)


def _corpus(prose):
    docs, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        words = prose(80, i).translate(str.maketrans("aeiouy", "bcdfgh")).split()  # no real words
        if toxic:
            stem = "zorgle" if i % 8 else "blenku"
            for at in (5, 30, 55):
                words[at] = stem + "xyzab"[at % 5] + " you"
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_learned_stems_reach_held_out_rows(spark, frame, prose, odd):
    docs, labels = _corpus(prose)
    extra = [(1000 + (k or 0), t) for k, t in odd]
    known = spark.createDataFrame(labels + [(None, 1, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    rows = tox.report(frame(docs + extra + [(None, None)]), known).collect()
    assert len(rows) == len(docs) + len(extra) + 1
    toxic = {i for i, _, t in labels if t}
    assert any(r.held_out for r in rows) and not all(r.held_out for r in rows)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
        assert r.predicted == int(r.doc_id in toxic)


def test_held_out_labels_change_nothing(spark, frame, prose):
    docs, labels = _corpus(prose)
    out = {i for i, *_ in labels if zlib.crc32(str(i).encode()) % 4 == 2}
    lies = [(i, q, 1 - t if i in out else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    first = tox.train(frame(docs), spark.createDataFrame(labels, schema))
    second = tox.train(frame(docs), spark.createDataFrame(lies, schema))
    assert first.stems == second.stems
    assert first.weights == pytest.approx(second.weights)


def test_without_labels_and_empty(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r.predicted for r in tox.report(frame([(1, "you idiot moron"), (2, "hello")]), none).collect()}
    assert rows == {1: 1, 2: 0}
    assert tox.report(frame([(1, "a")]).where("false"), none).count() == 0


def test_stage_keeps_clean_rows_whole(spark, frame, prose, odd):
    docs, labels = _corpus(prose)
    kept = tox.accepted(frame(docs + odd), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == ["doc_id", "text", "_row", "score", "ids"]
    toxic = {i for i, _, t in labels if t}
    wanted = sorted([(k, t) for k, t in docs + odd if k not in toxic or (k, t) in odd], key=str)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == wanted
    assert all(r.score == "x" for r in kept.collect())


def test_repeated_ids_do_not_widen_the_sample(spark, frame):
    rows = [(i % 40, f"text {i} you idiot" if i % 2 else f"text {i}") for i in range(400)]
    docs = frame(rows).selectExpr("doc_id as _key", "text")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert tox._sample(docs, labels, 10).count() == 10
    assert tox._sample(docs, labels, 1000).count() <= 40
