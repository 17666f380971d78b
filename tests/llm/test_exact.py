import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from edgeframe.llm import exact


def _expected(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), key is None, key or 0, key))
    out = []
    for body, members in groups.items():
        members.sort(key=lambda m: m[:3])
        digest = hashlib.sha256(body.encode()).hexdigest()
        for n, m in enumerate(members):
            out.append((m[3], members[0][3], len(members), n == 0, digest))
    return sorted(out, key=str)


ROWS = [(5, "a b"), (6, "ab"), (7, " a  b "), (8, "a b"), (9, "x" * 5000), (10, "x" * 5000), (11, "éa"), (12, "éa")]


def test_against_a_plain_grouping(frame, odd):
    rows = odd + ROWS
    found = sorted(map(tuple, exact.report(frame(rows)).collect()), key=str)
    assert found == _expected(rows)


def test_colliding_hashes_are_told_apart(frame, odd):
    rows = odd + ROWS
    weak = lambda text: F.length(text) % 2  # noqa: E731  almost everything collides
    found = sorted(map(tuple, exact.report(frame(rows), fingerprint=weak).collect()), key=str)
    assert found == _expected(rows)


def test_stage_keeps_one_of_each(frame, odd):
    kept = exact.deduplicated(frame(odd + ROWS))
    assert kept.columns == ["doc_id", "text", "_row", "score", "ids"]
    bodies = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    wanted = {re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in odd + ROWS}
    assert sorted(bodies) == sorted(wanted)


def test_empty_table(frame):
    assert exact.report(frame([(1, "a")]).where("false")).count() == 0


def test_no_python_in_the_plan(frame):
    plan = exact.report(frame(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
