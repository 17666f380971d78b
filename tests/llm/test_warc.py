import gzip
import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from edgeframe.llm import warc

LONG = "<p>equal payload</p>" * 10
PAGES = [
    (5, "http://a.example.org/x", LONG),
    (3, "http://b.example.org/y?q", LONG),
    (9, "http://a.example.org/x", LONG),
    (9, "http://a.example.org/x", LONG),
    (1, "http://c.org/", "short"),
    (2, "http://c.org/", "short"),
    (4, None, None),
    (6, "http://d.org/\r\nX: y", ""),
    (7, "http://d.org/é", "é\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\nnested\r\n\r\n" * 5),
    (8, "no mark", "x" * 200_000),
    (None, "http://a.example.org/x", LONG),
    (None, "http://e.org", "y" * 150),
    (10, "http://e.org", "y" * 150),
    (11, "http://e.org", "\ufeffé\x00\x85 \x0b"),
]


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(parts)


def _expected(rows):
    first = {}
    for key, _, html in rows:
        if key is not None and len((html or "").encode()) >= 100:
            first[html] = min(key, first.get(html, key))
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        to = first.get(html) if len(body) >= 100 else None
        revisit = to is not None and (key is None or key > to)
        out.append(
            (key, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", to if revisit else None)
        )
    return sorted(out, key=str)


def test_round_trip(spark):
    found = warc.report(_frame(spark, PAGES)).collect()
    assert sorted([tuple(r)[:5] for r in found], key=str) == _expected(PAGES)
    assert sorted(r.position for r in found) == list(range(len(PAGES)))


def test_history_is_in_order(spark, prose):
    rng = random.Random(0)
    rows = [(i, f"http://{rng.choice('abc')}.org/{rng.choice(['', 'x', 'é'])}", prose(3, i)) for i in range(400)]
    rows += [(1000 + i, "http://hot.org/", "h") for i in range(300)]
    found = sorted(warc.report(_frame(spark, rows, 7)).collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(700))
    keys = [(r.url_key, r.page_id) for r in found]
    assert keys == sorted(keys)


def test_files_are_warc_records(spark, fresh):
    path = fresh("warc")
    warc.write(_frame(spark, PAGES), path)
    data = b"".join(
        gzip.open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.endswith(".gz")
    )
    seen = []
    while data:  # a reader that goes by length alone
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.0"
        fields = dict(line.split(b": ", 1) for line in lines[1:])
        length = int(fields[b"Content-Length"])
        body, data = rest[:length], rest[length:]
        assert data.startswith(b"\r\n\r\n")
        data = data[4:]
        if fields[b"WARC-Type"] == b"response":
            assert fields[b"WARC-Payload-Digest"] == b"sha256:" + hashlib.sha256(body).hexdigest().encode()
        else:
            assert length == 0 and re.fullmatch(rb"<urn:page:\d+>", fields[b"WARC-Refers-To"])
        seen.append(fields[b"WARC-Record-ID"])
    assert len(seen) == len(PAGES)


def test_payloads_come_back(spark, fresh):
    path = fresh("warc")
    records = warc.read(spark, path, warc.write(_frame(spark, PAGES), path)).collect()
    bodies = {r.page_id: bytes(r.payload).decode() for r in records if r.record_type == "response" and r.page_id}
    for key, _, html in PAGES:
        if key in bodies:
            assert bodies[key] == (html or "")


def test_damage_is_an_error(spark, fresh):
    path = fresh("warc")
    archive = warc.write(_frame(spark, PAGES, 1).coalesce(1), path)
    lines = spark.read.option("lineSep", warc._start(archive)).text(path).where("value != ''")
    record = F.concat(F.lit(warc._start(archive)), F.expr("substr(value, 1, length(value) - 4)"))
    broken = fresh("broken")
    changed = lines.select(F.regexp_replace(record, "short", "shorx").alias("value"))
    changed.write.option("lineSep", "\r\n\r\n").text(broken)
    with pytest.raises(Exception, match="damaged record"):
        warc.read(spark, broken, archive).collect()


@pytest.mark.parametrize("count", [0, 1, 2, 3, 7, 16])
def test_loser_tree(count):
    rng = random.Random(count)
    runs = [sorted(rng.choices(range(20), k=rng.choice([0, 1, 5, 30]))) for _ in range(count)]
    found = list(warc.loser_tree([iter(r) for r in runs]))
    assert found == sorted(((i, v) for i, r in enumerate(runs) for v in r), key=lambda x: (x[1], x[0]))


def test_empty_table(spark):
    assert warc.report(_frame(spark, PAGES).where("false")).count() == 0
