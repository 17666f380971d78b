"""How often plans read their inputs."""

from pyspark.sql import functions as F

from edgeframe.plans import ingest
from edgeframe.sources import lake as lake_io


def _daily(spark, n, stations="ab"):
    rows = [(s, i, 60.0 + i % 7, 40.0, 50.0, 5.0) for s in stations for i in range(n)]
    frame = spark.createDataFrame(
        rows, "station string, i int, tmax_f double, tmin_f double, humidity double, wind_mph double"
    )
    return frame.withColumn("date", F.expr("date_add(date'2020-01-01', i)")).drop("i")


def test_ingest_reads_its_sources_for_one_table(spark, fresh, monkeypatch):
    paths = fresh("primary"), fresh("fallback")
    for path, n in zip(paths, (430, 90)):
        _daily(spark, n).write.parquet(path)
    seen = []
    build = ingest.build_features

    def watched(daily, *args):
        seen.append(daily._jdf.queryExecution().optimizedPlan().toString())
        return build(daily, *args)

    monkeypatch.setattr(ingest, "build_features", watched)
    out = fresh("lake")
    summary = ingest.ingest(spark, *(spark.read.parquet(p) for p in paths), out)
    assert summary["rows"] > 0
    (plan,) = seen
    assert plan.count("Relation") == 1 and "Join" not in plan


def test_mixed_sources_keep_given_labels_in_either_role(spark, fresh):
    given = _daily(spark, 430, "a").withColumns(
        {"label_high": F.lit(1), "market_yes_price": F.lit(0.25), "threshold_f": F.lit(70.0)}
    )
    plain = _daily(spark, 430, "b")
    for primary, fallback in ((given, plain), (plain, given)):
        out = fresh("lake")
        ingest.ingest(spark, primary, fallback, out)
        rows = lake_io.read_lake(spark, out)
        kept = rows.groupBy("station").agg(
            F.count("*").alias("n"), F.count("label_high").alias("labels"),
            F.count_if(F.col("market_yes_price") == 0.25).alias("given"),
        )
        found = {r.station: r for r in kept.collect()}
        assert set(found) == {"a", "b"}
        assert all(r.labels == r.n for r in found.values())
        assert found["a"].given == found["a"].n and found["b"].given < found["b"].n
