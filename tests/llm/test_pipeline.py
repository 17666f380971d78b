import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.dtypes == docs.dtypes, name
        counts.append(after.count())
        docs = after
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[2]
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact", "minhash", "secrets", "packing"]


def test_run_packs_what_is_left(spark):
    rows = pipeline.run(spark, SF).collect()
    assert rows and all(r.offset + r.length <= 4096 for r in rows)
