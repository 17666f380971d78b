"""One query per operator, over its whole table: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeframe.llm import (
    bpe,
    exact,
    minhash,
    mixing,
    packing,
    secrets,
    sharding,
    topk,
    toxicity,
    trie,
    urls,
    warc,
    whitening,
)
from edgeframe.llm.common import table


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The rules that the URL query judges by.
RULES = [
    urls.rule("allow", "org/"),
    urls.rule("block", "example.org/es/"),
    urls.rule("block", "example.org/en/1"),
    urls.rule("allow", "com/fr/"),
    urls.rule("block", "com/de/"),
]


def op1_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), vocabulary_path())


def op3_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judged(table(spark, sf, "pages"), RULES, carry=["page_id"])


def op4_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.report(table(spark, sf, "documents"))


def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.report(table(spark, sf, "pages"))


def op6_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.report(table(spark, sf, "documents"))


def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.report(table(spark, sf, "documents"))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_exact(spark: SparkSession, sf: str) -> DataFrame:
    return exact.report(table(spark, sf, "documents"))


def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(table(spark, sf, "documents"), vocabulary_path())


def op11_trie(spark: SparkSession, sf: str) -> DataFrame:
    return trie.nodes(table(spark, sf, "conversations"), rebuilt=True)


def op12_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(table(spark, sf, "documents"))


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened(table(spark, sf, "embeddings"))


QUERIES = {
    "op1_topk": op1_topk,
    "op2_packing": op2_packing,
    "op3_urls": op3_urls,
    "op4_minhash": op4_minhash,
    "op5_warc": op5_warc,
    "op6_sharding": op6_sharding,
    "op7_secrets": op7_secrets,
    "op8_toxicity": op8_toxicity,
    "op9_exact": op9_exact,
    "op10_bpe": op10_bpe,
    "op11_trie": op11_trie,
    "op12_mixing": op12_mixing,
    "op13_whitening": op13_whitening,
}
