"""The corpus pipeline: quality, near duplicates, benchmark leaks, personal data, packing. Each stage's table is written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm import decontamination, ngram_jaccard, packing, pii, quality_knn
from siftstone.runtime import materialize, sized, table


def beside(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work on doc_id, text and n_chars only; every other column of docs goes along in one struct, so none clashes with what work adds."""
    own = [c for c in docs.columns if c in ("doc_id", "text", "n_chars")]
    others = [c for c in docs.columns if c not in own]
    packed = docs.select(*own, F.struct(*others).alias("__others")) if others else docs
    return work(packed).select(*[F.col(f"__others.`{c}`").alias(c) if c in others else F.col(c) for c in docs.columns])


def recounted(rows: DataFrame, changed: Column) -> DataFrame:
    """n_chars, where there is such a column, follows a changed text."""
    if "n_chars" not in rows.columns:
        return rows
    return rows.withColumn("n_chars", F.when(changed, F.length("text").cast(rows.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality 1."""
    model = quality_knn.fit(spark, docs, table(spark, sf_dir, "labels"))
    return beside(docs, lambda d: quality_knn.score(spark, d, model).where("predicted = 1"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group of linked documents; of rows that share a doc_id, one. Rows without a doc_id stay."""
    links = ngram_jaccard.jaccard_join(spark, docs)
    facts = materialize(spark, links.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows")), "groups")
    gone = facts.where("doc_id <> component_id").select("doc_id")
    kept = docs.join(sized(gone, gone.count()), "doc_id", "left_anti")
    if not facts.where("doc_id is not null and rows > 1").isEmpty():
        kept = kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))
    return kept.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from others that hold one item's windows the hit words go, the rest stays."""
    bench = table(spark, sf_dir, "benchmark")
    return beside(docs, lambda d: recounted(decontamination.decontaminate(spark, d, bench, remove_spans=True).where("not contaminated"), F.col("n_hit") > 0))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every span of personal data replaced by its kind."""
    return beside(docs, lambda d: recounted(pii.find_pii(spark, d, mask=True), F.col("spans") != ""))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("personal_data", personal_data), ("pack", pack)]

#: No stage but the third is a matter of SQL; tests/llm/test_brute_force.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
