"""Corpus pipeline: toxicity, quality, near duplicates, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but the last return the
columns of ``documents``. ``run`` writes every stage's result as Parquet below the checkpoint folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempest.llm import op1_toxicity, op2_packing, op4_ngram_jaccard, op6_decontamination, op7_quality_model
from tempest.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score reaches the threshold of their language."""
    model = op1_toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op1_toxicity.without_toxic(docs, model)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity is over the threshold of their language."""
    trusted = op7_quality_model.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op7_quality_model.without_low_quality(docs, trusted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group. Of rows with equal ids the smallest row stays; rows
    with a null id stay."""
    comp = op4_ngram_jaccard.ngram_components(docs)
    first = comp.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(first, "doc_id", "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    one = named.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("r")).select("doc_id", "r.*").select(*docs.columns)
    return one.unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a window of a benchmark item."""
    return op6_decontamination.without_windows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: one row per token piece of the documents that are left."""
    import public_tokenizers

    return op2_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: The classifiers and the tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = materialize(stage(spark, out, sf_dir), f"stage-{name}")
    return out
