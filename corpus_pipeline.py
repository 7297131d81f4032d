"""From raw documents to a training mix: classify, deduplicate, decontaminate, weigh.

Every stage works on all that the one before kept, written as Parquet to the shared folder and read again.
All stages but the last return the columns of ``documents``; the last adds domain, rate and copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import decontamination, mixing, near_duplicates, quality, substring_dedup
from tableferry.llm.shared import by_ids
from tableferry.session import new_folder

# Words of a repeated passage; shorter repeats are common phrases.
PASSAGE_WORDS = 30


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls good."""
    network = quality.fitted(docs, _table(spark, sf_dir, "labels"))
    return quality.scored(docs, network).where("predicted = 1").select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words to a shingle, similarity 0.8."""
    found = near_duplicates.near_duplicates(docs, size=5, percent=80)
    return by_ids(docs, found.where("NOT kept"), "left_anti").select(docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document are cut out; no document is dropped."""
    done = substring_dedup.without_repeats(docs, PASSAGE_WORDS)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = decontamination.leaks(docs, _table(spark, sf_dir, "benchmark"))
    return by_ids(docs, leaks, "left_anti").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates by which languages are lifted towards each other; no document falls out, as no rate is under 1."""
    labelled = by_ids(docs, _table(spark, sf_dir, "labels"), "left_semi").select("text", F.col("lang").alias("domain"))
    rates = mixing.mixed(docs, labelled).select("doc_id", "domain", "rate", "copies").dropDuplicates(["doc_id"])
    joined = docs.alias("d").join(rates.alias("r"), F.expr("d.doc_id <=> r.doc_id"), "left")
    return joined.where("copies > 0").select("d.*", "domain", "rate", "copies")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# No SQL expresses the network, the signatures or the latent space; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        folder = new_folder(spark, f"pipeline-{name}")
        out.write.parquet(folder)
        docs = spark.read.schema(out.schema).parquet(folder)
    return docs
