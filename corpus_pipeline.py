"""From raw documents to packed sequences: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import common, decontam, neardup, packing, pii, rules


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    return rules.passing(docs, common.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8); rows without an id stay.

    Rows that repeat an id with its text are one document; rows that share an id only are documents of their own.
    """
    common.tuned(spark)
    named = docs.withColumn("_text", F.sha2("text", 256))
    kept = neardup.near_duplicates(named, size=5, percent=80, carry=("_text",)).filter("kept and doc_id is not null").select("doc_id", F.coalesce("_text", F.lit("")).alias("_text")).distinct()
    named = named.withColumn("_text", F.coalesce("_text", F.lit("")))
    one = named.join(kept, ["doc_id", "_text"], "left_semi").dropDuplicates(["doc_id", "_text"]).select(*docs.columns)
    return one.union(docs.filter("doc_id is null"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; one that does goes as a whole."""
    found = decontam.matches(docs, common.table(spark, sf_dir, "benchmark"))
    bad = common.stored(decontam.leaks(found).select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    common.tuned(spark)
    return pii.mask_personal_data(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    common.tuned(spark)
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("benchmark_decontamination", benchmark_decontamination), ("personal_data", personal_data), ("packing", pack_sequences)]

#: SQL expresses neither the forest nor the retrieval; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        path = common.shared_dir(spark, f"pipeline-{name}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
