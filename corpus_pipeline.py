"""From the documents table to a clean encoded corpus: stages of the operators in ``tilth.llm``.

Each stage takes what its predecessor kept and returns it with its own decisions
applied; between stages the documents are written as Parquet in the shared folder.
Extra columns pass through unchanged.  Null texts are empty texts, which the first
stage rejects; an empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.functions.store import cut
from tilth.llm import pieces, quality, simhash, suffixes, winnow


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the estimated quality both keep."""
    return quality.judge(docs).filter("kept").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that share 0.8 of their five-word shingles the one with the smallest id."""
    return simhash.first_of_similar(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has; those left without text go.

    Where a cut splits a character of several bytes, what is left of it goes too.
    """
    cut_ = suffixes.cut_repeats(docs, carry=[c for c in docs.columns if c != "text"], characters=True)
    new = cut_.select("rows.*", F.col("kept").cast("string").alias("text")).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.filter(F.length(F.btrim("text", F.lit(quality.SPACE))) > 0).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return winnow.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents with their piece ids and what these decode to."""
    return pieces.encode(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: Posteriors, components and merges cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
