"""A corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, benchmark
decontamination, best-fit packing.  Every stage reads what the stage before it kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.config import checkpoint_root
from visitflow.llm import decontaminate, jaccard, lines, packing, quality
from visitflow.llm.queries import table


#: Words that the packing stage remembers: its Python workers stay beside those of the other stages.
KEPT_WORDS = 200_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document goes if that leaves nothing of it."""
    freed = lines.dedup_lines(docs, short_lines=True).where("not emptied")
    return freed.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(
        *(F.col(c).cast(t).alias(c) for c, t in docs.dtypes))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as packed pieces."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), kept=KEPT_WORDS)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Boosted trees and fuzzy lines have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
