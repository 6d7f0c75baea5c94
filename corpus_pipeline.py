"""A pipeline from raw documents to a training mixture: five stages, each over all that the one before it kept.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read back as the next stage's docs.
All stages but the last return the columns of ``documents``; the last adds ``n_tokens`` and ``copies``.

SQL cannot express the first stage (a trained classifier), so ``ORACLE_SQL`` is None; the stages are tested one by one.
Null and empty texts, repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from flowloom.llm.common import small_batches, staged
from flowloom.llm.queries import MIX_PERCENT, MIX_SEED, MIX_WEIGHTS, mix_domain
from flowloom.session import configure, ship_package

ORACLE_SQL = None

#: A document is rejected if label 1 is less likely than this.
QUALITY_THRESHOLD = 0.3
#: Documents are near-duplicates from this similarity of their word shingles on, in percent. op5 has its own, 85.
NEAR_PERCENT = 80


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from all labels."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, "quality", F.lit(True))
    return docs.where(quality.score_column(docs, model) >= QUALITY_THRESHOLD)


def by_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document has; one that has no line of its own left is dropped."""
    small_batches(spark)
    done = line_dedup.dedup_lines(docs)
    whole = (F.col("n_dropped") == 0) | F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return done.where(whole).select(*docs.columns)


def by_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group; pairs from NEAR_PERCENT on are linked."""
    small_batches(spark)
    return near_dedup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def by_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, and how often each, that fill the token budgets."""
    return mixing.mix(docs, MIX_WEIGHTS, mix_domain(), percent=MIX_PERCENT, seed=MIX_SEED)


STAGES = [
    ("quality classifier", by_quality),
    ("line dedup", by_lines),
    ("near-duplicate removal", by_near_duplicates),
    ("benchmark decontamination", by_benchmark),
    ("mixing", by_weights),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    configure(spark)
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
