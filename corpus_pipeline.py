"""A training corpus from raw documents: good ones, without toxic ones, near copies and benchmark
leaks, as token ids.

Each stage gets what the one before has left, as it was written. Null texts, repeated rows, empty
tables and extra columns are treated as the operators say; all stages but the last return the columns
that they got.

Stages lower the session's ``spark.sql.execution.arrow.maxRecordsPerBatch`` to ``BATCH_ROWS``, set
``maxBytesPerBatch`` to ``BATCH_BYTES``, and leave both there, since what they return is computed later: a
batch of whole texts stands in the memory of a task, of its Python worker, and of what both make of it: the
features of 500 texts that ``toxicity`` fits its chain on are 12 MB, of 200 texts 5 MB.
Near copies of a long text come together, so that rows alone do not bound their batches."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillgrain.llm import bpe, decontaminate, jaccard, quality, toxicity
from tillgrain.llm.tables import table
from tillgrain.session import pin


BATCH_ROWS = 200
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = 1 << 20
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(stage):
    """The stage with batches of texts of at most ``BATCH_ROWS`` rows, and of about ``BATCH_BYTES``."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        now = int(spark.conf.get(BATCH))
        if not 0 < now <= BATCH_ROWS:
            spark.conf.set(BATCH, str(BATCH_ROWS))
        spark.conf.set(BYTES, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)
    return run_stage


@in_small_batches
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_ones(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


@in_small_batches
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@in_small_batches
def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.without_near_copies(docs, width=5, percent=80)


@in_small_batches
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, into="ids").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_copies", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir))
    return docs
