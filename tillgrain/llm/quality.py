"""Quality by co-training: one classifier sees the text, one the page's metadata.

Both are fitted on labelled documents. Then, over some rounds, each labels the unlabelled documents
that it is sure of for the other, which is fitted again with them. On labelled documents kept aside
the margins of both are calibrated and a last model learns how much each view counts; it scores all
documents.

Of the labelled documents about ``SAMPLE_DOCS`` are taken by a hash of the id, all of them if they are
fewer; every fourth one is kept aside. How many documents have no label changes nothing about that, and
in every round both views judge all of those, with the exception of documents without an id. Labels of several rows for one id: the lowest quality counts; null
labels are passed over. Of documents that repeat an id one is learned from, all are scored. Null and
empty texts count as no words; metadata that is null is a value of its own. Without labels of both
kinds all documents get the same score, and are kept unless the only label is 0. Extra columns stay
as they are; columns that the operator adds replace such of the same name.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import log1p
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType

from tillgrain.llm.linear import SAMPLE_TASKS, Linear, fit, margin_of
from tillgrain.llm.tables import query, table, unused, whole_text
from tillgrain.session import pin

SAMPLE_DOCS = 16_000
#: Unlabelled documents that one task of a fit reads.
TASK_ROWS = 20_000
ROUNDS = 2
SURE = 0.95
LANGUAGES, SOURCES = 16, 64
UPPER = bytes(range(65, 91))
LETTERS = bytes(b for b in range(256) if chr(b).isalpha() and b < 128 or b >= 128)
DIGITS = b"0123456789"
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
CONTENT, METADATA = 13, 2 + LANGUAGES + SOURCES


def content_features(text: str) -> list[float]:
    """Shares that tell running text from shouting, lists, garbled and repeated words."""
    body = text.encode()
    words = body.split()
    n = max(len(words), 1)
    size = max(len(body), 1)
    left = len(body)
    upper = left - len(body.translate(None, UPPER))
    letters = left - len(body.translate(None, LETTERS))
    digits = left - len(body.translate(None, DIGITS))
    marks = left - len(body.translate(None, MARKS))
    counts = Counter(words)
    lines = body.split(b"\n")
    bare = sum(1 for w in words if not w.translate(None, MARKS))
    run = sum(body.count(m * 2) for m in (b"!", b"%", b"*", b"&", b"$", b"#", b"?", b"="))
    return [log1p(len(words)), upper / max(letters, 1), digits / size, marks / size, marks / n,
            len(counts) / n, max(counts.values(), default=0) / n,
            sum(map(eq, words, words[1:])) / n, bare / n, run / n,
            1 - len(set(lines)) / len(lines), body.count(b"|") / n, len(body) / n / 10]


def metadata_features(lang: str | None, source: str | None, chars: int | None) -> list[float]:
    row = [0.0] * METADATA
    row[0] = log1p(max(chars or 0, 0))
    row[1] = float(chars is None)
    row[2 + crc32((lang or "\0").encode()) % LANGUAGES] = 1.0
    row[2 + LANGUAGES + crc32((source or "\0").encode()) % SOURCES] = 1.0
    return row


@arrow_udf(ArrayType(DoubleType()))
def content_view(texts: pa.Array) -> pa.Array:
    return pa.array([content_features(t.as_py() or "") for t in texts], pa.list_(pa.float64()))


@arrow_udf(ArrayType(DoubleType()))
def metadata_view(lang: pa.Array, source: pa.Array, chars: pa.Array) -> pa.Array:
    return pa.array([metadata_features(*row) for row in zip(
        lang.to_pylist(), source.to_pylist(), chars.to_pylist())], pa.list_(pa.float64()))


@dataclass(frozen=True)
class Cotrained:
    content: Linear
    metadata: Linear
    #: Calibration of each view's margin, and how the calibrated margins are put together.
    calibrated: tuple[Linear, Linear]
    combined: Linear


def _documents(docs: DataFrame, labels: DataFrame, text: str) -> DataFrame:
    """One row per id with both views, and the label or null."""
    given = (labels.where("quality is not null and doc_id is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(F.col("quality").cast("int")).alias("label")))
    return (docs.where("doc_id is not null")
            .select(F.col("doc_id").cast("long").alias("doc_id"),
                    content_view(whole_text(text)).alias("content"),
                    F.col("lang").cast("string").alias("lang"),
                    F.col("source").cast("string").alias("source"),
                    F.col("n_chars").cast("long").alias("n_chars"))
            .groupBy("doc_id").agg(F.min(F.struct("content", "lang", "source", "n_chars")).alias("own"))
            .select("doc_id", "own.*").join(given, "doc_id", "left")
            .select("doc_id", "content", metadata_view("lang", "source", "n_chars").alias("metadata"),
                    "label"))


def _taught(rows: DataFrame, teacher: Linear, view: str, edge: float) -> DataFrame:
    """The rows whose margin is at least the edge, labelled by its sign. The margin is marked as not deterministic: Spark
    would otherwise work it out again for the filter, with a second Python worker beside the first in every task."""
    return (rows.withColumn("margin", margin_of(teacher, view, once=True))
            .where(F.abs("margin") >= edge)
            .withColumn("label", (F.col("margin") > 0).cast("int")).drop("margin"))


def _in_tasks(rows: DataFrame, count: int) -> DataFrame:
    return rows.coalesce(max(SAMPLE_TASKS, -(-count // TASK_ROWS)))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", size: int = SAMPLE_DOCS,
          rounds: int = ROUNDS, sure: float = SURE) -> Cotrained:
    every = pin(_documents(docs, labels, text))
    counts = every.agg(F.count("label").alias("labelled"), F.count(F.lit(1)).alias("all")).first()
    share = min(1.0, size / max(counts["labelled"], 1))
    taken = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    pool = pin(every.where(F.col("label").isNotNull() & taken)
               .withColumn("aside", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0)
               .coalesce(SAMPLE_TASKS))
    known = pool.where("not aside").drop("aside")
    open_ = _in_tasks(every.where("label is null"), counts["all"] - counts["labelled"])
    content = fit(known, "content", "label", CONTENT)
    metadata = fit(known, "metadata", "label", METADATA)
    edge = float(np.log(sure / (1 - sure)))

    for _ in range(rounds):
        by_content = _taught(open_, content, "content", edge)
        by_metadata = _taught(open_, metadata, "metadata", edge)
        content = fit(known.unionByName(by_metadata), "content", "label", CONTENT)
        metadata = fit(known.unionByName(by_content), "metadata", "label", METADATA)
    held = pin(pool.where("aside").select(
        "label", F.array(margin_of(content, "content")).alias("a"),
        F.array(margin_of(metadata, "metadata")).alias("b")))
    calibrated = fit(held, "a", "label", 1), fit(held, "b", "label", 1)
    both = pin(held.select("label", F.array(
        margin_of(calibrated[0], "a"), margin_of(calibrated[1], "b")).alias("ab")))
    return Cotrained(content, metadata, calibrated, fit(both, "ab", "label", 2))


def score_of(model: Cotrained, text: str = "text") -> Column:
    """Chance of good quality, from both views in one pass."""
    @arrow_udf("double")
    def judge(texts: pa.Array, lang: pa.Array, source: pa.Array, chars: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        a = np.array([content_features(t.as_py()) for t in texts])
        b = np.array([metadata_features(*row) for row in zip(
            lang.to_pylist(), source.to_pylist(), chars.to_pylist())])
        views = np.stack([c.margin(m.margin(x)[:, None]) for c, m, x in (
            (model.calibrated[0], model.content, a), (model.calibrated[1], model.metadata, b))], 1)
        return pa.array(model.combined.chance(views), pa.float64())

    return judge(whole_text(text), F.col("lang").cast("string"), F.col("source").cast("string"),
                 F.col("n_chars").cast("long"))


def good_ones(docs: DataFrame, model: Cotrained, text: str = "text",
              threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold, as they are."""
    score = unused("_score", docs)
    judged = docs.withColumn(score, score_of(model, text))
    return judged.where(F.col(score) >= threshold).select(*[f"`{c}`" for c in docs.columns])


@query("op2_quality")
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learn(docs, table(spark, folder, "labels"))
    return docs.select("doc_id", score_of(model).alias("score")).withColumn(
        "kept", (F.col("score") >= 0.5).cast("int"))
