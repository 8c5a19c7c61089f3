"""Toxicity by classifier chains.

The categories stand in an order, the overall label last. Each link is a linear model over the text's
features and the chances of the links before it; in training, these chances are out of fold. The
categories before the last come from the labels too: ``LEADING`` whole words set toxic documents apart
most, and a document is ``explicit`` if it is labelled toxic and holds one of them, ``severe`` if two.
So the early links know the plain terms, whatever the language, and the last one learns what else
goes with toxic documents. Vocabulary, leading words and categories of a fold's models are chosen
without that fold.

Features are the presence of whole lower-case words and of word beginnings of 3 to 8 letters; those
kept tell toxic from other documents best in the sample. The sample is about ``SAMPLE_DOCS`` labelled
documents, taken by a hash of the id.

Null and empty texts have no features and get the models' base chance. Labels of several rows for one
id: the document is toxic if one says so; null labels are passed over. Of documents that repeat an id
the least text is learned from, all are scored. Without labels of both kinds nothing is toxic. Extra columns stay
as they are; columns that the operator adds replace such of the same name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from tillgrain.llm.linear import SAMPLE_TASKS, Linear, fit, matrix
from tillgrain.llm.tables import query, table, unused, whole_text
from tillgrain.session import pin

#: Categories before the last, in the chain's order: how many leading words their documents hold.
LEVELS = {"severe": 2, "explicit": 1}
#: So many whole words lead.
LEADING = 16
OVERALL = "toxic"
SAMPLE_DOCS = 8_000
FEATURES = 768
FOLDS = 3
LEAST_DOCS = 2
#: Counts of features that a task holds before it hands them on.
TALLIED = 1 << 15
ROUNDS = 40
PENALTY = 2e-4
#: Chance of the last link from which a document counts as toxic.
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6, 7, 8)


def features_of(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    found = set(words)
    for n in BEGINNINGS:
        found |= {w[:n] + "*" for w in words if len(w) > n}
    return found


@dataclass(frozen=True)
class Chain:
    names: tuple[str, ...]
    vocabulary: tuple[str, ...]
    links: tuple[Linear, ...]

    def chances(self, texts: list[str]) -> np.ndarray:
        """A row per text with the chance of every link."""
        place = {f: i for i, f in enumerate(self.vocabulary)}
        known = frozenset(place)
        base = np.array([link.bias for link in self.links])
        weights = np.array([link.weights[:len(place)] for link in self.links])
        carry = [np.array(link.weights[len(place):]) for link in self.links]
        made = np.empty((len(texts), len(self.links)))
        for row, text in enumerate(texts):
            at = [place[f] for f in known & features_of(text)]
            margins = base + weights[:, at].sum(axis=1)
            for n, more in enumerate(carry):
                margin = margins[n] + float(made[row, :n] @ more)
                made[row, n] = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return made


def _sample(docs: DataFrame, labels: DataFrame, size: int, id: str, text: str) -> DataFrame:
    given = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("label")))
    share = min(1.0, size / max(given.count(), 1))
    taken = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return (docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), whole_text(text).alias("text"))
            .join(F.broadcast(taken), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")))


def _tally(sample: DataFrame, folds: int, most: int = TALLIED) -> DataFrame:
    """How many clean and toxic documents of each fold hold a feature: arrays with a place per fold. A task
    hands its counts on whenever it holds ``most`` of them; they are summed afterwards."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], Counter] = {(f, k): Counter() for f in range(folds) for k in (0, 1)}

        def close() -> Iterator[pa.RecordBatch]:
            for (fold, label), counts in seen.items():
                yield pa.RecordBatch.from_pydict({
                    "feature": pa.array(list(counts), pa.string()),
                    "fold": pa.array([fold] * len(counts), pa.int32()),
                    "label": pa.array([label] * len(counts), pa.int32()),
                    "docs": pa.array(list(counts.values()), pa.int64())})
                counts.clear()

        for batch in batches:
            for text, label, fold in zip(*(batch.column(n) for n in range(3))):
                seen[fold.as_py(), label.as_py()].update(features_of(text.as_py()))
                if sum(map(len, seen.values())) >= most:
                    yield from close()
        yield from close()

    counted = (sample.select("text", "label", "fold")
               .mapInArrow(tally, "feature string, fold int, label int, docs bigint"))
    one = lambda f, k: F.sum(F.when((F.col("fold") == f) & (F.col("label") == k),
                                    F.col("docs")).otherwise(0))
    return (counted.groupBy("feature")
            .agg(F.array(*[one(f, 0) for f in range(folds)]).alias("clean"),
                 F.array(*[one(f, 1) for f in range(folds)]).alias("toxic"),
                 F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST_DOCS))


@dataclass(frozen=True)
class Terms:
    """The features of a fit, and the whole words that lead."""
    vocabulary: tuple[str, ...]
    leading: frozenset[str]


def _terms(counted: DataFrame, totals: dict[tuple[int, int], int], folds: list[int], size: int,
           leading: int) -> Terms:
    """The features that set toxic documents of the given folds apart most, by the difference of their
    shares times the log of the ratio."""
    toxic, clean = (sum((F.col(side)[f] for f in folds), F.lit(0)) for side in ("toxic", "clean"))
    p = (F.col("own_toxic") + 0.5) / (sum(totals.get((f, 1), 0) for f in folds) + 1)
    q = (F.col("own_clean") + 0.5) / (sum(totals.get((f, 0), 0) for f in folds) + 1)
    told = (counted.select("feature", toxic.alias("own_toxic"), clean.alias("own_clean"))
            .where((F.col("own_toxic") + F.col("own_clean") >= LEAST_DOCS) & (p > q))
            .select("feature", ((p - q) * F.log(p / q)).alias("gain")))
    best = lambda rows, n: [r["feature"] for r in rows.orderBy(F.desc("gain"), "feature")
                            .limit(n).collect()]
    return Terms(tuple(sorted(best(told, size))),
                 frozenset(best(told.where(~F.col("feature").endswith("*")), leading)))


def _present(terms: Terms):
    place = {f: i for i, f in enumerate(terms.vocabulary)}

    @arrow_udf("array<double>")
    def present(texts: pa.Array) -> pa.Array:
        rows = np.zeros((len(texts), len(place)))
        for n, body in enumerate(texts):
            rows[n, [place[f] for f in features_of(body.as_py()) & place.keys()]] = 1.0
        ends = np.arange(len(texts) + 1, dtype=np.int32) * len(place)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.ravel()))

    return present


def _leading(terms: Terms):
    @arrow_udf("int")
    def held(texts: pa.Array) -> pa.Array:
        return pa.array([len(terms.leading.intersection(WORD.findall(body.as_py().lower())))
                         for body in texts], pa.int32())

    return held


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
          levels: dict[str, int] = LEVELS, size: int = SAMPLE_DOCS,
          features: int = FEATURES, folds: int = FOLDS, leading: int = LEADING) -> Chain:
    sample = pin(_sample(docs, labels, size, id, text).withColumn(
        "fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(folds)).cast("int"))
        .coalesce(SAMPLE_TASKS))
    totals = {(r["fold"], r["label"]): r["count"]
              for r in sample.groupBy("fold", "label").count().collect()}
    counted = pin(_tally(sample, folds))
    every = list(range(folds))
    # The last entry is for all folds, the others leave out the fold of their number.
    terms = [_terms(counted, totals, [g for g in every if g != f], features, leading)
             for f in every] + [_terms(counted, totals, every, features, leading)]
    now = pin(sample.select("label", "fold", *[
        column for f, own in enumerate(terms) for column in
        (_present(own)("text").alias(f"x_{f}"), _leading(own)("text").alias(f"held_{f}"))]))
    names, links = (*levels, OVERALL), []
    for n, name in enumerate(names):
        own = [F.when(F.col(f"held_{f}") >= levels[name], F.col("label")).otherwise(0)
               if name in levels else F.col("label") for f in range(folds + 1)]
        links.append(_link(now, own[-1], f"x_{folds}", n + len(terms[-1].vocabulary)))
        if n + 1 < len(names):
            parts = [_link(now.where(F.col("fold") != f), own[f], f"x_{f}",
                           n + len(terms[f].vocabulary)) for f in every]
            chance = F.array(F.coalesce(*[F.when(F.col("fold") == f, _chance(m)(f"x_{f}"))
                                          for f, m in enumerate(parts)]))
            now = pin(now.withColumns({f"x_{f}": F.concat(f"x_{f}", chance)
                                       for f in range(folds + 1)}))
    return Chain(names, terms[-1].vocabulary, tuple(links))


def _link(rows: DataFrame, label: Column, features: str, width: int) -> Linear:
    """A link over the features and the chances before it. Without documents of both kinds it gives no
    chance to any."""
    model = fit(rows.withColumn("is", label), features, "is", width, penalty=PENALTY, rounds=ROUNDS,
                scaled=False)
    return model if any(model.weights) else Linear(model.weights, -30.0)


def _chance(model: Linear):
    @arrow_udf("double")
    def apply(x: pa.Array) -> pa.Array:
        return pa.array(model.chance(matrix(x)) if len(x) else [], pa.float64())

    return apply


def add_chances(docs: DataFrame, chain: Chain, into: str, text: str = "text") -> DataFrame:
    """Add an array with the chance of every link."""
    @arrow_udf("array<double>")
    def judge(texts: pa.Array) -> pa.Array:
        return pa.array(list(chain.chances(texts.to_pylist())), pa.list_(pa.float64()))

    return docs.withColumn(into, judge(whole_text(text)))


def without_toxic(docs: DataFrame, chain: Chain, text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose last link stays below the threshold, as they are."""
    into = unused("_chances", docs)
    judged = add_chances(docs, chain, into, text)
    return (judged.where(F.element_at(into, -1) < threshold)
            .select(*[f"`{c}`" for c in docs.columns]))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    chain = learn(docs, table(spark, folder, "labels"))
    judged = add_chances(docs, chain, "chances")
    return judged.select(
        "doc_id", *[F.col("chances")[n].alias(f"{name}_chance")
                    for n, name in enumerate(chain.names)],
        (F.element_at("chances", -1) >= THRESHOLD).cast("int").alias("toxic"))
