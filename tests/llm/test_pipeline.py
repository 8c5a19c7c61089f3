"""The stages over small documents: nulls, repeats, clashing names, empty tables; each against a plain version."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tillgrain.llm import jaccard
from tillgrain.session import scratch_path

WORDS = [f"word{n}" for n in range(300)]


def texts(count, seed=5):
    draw = np.random.default_rng(seed)
    return [" ".join(draw.choice(WORDS, 60)) + "." for _ in range(count)]


@pytest.fixture
def folder(spark, documents):
    """Documents with copies, a repeated id, nulls and a leaked passage, beside labels and a benchmark."""
    def write(rows, labels=(), items=()):
        home = scratch_path(spark, "pipeline")
        documents(rows).write.parquet(f"{home}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(
            f"{home}/labels.parquet")
        spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(
            f"{home}/benchmark.parquet")
        return home
    return write


def test_without_labels_only_copies_and_leaks_go(spark, folder):
    own = texts(12)
    leaked = own[3] + " " + "the exact passage of a benchmark item that nobody may train on " + own[4]
    near = own[0].split()
    near[30] = "changed"
    rows = [(n, t) for n, t in enumerate(own)] + [
        (20, own[0]), (21, " ".join(near + ["two", "more"])), (22, leaked), (23, None), (24, ""), (None, own[5] + " x")]
    home = folder(rows, items=[(1, "The exact passage of a benchmark item that nobody may train on")])
    got = {r["doc_id"]: r.asDict() for r in corpus_pipeline.run(spark, home).collect()}
    assert set(got) == {*range(12), 23, 24, None}
    assert got[23]["n_tokens"] == 0 and got[2]["n_tokens"] > 60
    assert {"text", "lang", "source", "n_chars"} <= set(got[2])


def test_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0


def test_stages_return_the_columns_they_get(spark, folder):
    home = folder([(n, t) for n, t in enumerate(texts(6))])
    docs = spark.read.parquet(f"{home}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, home)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"], name


def test_batches_of_long_texts_are_bounded_by_bytes(spark, documents):
    """Texts of 300,000 characters: a batch holds a few of them, not as many as short ones."""
    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    stage = corpus_pipeline.in_small_batches(
        lambda spark, docs, folder: docs.coalesce(1).select("text").mapInArrow(count, "n bigint"))
    found = [r["n"] for r in stage(spark, documents([(n, "x" * 300_000) for n in range(40)]), "").collect()]
    assert sum(found) == 40 and max(found) * 300_000 <= 2 * corpus_pipeline.BATCH_BYTES


def test_a_tree_hands_on_pairs_in_small_portions():
    """All points alike, of different components: every pair, never many at once."""
    points = np.ones((400, 64), np.int64)
    tree = jaccard.RTree(points, points.sum(axis=1), np.arange(400))
    seen, most = set(), 0
    for found in tree.portions(jaccard.Law(80)):
        most = max(most, len(found))
        seen |= {tuple(sorted(p)) for p in found.tolist()}
    assert len(seen) == 400 * 399 // 2 and most <= 1 << 12


def test_a_document_with_many_partners_is_verified_in_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_PAIRS", 3)
    base = texts(1)[0].split()
    rows = [(n, " ".join([*base, f"end{n}"])) for n in range(25)] + [(90, texts(1, 8)[0])]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.link(documents(rows)).collect()}
    assert got == {**{n: 0 for n in range(25)}, 90: 90}
