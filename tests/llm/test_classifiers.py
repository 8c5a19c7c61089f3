"""Quality and toxicity on documents with known labels, and on odd tables."""

import random

import pytest

from pyspark.sql import functions as F

from tillgrain.llm import decontaminate, jaccard, quality, toxicity

LABEL = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(9)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(300)]
    texts, labels = [], []
    for n in range(600):
        text = draw.choices(words, k=draw.randint(20, 80))
        bad, toxic = n % 4 == 0, n % 5 == 1
        if bad:
            text = [w.upper() + "!!" for w in text]
        if toxic:
            text[draw.randrange(len(text))] = draw.choice(["idiot", "scum", "zzqqxx"])
        texts.append((n, " ".join(text)))
        labels.append((n, int(not bad), int(toxic)))
    return texts, labels


def test_held_out_documents_are_judged_right(spark, documents, planted):
    texts, labels = planted
    known = spark.createDataFrame(labels[:400] + [(3, None, None)], LABEL)
    extra = [(900, None), (901, ""), (None, "words of no id"), (902, "long " * 50_000)]
    docs = documents(texts + extra)
    good = quality.good_ones(docs, quality.learn(docs, known))
    kept = [r["doc_id"] for r in good.collect()]
    assert good.columns == docs.columns
    wrong = [i for i, q, _ in labels[400:] if (i in kept) != bool(q)]
    assert len(wrong) <= 10
    calm = toxicity.without_toxic(docs, toxicity.learn(docs, known))
    left = [r["doc_id"] for r in calm.collect()]
    assert calm.columns == docs.columns
    wrong = [i for i, _, t in labels[400:] if (i in left) == bool(t)]
    assert len(wrong) <= 10 and {900, 901, None} <= set(left)


def test_few_labels_beside_many_documents(spark, documents, planted, monkeypatch):
    """The size bounds labelled documents only, and all others are judged in every round."""
    texts, labels = planted
    known = spark.createDataFrame(labels[:60], LABEL)
    docs = documents(texts)
    read, plain = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, *more: (
        read.append(sorted(r[0] for r in rows.select(more[1]).collect())), plain(rows, *more))[1])
    model = quality.learn(docs, known, size=60)
    bad = sum(not q for _, q, _ in labels[:60])
    aside = len(read[-1])
    assert len(read[0]) + aside == 60
    assert read[0].count(0) + read[-1].count(0) == bad
    # The metadata are taught by the texts, which are sure of nearly all of the 540.
    assert len(read[3]) > 400 and len(read[5]) > 400
    kept = {r["doc_id"] for r in quality.good_ones(docs, model).collect()}
    assert sum((i in kept) != bool(q) for i, q, _ in labels[60:]) <= 10


def test_columns_of_the_operators_own_names_stay(spark, documents, planted):
    """Stages return the columns they got, and the same row of a repeated id whatever the order."""
    texts, labels = planted
    known = spark.createDataFrame(labels[:200], LABEL)
    docs = documents(texts[:40] + [(n, t + " more") for n, t in texts[:40]]).withColumns(
        {"_score": F.lit("mine"), "_CHANCES": F.lit("mine"), "_leaks": F.lit("mine"),
         "_place": F.lit("mine")})
    marks = spark.createDataFrame([(1, "no such words anywhere")], "item_id bigint, text string")
    for rows in (docs, docs.orderBy(F.desc("text")).repartition(3)):
        good = quality.good_ones(rows, quality.learn(rows, known))
        calm = toxicity.without_toxic(good, toxicity.learn(good, known))
        left = jaccard.without_near_copies(decontaminate.without_leaks(calm, marks), width=5, percent=80)
        assert left.columns == docs.columns
        got = sorted(map(tuple, left.collect()), key=str)
        assert got and all(r[-4:] == ("mine",) * 4 for r in got)
        assert len({r[0] for r in got}) == len(got)
        first = got if rows is docs else first
    assert got == first


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, None, None)], [(77, 0, 1)]])
def test_without_labels_of_both_kinds(spark, documents, labels):
    docs = documents([(1, "some words here"), (2, None), (1, "some words here")])
    known = spark.createDataFrame(labels, LABEL)
    assert toxicity.without_toxic(docs, toxicity.learn(docs, known)).count() == 3
    assert quality.good_ones(docs, quality.learn(docs, known)).count() == 3
    none = documents([])
    assert toxicity.without_toxic(none, toxicity.learn(none, known)).count() == 0
    assert quality.good_ones(none, quality.learn(none, known)).count() == 0


def test_sure_rows_are_judged_by_one_python_worker(spark):
    """Half of the rows are sure; their margin is worked out in one step, not again for the filter."""
    rows = spark.createDataFrame([(float(n),) for n in range(-10, 11)], "x double").select(F.array("x").alias("view"))
    got = quality._taught(rows, quality.Linear((1.0,), 0.0), "view", 5.0)
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r["view"][0], r["label"]) for r in got.collect()) == [
        (float(n), int(n > 0)) for n in range(-10, 11) if abs(n) >= 5]


def test_counts_handed_on_in_parts_are_the_same(spark, planted):
    texts, labels = planted
    sample = spark.createDataFrame([(t, k, n % 3) for (n, t), (_, _, k) in zip(texts[:90], labels)],
                                   "text string, label int, fold int").coalesce(1)
    whole, parts = (sorted(map(tuple, toxicity._tally(sample, 3, most).collect())) for most in (1 << 30, 40))
    assert whole == parts and len(whole) > 300
    docs = {f: n for f, *_, n in whole}
    assert docs["idiot"] == sum("idiot" in t.split() for _, t in texts[:90])


def test_features_of_a_text_as_a_row(spark):
    rows = spark.createDataFrame([("alpha beta",), ("",), ("gammas",)], "text string").coalesce(1)
    terms = toxicity.Terms(("alpha", "beta", "gam*"), frozenset())
    assert [r[0] for r in rows.select(toxicity._present(terms)("text")).collect()] == [[1, 1, 0], [0, 0, 0], [0, 0, 1]]
    none = toxicity.Terms((), frozenset())
    assert [r[0] for r in rows.select(toxicity._present(none)("text")).collect()] == [[], [], []]
