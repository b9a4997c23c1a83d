import random

import numpy as np
import pytest
from llm_helpers import ODD, docs_of

from changeflow.llm.labelled import fit_sample
from changeflow.llm.quality import BITS, Grams, dual_coordinate_descent, fit_quality, quality_scores
from changeflow.llm.toxicity import GRADES, fit_cumulative_link, fit_toxicity, sigmoid, toxicity, without_toxic

LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n=600):
    rng = random.Random(17)
    docs, labels = [], []
    for i in range(n):
        bad, toxic = rng.random() < 0.3, rng.random() < 0.3
        w = [f"word{rng.randrange(300)}" for _ in range(rng.randrange(20, 60))]
        if bad:
            w = [x.upper() + "!!" for x in w]
        if toxic:
            for _ in range(rng.randrange(1, 9)):
                w[rng.randrange(len(w))] = rng.choice(["zonkard", "zonkish", "grimble"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(toxic), "clash"))
    return docs, labels


def test_quality_on_held_out_rows(spark):
    docs, labels = corpus()
    frame = docs_of(spark, [*docs, *[(d if d is None else d + 10_000, t) for d, t in ODD]])
    model = fit_quality(frame, spark.createDataFrame([*labels, (None, 1, 1, ""), (3, None, None, "")], LABELS))
    truth = {d: q for d, q, *_ in labels}
    got = quality_scores(frame, model).collect()
    assert len(got) == len(docs) + len(ODD)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_shapes_are_of_whole_words():
    shapes = lambda raw: [b for b in Grams().of(raw).tolist() if b >= 1 << BITS]
    long = b"a" * 70
    assert shapes(long + b"9!") == shapes(b"a9!") != shapes(long)
    # a character across the 64th byte is not cut
    assert shapes(b"a" * 63 + "é".encode()) == shapes(b"a")


def test_sample_has_one_row_per_id(spark):
    docs, labels = corpus(60)
    hot = [(1, f"text {i % 3}") for i in range(500)]
    table = spark.createDataFrame(labels, LABELS)
    for order in (hot, hot[::-1]):
        got = fit_sample(docs_of(spark, [d for d in docs if d[0] != 1] + order), table, "quality", 20).collect()
        assert len(got) == len({r.doc_id for r in got}) == 20
    whole = fit_sample(docs_of(spark, docs + hot), table, "quality", 60)
    again = fit_sample(docs_of(spark, docs + hot[::-1]), table, "quality", 60)
    assert whole.count() == whole.select("doc_id").distinct().count() and sorted(whole.collect()) == sorted(again.collect())
    assert whole.filter("doc_id = 1").count() == 1 and whole.columns == ["doc_id", "text", "label"]


def test_dual_steps_reach_the_optimum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 4))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0, 1, -1)
    rows = [np.arange(4)] * 60
    w, b = dual_coordinate_descent(rows, list(x), y, cost=1.0, epochs=3000, size=4)

    def primal(v):
        return 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v[:4] + v[4])).sum()

    best = primal(np.append(w, b))
    assert all(primal(np.append(w, b) + rng.normal(size=5) * s) >= best - 1e-3 for s in (1e-3, 1e-2, 1e-1) for _ in range(50))


def test_ordered_thresholds_are_recovered():
    rng = np.random.default_rng(4)
    at = [rng.choice(6, 3, replace=False) for _ in range(4000)]
    w = np.array([2.0, 1.0, 0.0, -1.0, -2.0, 0.5])
    score = np.array([w[a].sum() for a in at])
    grade = (rng.random((4000, 1)) < sigmoid(score[:, None] - np.array([-0.5, 1.0, 2.5]))).cumprod(axis=1)
    # one uniform draw per row makes the grades ordinal
    u = rng.random(4000)[:, None]
    grade = (u < sigmoid(score[:, None] - np.array([-0.5, 1.0, 2.5]))).sum(axis=1)
    got, cuts = fit_cumulative_link(at, [np.ones(3)] * 4000, grade, 6, steps=2000)
    assert (np.diff(cuts) > 0).all()
    fitted = np.array([got[a].sum() for a in at])
    assert np.abs(sigmoid(fitted[:, None] - cuts) - sigmoid(score[:, None] - np.array([-0.5, 1.0, 2.5]))).mean() < 0.03


def test_toxicity_on_held_out_rows(spark):
    docs, labels = corpus()
    frame = docs_of(spark, [*docs, *[(d if d is None else d + 10_000, t) for d, t in ODD]])
    model = fit_toxicity(frame, spark.createDataFrame([*labels, (None, 1, 1, ""), (3, None, None, "")], LABELS))
    truth = {d: bool(t) for d, _, t, _ in labels}
    got = toxicity(frame, model).collect()
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.toxic == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.severity <= GRADES - 1 and r.toxic == (r.grade > 0) and r.kept != r.toxic for r in got)
    many = np.mean([r.severity for r in got if r.doc_id in truth and dict(docs)[r.doc_id].count("zonk") > 4])
    few = np.mean([r.severity for r in got if r.doc_id in truth and dict(docs)[r.doc_id].count("zonk") == 1])
    assert many > few
    left = without_toxic(frame, model)
    assert left.columns == frame.columns and left.count() == sum(not r.toxic for r in got)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0, "")], [(1, None, None, "")], [(1, 0, 1, ""), (2, 0, 1, "")]])
def test_no_or_one_class(spark, labels):
    frame = docs_of(spark, ODD)
    table = spark.createDataFrame(labels, LABELS)
    assert quality_scores(frame, fit_quality(frame, table)).count() == len(ODD)
    assert toxicity(frame, fit_toxicity(frame, table)).filter("toxic").count() == 0
    empty = docs_of(spark, [])
    assert quality_scores(empty, fit_quality(empty, table)).count() == 0 and toxicity(empty, fit_toxicity(empty, table)).count() == 0
