import random

import pytest
from llm_helpers import ODD, docs_of, words

from changeflow.llm import mixing
from changeflow.llm.mixing import curriculum, mix_plan


def water_fill(sizes, share=1.5, cap=2.0):
    """Targets by giving out shares and resharing what is above a cap until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        rate = (total - sum(out.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if rate * weight[s] > cap * sizes[s]}
        if not over:
            return out | {s: rate * weight[s] for s in open_}
        out |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return out


ROWS = [(i, " ".join(["w"] * (i * 7 % 60)), random.Random(i).choice(["b", "a", "é", "", "hot", "hot", "hot", None])) for i in range(400)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:3], [(d, t, None) for d, t in ODD], [(1, "", "a"), (2, None, "b")]])
def test_targets_and_words(spark, rows, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 20)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = water_fill(sizes)
    got = mix_plan(docs_of(spark, rows), carry=["source"]).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        source, words_taken = r.document.source, sum(c.words for c in r.copies)
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert words_taken <= 2 * r.size
        assert all(0 <= c.position <= 1 for c in r.copies)
        taken[source] = taken.get(source, 0) + words_taken
    for source, n in taken.items():
        assert n == int(want[source] + 1e-6)


def test_reruns_agree(spark):
    docs = docs_of(spark, ROWS)
    key = lambda r: repr((r.doc_id, r.size, r.copies))
    assert sorted(map(key, mix_plan(docs).collect())) == sorted(map(key, mix_plan(docs.repartition(7)).collect()))


def test_curriculum(spark):
    docs = docs_of(spark, ROWS)
    out = curriculum(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    per_source, per_doc = {}, {}
    for r in rows:
        per_source[r.source] = per_source.get(r.source, 0) + len(words(r.text))
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + 1
    assert max(per_doc.values()) <= 2
    want = water_fill({s: sum(len(words(t)) for _, t, u in ROWS if u == s) for s in {r[2] for r in ROWS}})
    for source, n in per_source.items():
        assert abs(n - want[source]) <= 60


def test_schedules_shape_time(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b") for i in range(400)]
    falling, rising = ((0.0, 2.0), (1.0, 0.0)), ((0.0, 0.0), (1.0, 2.0))
    plan = mix_plan(docs_of(spark, rows), carry=["source"], schedules=(falling, rising)).collect()
    early = {s: sum(c.words for r in plan if r.document.source == s for c in r.copies if c.position < 0.5) for s in "ab"}
    every = {s: sum(c.words for r in plan if r.document.source == s for c in r.copies) for s in "ab"}
    assert early["a"] / every["a"] == pytest.approx(0.75, abs=0.02)
    assert early["b"] / every["b"] == pytest.approx(0.25, abs=0.02)


def test_empty_table(spark):
    assert mix_plan(docs_of(spark, [])).count() == 0 and curriculum(docs_of(spark, [])).count() == 0
