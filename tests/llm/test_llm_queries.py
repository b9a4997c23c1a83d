"""Every registered query of the subpackage against its SQL, and the pipeline stage by stage."""

import os

import pytest
from llm_helpers import shingle_set, words
from oracle_check import compare, connect

import corpus_pipeline
from changeflow.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert compare(df, connect(SF_DIR), ORACLES[name]) is None
    else:
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
        assert df.count() == docs


def test_pipeline(spark, tmp_path):
    docs, held = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        held.append((name, before, docs.collect()))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    stages = {name: (before, after) for name, before, after in held}

    before, after = stages["near_dedup"]
    left = [shingle_set(r.text) for r in after]
    near = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    assert not any(near(a, b) for i, a in enumerate(left) for b in left[:i])
    # every dropped document leads to one that stays, over links to dropped or kept ones
    sets, kept = {r.doc_id: shingle_set(r.text) for r in before}, {r.doc_id for r in after}
    reached, edge = set(kept), list(kept)
    while edge:
        a = edge.pop()
        new = [d for d in sets if d not in reached and near(sets[a], sets[d])]
        reached.update(new)
        edge += new
    assert reached == set(sets)

    before, after = stages["decontamination"]
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in before if not any(100 * len(shingle_set(r.text) & i) >= 75 * len(i) for i in items)}
    assert {r.doc_id for r in after} == clean

    before, after = stages["mixing"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    total = lambda rows: sum(len(words(r.text)) for r in rows)
    assert abs(total(after) - 1.5 * total(before)) < 0.1 * total(before)

    before, after = stages["token_output"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
    assert min(r.start for r in after) == 0 and all(0 <= r.ids_crc32 < 2**32 for r in after)
