import random

import pytest
from llm_helpers import ODD, docs_of, shingle_set

from changeflow.llm import near_dedup
from changeflow.llm.components import connected_components, joined_components
from changeflow.llm.near_dedup import near_duplicates, without_near_duplicates


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 75 * (len(a) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted([(d, len(sets[i]), ids.get(find(i))) for i, (d, _) in enumerate(rows)], key=repr)


def near_copies(seed, groups=12, most=14):
    rng = random.Random(seed)
    rows, passage = [], [f"p{i}" for i in range(12)]
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(500)}" for _ in range(rng.choice([6, 20, 60, 150]))] + passage * (g % 3 == 0)
        for _ in range(rng.randrange(1, most)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed, monkeypatch):
    # small blocks, so that groups are split
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "PER_TASK_HEAD", 2)
    rows = near_copies(seed)
    got = near_duplicates(docs_of(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    rows = [*ODD, (20, "x y"), (21, "X  y"), (22, None)]
    docs = docs_of(spark, rows)
    got = near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    left = without_near_duplicates(docs)
    assert left.columns == docs.columns
    # one of each component; empty texts are components of their own
    kept = sorted((r.doc_id for r in left.collect()), key=repr)
    assert kept == sorted([1, 2, 3, 4, 6, 7, 9, 20, 22, None], key=repr)


def test_empty_table(spark):
    assert near_duplicates(docs_of(spark, [])).count() == 0 and without_near_duplicates(docs_of(spark, [])).count() == 0


def test_long_chain(spark):
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"\xf0", b"\xf1")], "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in connected_components(edges).collect()}
    assert got == {bytes([i]): b"\0" for i in range(41)} | {b"\xf0": b"\xf0", b"\xf1": b"\xf0"}


def test_further_edges_join_components(spark):
    rng = random.Random(5)
    n = lambda i: bytes([i // 256, i % 256])
    edges = [(n(rng.randrange(300)), n(rng.randrange(300))) for _ in range(250)]
    frame = lambda e: spark.createDataFrame([x for x in e if x[0] != x[1]], "a binary, b binary")
    labels = joined_components(connected_components(frame(edges[:120])), frame(edges[120:]))
    got = {bytes(r.node): bytes(r.root) for r in labels.collect()}
    want = {bytes(r.node): bytes(r.root) for r in connected_components(frame(edges)).collect()}
    assert got == want
