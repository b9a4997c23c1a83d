"""Tables without a primary key against a plain replay of multisets."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changeflow.model import TableSpec
from changeflow.operators.nopk import COPIES_PER_BLOCK, SPREAD, _fetch, collapse, expand, nopk_delta, replay_nopk

SPEC = TableSpec.of("S", "N", {"g": "SIGNED INTEGER", "a": "VARCHAR", "b": "VARCHAR"})
NAMES = ("g", "a", "b")


def replay(rows, log):
    state = Counter(rows)
    for op, cur, old in log:
        if op == "I":
            state[tuple(cur.get(n) for n in NAMES)] += 1
        elif op == "U":
            sets = {n: v for n, v in cur.items() if not (v is not None and n in old and v == old[n])}
            nxt = Counter()
            for row, n in state.items():
                r = dict(zip(NAMES, row))
                hit = old and all(r[c] == v for c, v in old.items())
                nxt[tuple(sets.get(c, r[c]) if hit else r[c] for c in NAMES)] += n
            state = nxt
        elif len(old) == len(NAMES) and all(v is not None for v in old.values()):
            state.pop(tuple(old[n] for n in NAMES), None)
    return sorted((r for r, n in state.items() for _ in range(n)), key=repr)


def random_change(rng, g):
    values = [None, "x", "y", "z"]
    op = rng.choice("IUUUD")
    row = {"g": g, "a": rng.choice(values), "b": rng.choice(values)}
    if op == "I":
        return op, row, {}
    if op == "D":
        return op, {}, row
    old = row if g % 2 else {n: v for n, v in row.items() if n == "g" or rng.random() < 0.7}
    cur = {n: rng.choice(values) for n in ("a", "b") if rng.random() < 0.7}
    return op, cur, old


@pytest.mark.parametrize("chunk", [2, 1 << 20])
def test_random_logs(spark, chunk):
    rng = random.Random(11)
    rows, logs, want = [], [], []
    for g in range(60):
        mine = [(g, rng.choice([None, "x", "y"]), rng.choice(["x", "y"])) for _ in range(5)]
        log = [random_change(rng, g) for _ in range(8)]
        rows += mine
        logs.append(log)
        want += replay(mine, log)

    def cell(name, cur, old):
        c, o = cur.get(name), old.get(name)
        return (None if c is None else str(c), None if o is None else str(o), name in cur, name in old)

    events = [
        ("t", 0, g * 100 + i, 0, op, {n: cell(n, cur, old) for n in NAMES if n in cur or n in old}, None)
        for g, log in enumerate(logs)
        for i, (op, cur, old) in enumerate(log)
    ]
    df = spark.createDataFrame(
        events,
        "topic string, partition int, offset bigint, item int, op string, "
        "cols map<string,struct<cur:string,old:string,has_cur:boolean,has_old:boolean>>, "
        "error struct<code:string,detail:string>",
    )
    table = spark.createDataFrame(rows, SPEC.row_schema())
    out = replay_nopk(table, df, SPEC, chunk_offsets=chunk)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(want, key=repr)
    # the signed numbers of copies are the difference of both tables, and nothing else
    delta = nopk_delta(collapse(table, SPEC), df, SPEC, chunk_offsets=chunk)
    change = Counter(want)
    change.subtract(rows)
    assert {(r["g"], r["a"], r["b"]): r["n"] for r in delta.collect()} == {r: n for r, n in change.items() if n}


def test_long_chain_of_full_updates(spark):
    """One row changed many times: the chain is followed as a whole."""
    n = 300
    cell = "struct<cur:string,old:string,has_cur:boolean,has_old:boolean>"
    step = lambda name, cur, old: F.struct(
        F.lit(name).alias("key"),
        F.struct(cur.cast("string"), old.cast("string"), F.lit(True), F.lit(True)).cast(cell).alias("value"),
    )
    log = spark.range(n).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit(0).alias("item"),
        F.lit("U").alias("op"),
        F.map_from_entries(
            F.array(
                step("g", F.lit(1), F.lit(1)), step("a", F.col("id") + 1, F.col("id")), step("b", F.lit("k"), F.lit("k"))
            )
        ).alias("cols"),
        F.lit(None).cast("struct<code:string,detail:string>").alias("error"),
    )
    seed = spark.createDataFrame([(1, "0", "k"), (1, "0", "k"), (1, "7", "k"), (2, "0", "k")], SPEC.row_schema())
    out = sorted(tuple(r) for r in replay_nopk(seed, log, SPEC, chunk_offsets=16).collect())
    assert out == [(1, str(n), "k")] * 3 + [(2, "0", "k")]


def test_many_copies_are_written_in_blocks(spark):
    n = 2 * COPIES_PER_BLOCK + 5
    one = spark.range(1).select(F.lit(1).alias("g"), F.lit("a").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(n).cast("bigint").alias("n"))
    assert expand(one, SPEC).count() == n
    assert expand(one.withColumn("n", F.lit(COPIES_PER_BLOCK).cast("bigint")), SPEC).count() == COPIES_PER_BLOCK


def test_rows_of_one_match_key_are_dealt_to_several_tasks(spark):
    looking = spark.range(400).select(F.col("id"), F.lit("m").alias("match"), F.lit(0).alias("seq"), F.pmod(F.xxhash64("id"), F.lit(SPREAD)).cast("int").alias("salt"))
    answers = spark.createDataFrame([("m", 0, "x"), ("n", 0, "y")], "match string, seq int, hit string")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = _fetch(looking, answers).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 400 and {r["hit"] for r in got} == {"x"}
    assert len({r["task"] for r in got}) > 4
