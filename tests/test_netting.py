"""Netting and merging against sequential replay, for many random logs and for any batch split."""

import random

import pytest
from pyspark.sql import functions as F
from replay import random_log, replay

from changeflow.model import TableSpec
from changeflow.operators.apply import merge_batch
from changeflow.operators.archive import applied_script
from changeflow.operators.bind import typed_changes
from changeflow.operators import keychange
from changeflow.operators.keychange import batch_lineage, key_change_lineage, key_change_outcomes, net_batch
from changeflow.operators.net import net_changes, net_lineage, net_rejects

SPEC = TableSpec.of(
    "S", "T", {"g": "SIGNED INTEGER", "c1": "SIGNED INTEGER", "c2": "VARCHAR", "c3": "VARCHAR"}, ["g", "c1"]
)
LOG_SCHEMA = (
    "topic string, partition int, offset bigint, op string, g int, old int, new int, "
    "has_c2 boolean, c2 string, has_c3 boolean, c3 string"
)


def to_changes(spark, logs, chunk=4):
    """Many independent logs in one DataFrame: ``g`` is part of the key."""
    rows = []
    for g, log in enumerate(logs):
        for i, (op, old, new, cols) in enumerate(log):
            rows.append(
                ("t", 0, g * 1000 + i, op, g, old, new, "c2" in cols, cols.get("c2"), "c3" in cols, cols.get("c3"))
            )
    df = spark.createDataFrame(rows, LOG_SCHEMA)
    return typed_changes(
        df,
        SPEC,
        F.col("op"),
        {"g": F.col("g"), "c1": F.col("old")},
        {"g": F.col("g"), "c1": F.col("new")},
        {"c2": (F.col("has_c2"), F.col("c2")), "c3": (F.col("has_c3"), F.col("c3"))},
        chunk_offsets=chunk,
    )


def to_snapshot(spark, tables):
    rows = [(g, k, r["c2"], r["c3"]) for g, t in enumerate(tables) for k, r in t.items()]
    return spark.createDataFrame(rows, SPEC.row_schema())


def expected_rows(tables):
    return sorted(((g, k, r["c2"], r["c3"]) for g, t in enumerate(tables) for k, r in t.items()), key=repr)


def collect(df):
    return sorted((tuple(r) for r in df.select("g", "c1", "c2", "c3").collect()), key=repr)


def seeds(rng, n, n_keys):
    return [
        {k: {"c2": f"s{k}", "c3": None} for k in range(n_keys) if rng.random() < 0.5} for _ in range(n)
    ]


@pytest.mark.parametrize("ops", ["IUD", "IUKD", "KKKU", "KKKKID"])
def test_net_and_merge_equal_replay(spark, ops):
    rng = random.Random(7 + len(ops))
    tables = seeds(rng, 250, 6)
    logs = [random_log(rng, rng.randrange(1, 25), 6, ops) for _ in tables]
    want = [replay(t, log, ("c2", "c3"))[0] for t, log in zip(tables, logs)]
    snapshot = to_snapshot(spark, tables)
    result = net_batch(to_changes(spark, logs), SPEC, snapshot)
    assert collect(merge_batch(snapshot, result.net, SPEC)) == expected_rows(want)


def test_outcomes_of_key_changes(spark):
    rng = random.Random(3)
    tables = seeds(rng, 200, 5)
    logs = [random_log(rng, 20, 5, "IKKKD") for _ in tables]
    want = {}
    for g, (t, log) in enumerate(zip(tables, logs)):
        for i, s in enumerate(replay(t, log, ("c2", "c3"))[1]):
            if s:
                want[g * 1000 + i] = s
    got = key_change_outcomes(to_changes(spark, logs), SPEC, to_snapshot(spark, tables))
    assert {r["offset"]: r["status"] for r in got.select("seq.offset", "status").collect()} == want
    collided = net_batch(to_changes(spark, logs), SPEC, to_snapshot(spark, tables)).rejects
    found = {(r["code"], r["offset"]) for r in collided.select("error.code", "seq.offset").collect()}
    late = set()
    for g, log in enumerate(logs):
        emptied = set()
        for i, (op, old, new, _) in enumerate(log):
            if op == "I":
                emptied.discard(new)
            elif op == "D":
                emptied.add(old)
            elif op == "K" and want[g * 1000 + i] == "moved":
                emptied.add(old)
                emptied.discard(new)
            elif op == "U" and old in emptied:
                late.add(("after_delete", g * 1000 + i))
    assert found == late | {("key_collision", k) for k, s in want.items() if s == "collision"}


@pytest.mark.parametrize("cut", [1, 5, 11])
def test_result_does_not_depend_on_batch_split(spark, cut):
    rng = random.Random(cut)
    tables = seeds(rng, 60, 5)
    logs = [random_log(rng, 18, 5) for _ in tables]
    want = [replay(t, log, ("c2", "c3"))[0] for t, log in zip(tables, logs)]
    state = to_snapshot(spark, tables)
    for part in ([log[:cut] for log in logs], [log[cut:] for log in logs]):
        state = merge_batch(state, net_batch(to_changes(spark, part), SPEC, state).net, SPEC)
    assert collect(state) == expected_rows(want)


def test_hot_key_scan_is_chunked(spark):
    """One key holds all rows: rejects and lineage must still come out per chunk and be exact."""
    rng = random.Random(1)
    log = random_log(rng, 400, 1, "IUUUD")
    state, bad, good = None, [], []
    for i, (op, *_rest) in enumerate(log):
        if op == "U" and state == "D":
            bad.append(i)
        else:
            good.append(i)
        state = op if op in "ID" else state
    changes = to_changes(spark, [log], chunk=7)
    assert sorted(r[0] for r in net_rejects(changes, SPEC).select("seq.offset").collect()) == bad
    assert sorted(r[0] for r in net_lineage(changes, SPEC).select("offset").collect()) == good


def test_old_value_comes_from_first_update(spark):
    log = [("U", 0, 0, {"c2": "b"}), ("U", 0, 0, {"c2": "c"})]
    df = spark.createDataFrame(
        [("t", 0, 0, "a", "b"), ("t", 0, 1, "b", "c")], "topic string, partition int, offset bigint, o string, n string"
    )
    key = {"g": F.lit(0), "c1": F.lit(0)}
    changes = typed_changes(
        df, SPEC, F.lit("U"), key, key,
        {"c2": (F.lit(True), F.col("n")), "c3": (F.lit(False), F.lit(None))}, {"c2": F.col("o")},
    )
    row = net_changes(changes, SPEC, with_old=True).select("c_c2.cur", "c_c2.old", "c_c3", "n_events").collect()
    assert [tuple(r) for r in row] == [("c", "a", None, 2)]
    assert len(log) == 2


def lineage_replay(table, log):
    """Key -> offsets behind it: (row there, or None if unknown; offsets)."""
    keys = {k: (True, []) for k in table}
    for o, (op, old, new, _) in enumerate(log):
        there, history = keys.get(old, (None, []))
        if op in "ID":
            keys[new] = (op == "I", history + [o])
        elif op == "U" and there is not False:
            keys[new] = (there, history + [o])
        elif op == "K" and there and not keys.get(new, (None, []))[0]:
            keys[new] = (True, keys.get(new, (None, []))[1] + history + [o])
            keys[old] = (False, [o])
    return {k: sorted(set(h)) for k, (_, h) in keys.items() if h}


@pytest.mark.parametrize("ops", ["IUD", "IUKD", "KKKU", "KKKKID"])
def test_lineage_follows_rows_through_key_changes(spark, ops):
    rng = random.Random(11 + len(ops))
    tables = seeds(rng, 200, 6)
    logs = [random_log(rng, rng.randrange(1, 25), 6, ops) for _ in tables]
    found = {}
    for r in key_change_lineage(to_changes(spark, logs), SPEC, to_snapshot(spark, tables)).collect():
        g, o = divmod(r["offset"], 1000)
        assert r["d_g"] == g and r["op"] == logs[g][o][0]
        found.setdefault((g, r["d_c1"]), []).append(o)
    want = {(g, k): h for g, (t, log) in enumerate(zip(tables, logs)) for k, h in lineage_replay(t, log).items()}
    assert {k: sorted(h) for k, h in found.items()} == want


def with_old_values(log, seed):
    """The log with the value that every set column of a row had before; None where there was no row."""
    rows, out = {k: dict(v) for k, v in seed.items()}, []
    for op, old, new, cols in log:
        before = rows.get(old, {})
        out.append((op, old, new, cols, {n: before.get(n) for n in cols} if op in "UK" else {}))
        rows, _ = replay(rows, [(op, old, new, cols)], ("c2", "c3"))
    return out


@pytest.mark.parametrize("ops", ["IUD", "IUKD", "UUUK"])
def test_columns_that_end_as_they_began_are_not_written(spark, ops):
    rng = random.Random(11)
    n_keys, tables = 5, seeds(rng, 40, 5)
    # few values, so that many columns return to what they were
    logs = [
        with_old_values([(op, a, b, {n: v and rng.choice([v[:2], f"s{a}"]) for n, v in cols.items()}) for op, a, b, cols in random_log(rng, 8, n_keys, ops)], t)
        for t in tables
    ]
    rows = [
        ("t", 0, g * 1000 + i, op, g, a, b, "c2" in cols, cols.get("c2"), "c3" in cols, cols.get("c3"), olds.get("c2"), olds.get("c3"))
        for g, log in enumerate(logs) for i, (op, a, b, cols, olds) in enumerate(log)
    ]
    df = spark.createDataFrame(rows, LOG_SCHEMA + ", old_c2 string, old_c3 string")
    changes = typed_changes(
        df, SPEC, F.col("op"), {"g": F.col("g"), "c1": F.col("old")}, {"g": F.col("g"), "c1": F.col("new")},
        {n: (F.col(f"has_{n}"), F.col(n)) for n in ("c2", "c3")}, {n: F.col(f"old_{n}") for n in ("c2", "c3")}, chunk_offsets=4,
    )
    snapshot = to_snapshot(spark, tables)
    plain = net_batch(changes, SPEC, snapshot).net
    slim = net_batch(changes, SPEC, snapshot, skip_unchanged=True).net
    wanted = [replay(t, [e[:4] for e in log], ("c2", "c3"))[0] for t, log in zip(tables, logs)]
    assert collect(merge_batch(snapshot, slim, SPEC)) == expected_rows(wanted)
    assert collect(merge_batch(snapshot, plain, SPEC)) == expected_rows(wanted)
    assert slim.filter("op = 'U'").count() < plain.filter("op = 'U'").count()
    before = {(g, k): r for g, t in enumerate(tables) for k, r in t.items()}
    for r in slim.filter("op IN ('U', 'K')").collect():
        row = before.get((r["s_g"], r["s_c1"]), {})
        for n in ("c2", "c3"):
            if r[f"c_{n}"] is not None and row.get(n) is not None:
                assert r[f"c_{n}"]["cur"] != row[n]


def test_applied_script_names_every_offset_of_a_statement_once(spark):
    rng = random.Random(5)
    tables, logs = seeds(rng, 20, 5), [random_log(rng, 12, 5) for _ in range(20)]
    changes, snapshot = to_changes(spark, logs), to_snapshot(spark, tables)
    result = net_batch(changes, SPEC, snapshot)
    lineage = batch_lineage(changes, SPEC, result)
    script = applied_script(result.net, lineage, SPEC, offsets_per_line=4).collect()
    named, statements = {}, {}
    for r in script:
        text, offsets = r["sql_text"].rsplit("-- ", 1)
        key = (r["d_g"], r["d_c1"])
        named.setdefault(key, set()).update((r["topic"], r["partition"], int(o)) for o in offsets.split(","))
        assert {int(o) // 4 for o in offsets.split(",")} == {r["line"]}
        if text:
            statements.setdefault(key, []).append((r["line"], text))
    made_by = {}
    for r in lineage.collect():
        made_by.setdefault((r["d_g"], r["d_c1"]), set()).add((r["topic"], r["partition"], r["offset"]))
    net = {}
    for r in result.net.collect():
        net.setdefault((r["d_g"], r["d_c1"]), []).append(r["op"])
    assert named == {k: v for k, v in made_by.items() if k in net}
    first = {"D": "DELETE", "I": "UPSERT", "U": "UPDATE", "K": "UPDATE"}
    for key, found in statements.items():
        assert sorted(t.split()[0] for _, t in found) == sorted(first[op] for op in net[key])
        # at the last change of the key
        assert {line for line, _ in found} == {max(o for _, _, o in made_by[key]) // 4}
    assert set(statements) == set(named)


def test_merge_sends_out_a_small_net(spark):
    snapshot = spark.range(100000).selectExpr("cast(id % 10 as int) g", "cast(id as int) c1", "'x' c2", "'y' c3")
    changes = to_changes(spark, [[("U", 10, 10, {"c2": "new"})], [("I", 5, 5, {"c2": "new"}), ("D", 1, 1, {})]])
    merged = merge_batch(snapshot, net_changes(changes, SPEC), SPEC)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        got = merged.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(got) == 100000 and sorted((r["g"], r["c1"]) for r in got if r["c2"] == "new") == [(0, 10), (1, 5)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan.split("Initial Plan")[0]


def test_key_change_replay_in_chunks_and_many_rounds(spark, monkeypatch):
    """Hot keys are scanned in chunks of places; a chain of moves settles over several rounds with the settled ones left out."""
    monkeypatch.setattr(keychange, "PLAIN_ROWS", 3)
    monkeypatch.setattr(keychange, "CHUNK_BITS", 1)
    rng = random.Random(5)
    logs = [random_log(rng, 12, 3, "IUKKD"), [("K", k, k + 1, {"c2": "m"}) for k in reversed(range(8))]]
    tables = [{0: {"c2": "s0", "c3": None}}, {k: {"c2": f"s{k}", "c3": "x"} for k in range(8)}]
    want = [replay(t, log, ("c2", "c3"))[0] for t, log in zip(tables, logs)]
    snapshot = to_snapshot(spark, tables)
    assert collect(merge_batch(snapshot, net_batch(to_changes(spark, logs), SPEC, snapshot).net, SPEC)) == expected_rows(want)


def test_settled_key_changes_are_not_joined_again(spark, monkeypatch):
    """Rounds look up what was settled in the round before and what is open, never all key changes again."""
    looked_up = []
    wires = keychange._wires

    def counted(moves):
        looked_up.append(moves.count())
        return wires(moves)

    monkeypatch.setattr(keychange, "_wires", counted)
    n = 16
    log = [("K", k, k + 1, {"c2": "m"}) for k in reversed(range(n))]
    snapshot = to_snapshot(spark, [{k: {"c2": f"s{k}", "c3": "x"} for k in range(n)}])
    out = key_change_outcomes(to_changes(spark, [log]), SPEC, snapshot)
    assert {r["status"] for r in out.collect()} == {"moved"}
    assert len(looked_up) >= 4 and sum(looked_up) < 3 * n * len(looked_up) / 4


def test_replay_refers_to_changes_by_number(spark):
    """No topic, partition and offset in the rows and references that are sorted and joined: they made most of a task's memory."""
    log = [("I", 1, 1, {"c2": "a"}), ("K", 1, 2, {"c2": "b"}), ("U", 2, 2, {"c3": "c"})]
    snapshot = to_snapshot(spark, [{}])
    scanned = net_batch(to_changes(spark, [log]), SPEC, snapshot).replayed.scanned
    assert scanned.schema["seq"].dataType.simpleString() == "bigint"
    assert scanned.schema["prev"].dataType["seq"].dataType.simpleString() == "bigint"
    assert "chunk" not in scanned.columns
