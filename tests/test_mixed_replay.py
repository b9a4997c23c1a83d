"""The mixed key-change query, which has no SQL form, against plain replay of the same log."""

from replay import replay

from changeflow.plans import load_queries, logs

SF_DIR = "/root/testdata/sf0.001"
NAMES = ("c2", "c3", "c4")


def test_mixed_key_changes(spark):
    log = []
    for r in logs.mixed_key_changes(spark, SF_DIR).orderBy("seq").collect():
        cols = {n: r[f"c_{n}"]["cur"] for n in NAMES if r[f"c_{n}"] is not None}
        log.append((r["op"], r["s_c1"], r["d_c1"], cols))
    seed = {r["c1"]: {n: r[n] for n in NAMES} for r in logs.user_seed(spark, SF_DIR).collect()}
    want, outcomes = replay(seed, log, NAMES)
    assert {"moved", "missing"} <= set(outcomes)
    got = load_queries()[0]["key_change_mixed"](spark, SF_DIR).collect()
    assert sorted((r["c1"], *[r[n] for n in NAMES]) for r in got) == sorted(
        (k, *[row[n] for n in NAMES]) for k, row in want.items()
    )
