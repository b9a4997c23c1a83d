"""Netting with key changes: rows that move from key to key inside a batch.

Replay in log order is the meaning; it is computed with joins and aggregations only:

* Only keys that some key change touches take this path; all other keys use ``net_changes``.
* A key change reads two facts: is its old key occupied (a), is its new key occupied (b). It moves the
  row only if a and not b. Afterwards the old key is occupied iff (a and b), the new key iff (a or b).
  These facts are constants (insert, delete, snapshot) or the outcome of an earlier key change. Each
  round replaces references by known outcomes, and jumps over outcomes that merely pass another one on,
  so chains take a logarithmic number of rounds. Every round settles at least the earliest open key
  change, hence the loop ends with the exact outcome for any log, valid or not.
* Rows are then identified by their root (an insert, or a snapshot key) by pointer jumping over the key
  changes that moved them. Columns are aggregated per segment and per root, map-side combined.
* The changes of the touched keys are sorted by the log once and numbered. All later sorts, joins and references are on these
  numbers: a topic, partition and offset in every row and reference would be most of what the shuffles and sorts hold.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeflow.functions.scan import carry_previous
from changeflow.model import TableSpec
from changeflow.operators.bind import dst_cols, src_cols, val_cols
from changeflow.operators.net import net_changes, net_lineage, net_rejects, net_without_noops, overlay_aggs, unchanged
from changeflow.session import cut_lineage



# a log of touched keys none of which has more rows than this is scanned key by key, else in chunks of 2^CHUNK_BITS places
PLAIN_ROWS = 1 << 16
CHUNK_BITS = 20


@dataclass
class Replayed:
    """The replayed key changes of a batch: several results are made of them.

    ``ranked``: all changes of the touched keys with their ``place`` in the log as one number, which ``outcome`` and ``scanned`` have as ``seq``.
    """

    ranked: DataFrame
    touched: DataFrame
    outcome: DataFrame
    scanned: DataFrame


class NetResult:
    """``net`` is worked out when it is asked for first: who wants the rejects alone does not pay for it."""

    def __init__(self, net: Callable[[], DataFrame], rejects: DataFrame, replayed: Replayed | None = None):
        self._net, self.rejects = net, rejects
        # the replayed key changes, if there were any: the lineage needs them again
        self.replayed = replayed

    @cached_property
    def net(self) -> DataFrame:
        return self._net()


def net_batch(changes: DataFrame, spec: TableSpec, snapshot: DataFrame, skip_unchanged: bool = False) -> NetResult:
    """Net a batch; the key-change path runs only if the batch holds a key change.

    ``skip_unchanged`` leaves out columns that end with the value they began with, by the old values in the messages, and updates without
    any other column.
    """
    if changes.filter(F.col("op") == "K").isEmpty():
        netted = net_without_noops(changes, spec) if skip_unchanged else net_changes(changes, spec)
        return NetResult(lambda: netted.drop("n_events", "last_seq"), net_rejects(changes, spec).select(*_reject_columns(spec)))
    return net_with_key_changes(changes, spec, snapshot, skip_unchanged)


def net_with_key_changes(changes: DataFrame, spec: TableSpec, snapshot: DataFrame, skip_unchanged: bool = False) -> NetResult:
    """Net changes of a batch that may change keys.

    Net rows: U and D as usual, K moves a snapshot row from ``s_*`` to ``d_*``, I with a null source key is a
    row inserted in the batch on a touched key; a D accompanies each touched key whose snapshot row is gone.
    ``rejects`` (order, operation, keys and ``error``) holds the key changes whose new key was occupied and the updates of rows that an
    earlier change of the batch deleted or moved away.
    """
    keys = [f"k_{k}" for k in spec.key_names]
    replayed = _replayed(changes, spec, snapshot, keys)
    plain = changes.filter(F.col("op") != "K")
    collided = replayed.outcome.filter("a and b").select(F.col("seq").alias("place"))
    vacant = replayed.scanned.filter((F.col("kind") == "U") & F.col("prev.kind").isin("D", "X")).select(F.col("seq").alias("place"))
    late = replayed.ranked.join(vacant, "place", "left_semi").select(
        "seq", F.lit("U").alias("op"), *_rename(dst_cols(spec), src_cols(spec)), *dst_cols(spec))
    elsewhere = net_rejects(_on_keys(plain, replayed.touched, spec, "d_", "left_anti"), spec)
    out = _reject_columns(spec)
    rejects = (
        _rejects(replayed.ranked.join(collided, "place", "left_semi"), "key_collision").select(*out)
        .unionByName(_rejects(late, "after_delete").select(*out))
        .unionByName(elsewhere.select(*out))
    )
    return NetResult(lambda: _net(plain, spec, replayed, keys, skip_unchanged), rejects, replayed)


def _net(plain: DataFrame, spec: TableSpec, replayed: Replayed, keys: list[str], skip_unchanged: bool) -> DataFrame:
    """Net changes of the touched keys from the replayed log, and of all others."""
    touched, scanned = replayed.touched, replayed.scanned
    # aggregate first: the anti join then sees one row per key
    netted = net_without_noops(plain, spec) if skip_unchanged else net_changes(plain, spec)
    simple = _on_keys(netted.drop("n_events", "last_seq"), touched, spec, "d_", "left_anti")
    values = val_cols(spec)

    roots = _roots(scanned, keys)
    stored_root = [f"r_{k}" for k in keys]
    root_cols = ["r_seq", *stored_root]

    # columns per segment, then per root
    prev = F.col("prev")
    segment_seq = F.when(F.col("kind").isin("I", "M"), F.col("seq")).when(F.col("kind") == "U", prev["seq"])
    segment_kind = F.when(F.col("kind").isin("I", "M"), F.col("kind")).when(
        F.col("kind") == "U", F.coalesce(prev["kind"], F.lit("S"))
    )
    in_snapshot_segment = F.col("g_kind") == "S"
    segments = (
        scanned.filter(F.col("kind").isin("I", "M", "U"))
        .select(
            "seq", *values, segment_kind.alias("g_kind"), segment_seq.alias("g_seq"), *keys
        )
        .filter(F.col("g_kind").isin("I", "M", "S"))
        .groupBy("g_kind", "g_seq", *[F.when(in_snapshot_segment, F.col(k)).alias(k) for k in keys])
        .agg(*overlay_aggs(spec, skip_unchanged))
    )
    # only rows that a key change brought have their root elsewhere
    firsts = [f"first_{c}" for c in values] if skip_unchanged else []
    lasts = [*[f"last_{c}" for c in values], *firsts]
    own_root = segments.filter(F.col("g_kind") != "M").select(
        F.when(F.col("g_kind") == "I", F.col("g_seq")).alias("r_seq"),
        *[F.when(in_snapshot_segment, F.col(k)).alias(f"r_{k}") for k in keys], *lasts,
    )
    moved_root = segments.filter(F.col("g_kind") == "M").join(roots.withColumnRenamed("seq", "g_seq"), "g_seq", "left")
    rooted = own_root.unionByName(moved_root.select(*root_cols, *lasts))
    # read for rows inserted in the batch and for stored rows: they are joined apart, each by its own root
    rows = cut_lineage(rooted.groupBy(*root_cols).agg(*[F.max(f"last_{c}").alias(f"last_{c}") for c in values], *[F.min(c).alias(c) for c in firsts]))

    # where every surviving row ends up
    places = cut_lineage(_ends(scanned, touched, roots, keys, root_cols))
    is_fresh = F.col("r_seq").isNotNull()

    def cells(counts: Callable[[str], Column]) -> list[Column]:
        return [F.when(counts(c), F.struct(F.col(f"last_{c}")["cur"].alias("cur"))).alias(c) for c in values]

    def is_set(c: str) -> Column:
        return F.col(f"last_{c}").isNotNull()

    def changed(c: str) -> Column:
        return is_set(c) & ~unchanged(F.col(f"last_{c}")["cur"], F.col(f"first_{c}")["old"]) if skip_unchanged else is_set(c)

    def typed_null(k: str) -> Column:
        return F.lit(None).cast(places.schema[k].dataType)

    fresh = places.filter(is_fresh).drop(*stored_root).join(rows.filter(is_fresh).drop(*stored_root), "r_seq", "left").select(
        F.lit("I").alias("op"), *[typed_null(k).alias("s" + k[1:]) for k in keys], *[F.col(k).alias("d" + k[1:]) for k in keys], *cells(is_set))
    unmoved = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"r_{k}") for k in keys])
    named = rows.filter(~is_fresh).drop("r_seq").withColumn("_set", F.lit(True))
    stored = places.filter(~is_fresh).drop("r_seq").join(named, stored_root, "left").filter(~unmoved | F.col("_set")).select(
        F.when(unmoved, "U").otherwise("K").alias("op"),
        *[F.col(f"r_{k}").alias("s" + k[1:]) for k in keys], *[F.col(k).alias("d" + k[1:]) for k in keys], *cells(changed))
    if skip_unchanged:
        stored = stored.filter((F.col("op") != "U") | reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in values], F.lit(False)))
    kept_sources = places.filter(~is_fresh).select(*[F.col(f"r_{k}").alias(k) for k in keys])
    gone = touched.join(kept_sources, keys, "left_anti").select(
        F.lit("D").alias("op"),
        *[F.col(k).alias("s" + k[1:]) for k in keys],
        *[F.col(k).alias("d" + k[1:]) for k in keys],
        *[F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in values],
    )
    return simple.unionByName(fresh).unionByName(stored).unionByName(gone)


def _ends(scanned: DataFrame, touched: DataFrame, roots: DataFrame, keys: list[str], root_cols: list[str]) -> DataFrame:
    """Touched keys that hold a row at the end, with its root."""
    inserted, arrived = 0, 1
    code = F.when(F.col("kind") == "I", inserted).when(F.col("kind") == "M", arrived).otherwise(2)
    # place and kind in one number: the maximum is kept in place, without sorting
    last = scanned.filter(F.col("kind") != "U").groupBy(*keys).agg(F.max(F.col("seq") * 4 + code).alias("_last"))
    ends = touched.join(last, keys, "left").select(*keys, F.shiftright("_last", 2).alias("seq"), (F.col("_last") % 4).alias("code"))
    stored = F.col("code").isNull()
    own = ends.filter(stored | (F.col("code") == inserted)).select(
        *keys, F.col("seq").alias("r_seq"), *[F.when(stored, F.col(k)).alias(f"r_{k}") for k in keys])
    moved = ends.filter(F.col("code") == arrived).select(*keys, "seq").join(roots, "seq", "left")
    return own.unionByName(moved.select(*keys, *root_cols))


def _on_keys(df: DataFrame, touched: DataFrame, spec: TableSpec, prefix: str, how: str) -> DataFrame:
    return df.join(touched, [F.col(f"{prefix}{k}") == F.col(f"k_{k}") for k in spec.key_names], how)


def _touched(changes: DataFrame, spec: TableSpec, keys: list[str]) -> DataFrame:
    """Keys that some key change leaves or arrives at."""
    both = F.array(F.struct(*_rename(src_cols(spec), keys)), F.struct(*_rename(dst_cols(spec), keys)))
    return cut_lineage(changes.filter(F.col("op") == "K").select(F.explode(both).alias("k")).select("k.*").distinct())


def _ranked(changes: DataFrame, touched: DataFrame, spec: TableSpec) -> DataFrame:
    """Key changes and the changes of the keys they touch, numbered in log order (``place``).

    Range partitions are in log order and sorted inside, so numbers grow with the log over all of them.
    """
    stays = _on_keys(changes.filter(F.col("op") != "K"), touched, spec, "d_", "left_semi")
    named = stays.unionByName(changes.filter(F.col("op") == "K")).drop("chunk")
    return cut_lineage(named.repartitionByRange("seq").sortWithinPartitions("seq").withColumn("place", F.monotonically_increasing_id()))


def _log(ranked: DataFrame, spec: TableSpec, keys: list[str], values: list[str]) -> DataFrame:
    """The changes key by key. A key change leaves one key ('X') and arrives with its columns at another ('M')."""
    def at(kind: Column, cols: list[str]) -> Column:
        return F.struct(kind.alias("kind"), *_rename(cols, keys))

    leaves, arrives = at(F.lit("X"), src_cols(spec)), at(F.lit("M"), dst_cols(spec))
    steps = F.when(F.col("op") == "K", F.array(leaves, arrives)).otherwise(F.array(at(F.col("op"), dst_cols(spec))))
    log = ranked.select(F.col("place").alias("seq"), F.explode(steps).alias("_at"), *values)
    return log.select("seq", "_at.*", *[F.when(F.col("_at.kind") != "X", F.col(c)).alias(c) for c in values])


def _replayed(changes: DataFrame, spec: TableSpec, snapshot: DataFrame, keys: list[str]) -> Replayed:
    """Key changes, the keys they touch, their outcomes, and the changes of these keys with the one that filled or emptied the key before.

    The log of the touched keys has no moves that did not happen.
    """
    touched = _touched(changes, spec, keys)
    ranked = _ranked(changes, touched, spec)
    scanned = cut_lineage(_previous(_log(ranked, spec, keys, val_cols(spec)), keys))
    outcome = _settle(scanned, keys, spec, snapshot)
    if outcome.filter("not a or b").limit(1).count() > 0:
        # moves that did not happen leave no trace: look up the previous change again without them
        is_move = F.col("kind").isin("X", "M")
        moved = outcome.filter("a and not b").select("seq")
        log = scanned.drop("prev")
        effective = log.filter(~is_move).unionByName(
            log.filter(is_move).join(moved, "seq", "left_semi").select(*log.columns)
        )
        scanned = cut_lineage(_previous(effective, keys))
    return Replayed(ranked, touched, outcome, scanned)


def batch_lineage(changes: DataFrame, spec: TableSpec, result: NetResult) -> DataFrame:
    """Which offsets made each net change of a netted batch; key changes are not replayed again."""
    return _lineage(changes, spec, result.replayed) if result.replayed else net_lineage(changes, spec)


def key_change_lineage(changes: DataFrame, spec: TableSpec, snapshot: DataFrame) -> DataFrame:
    """Which offsets made each net change of a batch that may change keys, one row per key and contributing change.

    A row takes its history along: what happened at the old key, and a deletion pending at the new key, counts for the new key from then
    on. The old key is left with a deletion made by the key change, which so counts for both keys. Updates of rows that were
    deleted or moved away and key changes that did not happen contribute nothing. Like ``net_lineage`` the result is long, so neither a hot
    key nor a row that moves often is one cell or one task.

    Every change leads to the next key change at its key, and a key change to the next one at its new key. These pointers between key
    changes are followed by pointer jumping; changes without a later one count for the key they are at.
    """
    if changes.filter(F.col("op") == "K").isEmpty():
        return net_lineage(changes, spec)
    return _lineage(changes, spec, _replayed(changes, spec, snapshot, [f"k_{k}" for k in spec.key_names]))


def _lineage(changes: DataFrame, spec: TableSpec, replayed: Replayed) -> DataFrame:
    keys, dst = [f"k_{k}" for k in spec.key_names], dst_cols(spec)
    touched, scanned = replayed.touched, replayed.scanned
    vacant = (F.col("kind") == "U") & F.coalesce(F.col("prev.kind").isin("D", "X"), F.lit(False))
    counted = scanned.filter(~vacant).select("seq", F.shiftright("seq", CHUNK_BITS).alias("chunk"), "kind", *keys)
    onward = cut_lineage(carry_previous(counted, keys, F.col("seq"), F.col("kind").isin("X", "M"), "to", forward=True))

    # where the history goes that a key change brought: a later key change, or the key it ends at
    links = onward.filter(F.col("kind") == "M").select("seq", "to", *[F.when(F.col("to").isNull(), F.col(k)).alias(f"e{k}") for k in keys])
    ends = _followed(links, "to", [f"e{k}" for k in keys])
    here = onward.filter(F.col("to").isNull()).select(*keys, "seq", "kind")
    away = onward.filter(F.col("to").isNotNull()).select("seq", "kind", "to")
    # a key change that brought the history of many changes is one key of this join: only ends are looked up, adaptive execution splits it
    away = away.join(ends.withColumnRenamed("seq", "to"), "to").select(*[F.col(f"e{k}").alias(k) for k in keys], "seq", "kind")
    offsets = replayed.ranked.select("place", F.col("seq").alias("_seq"))
    found = here.unionByName(away).withColumnRenamed("seq", "place").join(offsets, "place").withColumnRenamed("_seq", "seq").select(
        *_rename(keys, dst), F.col("seq.topic").alias("topic"), F.col("seq.partition").alias("partition"), F.col("seq.offset").alias("offset"),
        F.when(F.col("kind").isin("X", "M"), "K").otherwise(F.col("kind")).alias("op"),
    )
    # a key change counts once where the history of both its keys meets again
    found = found.filter(F.col("op") != "K").unionByName(found.filter(F.col("op") == "K").distinct())
    return found.unionByName(net_lineage(_on_keys(changes, touched, spec, "d_", "left_anti"), spec))


def _followed(links: DataFrame, pointer: str, ends: list[str]) -> DataFrame:
    """``seq`` and the ``ends`` of the last link of its chain, by pointer jumping; only open links are joined and written again."""
    found, open_links = None, cut_lineage(links)
    while True:
        ended = open_links.filter(F.col(pointer).isNull())
        found = ended if found is None else found.unionByName(ended)
        open_links = open_links.filter(F.col(pointer).isNotNull())
        if open_links.isEmpty():
            return found.drop(pointer)
        target = found.unionByName(open_links).select(
            F.col("seq").alias("_id"), F.col(pointer).alias("_next"), *[F.col(c).alias(f"_{c}") for c in ends]
        )
        open_links = cut_lineage(
            open_links.join(target, F.col(pointer) == F.col("_id"), "left").select(
                "seq", F.col("_next").alias(pointer), *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in ends]
            )
        )


def key_change_outcomes(changes: DataFrame, spec: TableSpec, snapshot: DataFrame) -> DataFrame:
    """Outcome of every key change: ``moved``, ``collision`` (new key occupied) or ``missing`` (old key vacant)."""
    keys = [f"k_{k}" for k in spec.key_names]
    ranked = _ranked(changes.filter(F.col("op") != "U").select("seq", "op", "chunk", *src_cols(spec), *dst_cols(spec)), _touched(changes, spec, keys), spec)
    scanned = cut_lineage(_previous(_log(ranked, spec, keys, []), keys).filter(F.col("kind").isin("X", "M")))
    outcome = _settle(scanned, keys, spec, snapshot)
    status = F.when(F.expr("a and not b"), "moved").when(F.col("a"), "collision").otherwise("missing")
    places = ranked.filter(F.col("op") == "K").select("seq", "place")
    return places.join(outcome.select(F.col("seq").alias("place"), status.alias("status")), "place").select("seq", "status")


def _rename(old: list[str], new: list[str]) -> list[Column]:
    return [F.col(o).alias(n) for o, n in zip(old, new)]


def _reject_columns(spec: TableSpec) -> list[str]:
    return ["seq", "op", *src_cols(spec), *dst_cols(spec), "error"]


def _rejects(df: DataFrame, code: str) -> DataFrame:
    return df.withColumn(
        "error", F.struct(F.lit(code).alias("code"), F.lit(None).cast("string").alias("detail"))
    )


def _previous(log: DataFrame, keys: list[str]) -> DataFrame:
    """Add the previous change of the key that filled or emptied it."""
    value, when = F.struct("kind", "seq"), F.col("kind") != "U"
    if (log.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > PLAIN_ROWS:
        return carry_previous(log.withColumn("chunk", F.shiftright("seq", CHUNK_BITS)), keys, value, when, "prev").drop("chunk")
    before = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return log.withColumn("prev", F.last(F.when(when, value), ignorenulls=True).over(before))


def _settle(scanned: DataFrame, keys: list[str], spec: TableSpec, snapshot: DataFrame) -> DataFrame:
    """Occupancy of the old key (a) and the new key (b) just before every key change.

    A key change has two ports: what it makes of the old key (2 * seq) and of the new key (2 * seq + 1).
    """
    prev = F.col("prev")
    ports = scanned.filter(F.col("kind").isin("X", "M")).select("seq", "kind", *keys, "prev")
    stored = snapshot.select(*[F.col(k).alias(f"k_{k}") for k in spec.key_names], F.lit(True).alias("_stored"))
    none = F.lit(None).cast("bigint")
    port = F.when(prev["kind"].isin("X", "M"), prev["seq"] * 2 + F.when(prev["kind"] == "M", 1).otherwise(0))
    inside = F.when(prev["kind"] == "I", True).when(prev["kind"] == "D", False)
    inputs = ports.filter(prev.isNull()).join(stored, keys, "left").select(
        "seq", "kind", F.col("_stored").isNotNull().alias("val"), none.alias("ref")
    ).unionByName(ports.filter(prev.isNotNull()).select("seq", "kind", inside.alias("val"), port.alias("ref")))
    sides = {"a": F.col("kind") == "X", "b": F.col("kind") == "M"}
    moves = cut_lineage(
        inputs.groupBy("seq").agg(*[
            F.max(F.when(mine, F.col(c))).alias(n) for side, mine in sides.items() for c, n in (("val", side), ("ref", f"{side}_ref"))
        ])
    )
    # Only open key changes are joined and written again. They refer to open ones and to those settled in the round before: first
    # the references to these become known, so that none of them is passed on.
    settled = None
    while True:
        is_open = F.col("a").isNull() | F.col("b").isNull()
        fresh, open_moves = moves.filter(~is_open), moves.filter(is_open)
        settled = fresh if settled is None else settled.unionByName(fresh)
        if open_moves.isEmpty():
            return settled.select("seq", "a", "b")
        known = cut_lineage(_follow(open_moves, _wires(fresh)))
        moves = cut_lineage(_follow(known, _wires(known)))


def _wires(moves: DataFrame) -> DataFrame:
    """What later key changes refer to: occupancy of both keys after a key change, or the port that it passes on."""
    a, b = F.col("a"), F.col("b")
    return moves.select(
        F.explode(
            F.array(
                F.struct(
                    (F.col("seq") * 2).alias("_id"),
                    (a & b).alias("_val"),
                    F.when(a, F.col("b_ref")).when(b, F.col("a_ref")).alias("_ref"),
                ),
                F.struct(
                    (F.col("seq") * 2 + 1).alias("_id"),
                    (a | b).alias("_val"),
                    F.when(~a, F.col("b_ref")).when(~b, F.col("a_ref")).alias("_ref"),
                ),
            )
        ).alias("w")
    ).select("w.*")


def _follow(moves: DataFrame, wires: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        val, ref = F.coalesce(F.col(side), F.col("_val")), F.col(f"{side}_ref")
        # rows without a reference would all meet under the null key; negative numbers are no ports
        moves = moves.join(wires, F.coalesce(ref, -1 - F.col("seq")) == F.col("_id"), "left").withColumns(
            {side: val, f"{side}_ref": F.when(val.isNull(), F.coalesce(F.col("_ref"), ref))}
        ).drop("_id", "_val", "_ref")
    return moves


def _roots(scanned: DataFrame, keys: list[str]) -> DataFrame:
    """Root of the row each effective key change moved: an insert (``r_seq``) or a snapshot key (``r_<key>``)."""
    prev = F.col("prev")
    pointers = scanned.filter(F.col("kind") == "X").select(
        "seq",
        F.when(prev["kind"] == "M", prev["seq"]).alias("next"),
        F.when(prev["kind"] == "I", prev["seq"]).alias("r_seq"),
        *[F.when(prev.isNull(), F.col(k)).alias(f"r_{k}") for k in keys],
    )
    root_cols = ["r_seq", *[f"r_{k}" for k in keys]]
    return _followed(pointers, "next", root_cols)
