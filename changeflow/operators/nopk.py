"""Tables without a primary key: inserts add rows, updates and deletes hit every row they match.

An update matches on the old values the message carries (NULL matches NULL); a delete needs all columns
and plain equality, so a NULL old value matches nothing. Equal rows are kept as one row with a count.

A batch is replayed in waves: every row looks up the first later change that matches it, takes the
change, and looks again. Only rows that were hit take part in the next wave. Rows ask by match key and by the place in the log where
they are. Only the distinct questions are looked up, in chunked scans, and rows fetch the answers by an equi-join that is salted by the row.
So neither rows with one match key, nor a row with many copies, nor a change that is repeated a lot lands in one task. The sets of
compared columns are data of that join, not joins of their own.

An update that compares all columns has the same outcome for every row it hits, so its own successor is
known. Chains of such updates are joined up beforehand by pointer jumping, in a logarithmic number of
rounds, and a row takes a whole chain in one wave.

What a batch changes is a multiset with signs (``nopk_delta``): copies it takes away and copies it adds. Put on top of the
counted table it gives the table after the batch, so a store appends it instead of writing the table anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.scan import carry_previous
from changeflow.model import TableSpec
from changeflow.operators.bind import CHUNK_OFFSETS, order_columns
from changeflow.operators.net import unchanged
from changeflow.session import cut_lineage

# Copies of one row written out by a single task.
COPIES_PER_BLOCK = 1024
# tasks that the rows of one match key are dealt to
SPREAD = 16


def collapse(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Equal rows -> one row with ``n``."""
    return rows.groupBy(*spec.column_names).agg(F.count(F.lit(1)).alias("n"))


def add_counts(counted: DataFrame, spec: TableSpec) -> DataFrame:
    """Signed counts of equal rows added up; rows without a copy left are gone. Combined map-side."""
    return counted.groupBy(*spec.column_names).agg(F.sum("n").alias("n")).filter(F.col("n") != 0)


def expand(collapsed: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with ``n`` -> ``n`` equal rows, in blocks that are dealt out between tasks, so that a large count stays spread out."""
    last_block = F.floor((F.col("n") - 1) / COPIES_PER_BLOCK)
    in_block = F.least(F.lit(COPIES_PER_BLOCK).cast("bigint"), F.col("n") - F.col("_b") * COPIES_PER_BLOCK)
    blocks = collapsed.filter(F.col("n") > 0).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    return (
        blocks.repartition(*spec.column_names, "_b")
        .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), in_block)))
        .select(*spec.column_names)
    )


def _match_key(spec: TableSpec, part: dict[str, Column]) -> Column:
    """Array with one text per column: '' not compared, 'n' NULL, 'v...' a value."""
    return F.array(
        *[
            F.coalesce(F.concat(F.lit("v"), part[n].cast("string")), F.lit("n")) if n in part else F.lit("")
            for n in spec.column_names
        ]
    )


def nopk_changes(events: DataFrame, spec: TableSpec, chunk_offsets: int = CHUNK_OFFSETS) -> DataFrame:
    """Typed updates and deletes: ``seq``, ``chunk``, ``op``, ``match`` (match key), ``v_<column>`` to set,
    ``full`` (compares all columns) and then the row ``a_<column>`` it leaves and the ``place`` (hash) of the row it hits."""
    good = events.filter(F.col("error").isNull() & F.col("op").isin("U", "K", "D"))

    def cellof(n: str) -> Column:
        return F.try_element_at("cols", F.lit(n))

    def old(n: str) -> Column:
        return cellof(n)["old"].try_cast(spec.column(n).dtype)

    def cur(n: str) -> Column:
        return cellof(n)["cur"].try_cast(spec.column(n).dtype)

    match = F.array(
        *[
            F.when(
                cellof(n)["has_old"], F.coalesce(F.concat(F.lit("v"), old(n).cast("string")), F.lit("n"))
            ).otherwise("")
            for n in spec.column_names
        ]
    )
    sets = [
        F.when(
            (F.col("op") != "D") & cellof(n)["has_cur"] & ~unchanged(cur(n), old(n)), F.struct(cur(n).alias("cur"))
        ).alias(f"v_{n}")
        for n in spec.column_names
    ]
    # the row after an update that compares all columns
    after = [
        F.when(cellof(n)["has_cur"], cur(n)).otherwise(old(n)).alias(f"a_{n}") for n in spec.column_names
    ]
    changes = good.select(
        *order_columns(good, chunk_offsets),
        F.when(F.col("op") == "D", "D").otherwise("U").alias("op"),
        match.alias("match"),
        F.forall(match, lambda m: m != "").alias("full"),
        F.xxhash64(*[old(n) for n in spec.column_names]).alias("place"),
        *sets,
        *after,
    )
    # '= NULL' and a missing column match nothing
    full = F.forall("match", lambda m: m.startswith("v"))
    compares = F.exists("match", lambda m: m != "")
    does = reduce(lambda a, b: a | b, [F.col(f"v_{n}").isNotNull() for n in spec.column_names])
    return changes.filter(F.when(F.col("op") == "D", full).otherwise(compares & does))


def apply_update_nopk(snapshot: DataFrame, change: DataFrame, spec: TableSpec) -> DataFrame:
    """One set of independent updates (no row matched by two): overlay by null-safe match."""
    return _apply_independent(snapshot, change.filter(F.col("op") == "U"), spec)


def apply_delete_nopk(snapshot: DataFrame, change: DataFrame, spec: TableSpec) -> DataFrame:
    """Deletes by value: plain equality on all columns, a NULL matches nothing."""
    deletes = change.filter(F.col("op") == "D").select(F.col("match").alias("_m")).distinct()
    keyed = snapshot.withColumn("_m", _match_key(spec, {n: F.col(n) for n in spec.column_names}))
    return keyed.join(deletes, "_m", "left_anti").select(*spec.column_names)


def _signatures(changes: DataFrame, spec: TableSpec) -> list[list[str]]:
    """Distinct sets of compared columns; their number depends on the table width, not on the data."""
    kinds = changes.select(F.transform("match", lambda m: m != "").alias("s")).distinct().collect()
    return [[n for n, used in zip(spec.column_names, r["s"]) if used] for r in kinds]


def _apply_independent(snapshot: DataFrame, updates: DataFrame, spec: TableSpec) -> DataFrame:
    rows = snapshot
    for sig in _signatures(updates, spec):
        key = _match_key(spec, {n: F.col(n) for n in sig})
        same = F.transform("match", lambda m: m != "") == F.array(*[F.lit(n in sig) for n in spec.column_names])
        part = updates.filter(same).select(F.col("match").alias("_m"), *[f"v_{n}" for n in spec.column_names])
        rows = (
            rows.withColumn("_m", key)
            .join(part, "_m", "left")
            .select(
                *[
                    F.when(F.col(f"v_{n}").isNotNull(), F.col(f"v_{n}")["cur"]).otherwise(F.col(n)).alias(n)
                    for n in spec.column_names
                ]
            )
        )
    return rows


def replay_nopk(
    snapshot: DataFrame, events: DataFrame, spec: TableSpec, chunk_offsets: int = CHUNK_OFFSETS
) -> DataFrame:
    """Apply a batch of events to a table without a primary key, in log order."""
    names = spec.column_names
    changes = cut_lineage(nopk_changes(events, spec, chunk_offsets))
    signatures = _signatures(changes, spec)
    inserts = _inserts(events, spec, chunk_offsets)
    if not signatures:
        return snapshot.select(*names).unionByName(inserts.select(*names))
    _, done = _replayed(collapse(snapshot, spec), changes, signatures, inserts, spec)
    return expand(done.select(*names, "n"), spec)


def nopk_delta(
    counted: DataFrame, events: DataFrame, spec: TableSpec, changes: DataFrame | None = None, chunk_offsets: int = CHUNK_OFFSETS
) -> DataFrame:
    """What a batch of events changes in a table without a primary key: rows with a signed number of copies ``n``.

    ``counted``: the rows of the table that the batch may hit, with their number of copies ``n`` (not read if the batch only inserts);
    ``changes``: the result of ``nopk_changes``, if it is there already. Rows that end as they began are left out.
    """
    names = spec.column_names
    if changes is None:
        changes = cut_lineage(nopk_changes(events, spec, chunk_offsets))
    signatures = _signatures(changes, spec)
    inserts = _inserts(events, spec, chunk_offsets)
    if not signatures:
        return add_counts(inserts.select(*names, "n"), spec)
    hit, done = _replayed(counted, changes, signatures, inserts, spec)
    taken = hit.select(*names, (-F.col("n")).alias("n"))
    return add_counts(taken.unionByName(done.filter(~_at_begin()).select(*names, "n")), spec)


def _at_begin() -> Column:
    """Rows of the table before the batch, as opposed to rows that the log made."""
    return F.col("seq.partition") < 0


def _inserts(events: DataFrame, spec: TableSpec, chunk_offsets: int) -> DataFrame:
    good = events.filter(F.col("error").isNull() & (F.col("op") == "I"))
    return good.select(
        *[F.try_element_at("cols", F.lit(c.name))["cur"].try_cast(c.dtype).alias(c.name) for c in spec.columns],
        *order_columns(good, chunk_offsets),
        F.lit(1).cast("bigint").alias("n"),
    )


def _replayed(
    counted: DataFrame, changes: DataFrame, signatures: list[list[str]], inserts: DataFrame, spec: TableSpec
) -> tuple[DataFrame, DataFrame]:
    """The rows of the table that the batch hits, as they were, and all rows as the batch leaves them (``seq``: what made them)."""
    names = spec.column_names
    begin = F.struct(
        F.lit("").alias("topic"), F.lit(-1).alias("partition"),
        F.lit(-1).cast("bigint").alias("offset"), F.lit(-1).alias("item"),
    )
    first_chunk = F.struct(
        F.lit("").alias("topic"), F.lit(-1).alias("partition"), F.lit(-1).cast("bigint").alias("block")
    )
    waiting = counted.select(*names, begin.alias("seq"), first_chunk.alias("chunk"), "n")
    hit, done = None, []

    chains = _chains(changes, signatures, spec)
    # inserts of one batch are distinct in seq, so they join the waves as they are
    active = cut_lineage(waiting.unionByName(inserts))
    while hit is None or active.limit(1).count() > 0:
        moved = cut_lineage(_wave(active, changes, signatures, spec))
        if hit is None:
            # rows of the table are hit for the first time in the first wave
            hit = moved.filter(F.col("hit").isNotNull() & _at_begin())
        done.append(moved.filter(F.col("hit").isNull()).select(*names, "seq", "n"))
        active = cut_lineage(_take(moved.filter(F.col("hit.op") == "U"), chains, spec))
    return hit, reduce(DataFrame.unionByName, done)


def _wave(active: DataFrame, changes: DataFrame, signatures: list[list[str]], spec: TableSpec) -> DataFrame:
    """Add ``hit``: the first change after the row's ``seq`` that matches the row."""
    names = spec.column_names
    keys = F.array(*[_match_key(spec, {n: F.col(n) for n in sig}) for sig in signatures])
    looking = active.select(
        *names, "n", "seq", "chunk",
        F.explode(F.array_distinct(keys)).alias("match"),
        F.pmod(F.xxhash64(*names), F.lit(SPREAD)).cast("int").alias("salt"),
    )
    asked = looking.select("match", "seq", "chunk").distinct().withColumn("pos", F.struct("seq", F.lit(1).alias("rank")))
    effect = F.struct("seq", "chunk", "op", "full", *[f"v_{n}" for n in names])
    candidates = changes.select(
        "match", "chunk", F.struct("seq", F.lit(0).alias("rank")).alias("pos"), effect.alias("effect")
    )
    both = asked.withColumn("effect", F.lit(None).cast(candidates.schema["effect"].dataType)).unionByName(
        candidates, allowMissingColumns=True
    )
    found = carry_previous(
        both, ["match"], F.col("effect"), F.col("effect").isNotNull(), "hit", seq="pos", forward=True
    )
    answers = found.filter(F.col("effect").isNull() & F.col("hit").isNotNull()).select("match", "seq", "hit")
    return (
        _fetch(looking, answers)
        .groupBy(*names, "seq", "chunk", "n")
        .agg(F.min_by("hit", "hit.seq").alias("hit"))
    )


def _fetch(looking: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows and the answer to each of their questions; rows of one match key are dealt to ``SPREAD`` tasks."""
    salted = answers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return looking.join(salted, ["match", "seq", "salt"], "left")


def _chains(changes: DataFrame, signatures: list[list[str]], spec: TableSpec) -> DataFrame:
    """For every full update (``_id``): ``seq``, ``chunk`` and row of the last full update it leads to."""
    names = spec.column_names
    full = changes.filter("full and op = 'U'").select(
        *[F.col(f"a_{n}").alias(n) for n in names], "seq", "chunk", F.lit(0).cast("bigint").alias("n")
    )
    followed = _wave(full, changes, signatures, spec)
    goes_on = F.col("hit.full") & (F.col("hit.op") == "U")
    links = cut_lineage(
        followed.select(*names, "seq", "chunk", F.when(goes_on, F.col("hit.seq")).alias("next"))
    )
    jumps = links.select(F.col("seq").alias("_id"), F.col("seq").alias("end"), "next")
    while jumps.filter(F.col("next").isNotNull()).limit(1).count() > 0:
        target = jumps.select(F.col("_id").alias("_t"), F.col("end").alias("_end"), F.col("next").alias("_next"))
        jumps = cut_lineage(
            jumps.join(target, F.col("next") == F.col("_t"), "left").select(
                "_id", F.coalesce("_end", "end").alias("end"), F.col("_next").alias("next")
            )
        )
    ends = links.select(F.col("seq").alias("end"), "chunk", *names)
    return cut_lineage(jumps.select("_id", "end").join(ends, "end").withColumnRenamed("end", "seq"))


def _take(moved: DataFrame, chains: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows after the change that hit them; rows made equal by the same change become one."""
    names = spec.column_names
    hit = F.col("hit")
    partly = (
        moved.filter(~hit["full"])
        .select(
            *[
                F.when(hit[f"v_{n}"].isNotNull(), hit[f"v_{n}"]["cur"]).otherwise(F.col(n)).alias(n) for n in names
            ],
            hit["seq"].alias("seq"),
            hit["chunk"].alias("chunk"),
            "n",
        )
        .groupBy(*names, "seq", "chunk")
        .agg(F.sum("n").alias("n"))
    )
    # all rows hit by a full update are equal afterwards: count them before following its chain
    fully = moved.filter(hit["full"]).groupBy(hit["seq"].alias("_id")).agg(F.sum("n").alias("n"))
    chained = fully.join(chains, "_id").groupBy(*names, "seq", "chunk").agg(F.sum("n").alias("n"))
    return partly.unionByName(chained.select(*partly.columns))
