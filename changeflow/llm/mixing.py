"""Mixing sources to target weights as a time-varying curriculum.

Each source has a target of words and a weight schedule over training time. A source's documents are laid out one after
the other in a fixed pseudo-random order, twice or more if the target exceeds the source. The schedule is integrated to the share
of the target that is due by a time, and inverted: the words' place in the layout gives the time at which they are trained
on. Documents are range-sorted by that position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import WORD, cut_lineage

WEIGHTS = (3, 1, 2)
# (time, weight) knots in [0, 1], joined by lines; one schedule for each source in turn
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (0.5, 2.0), (1.0, 1.0)))
ROWS_PER_BUCKET = 20_000


def _number(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def inverse_sql(schedule: Sequence[tuple[float, float]], share: str) -> str:
    """SQL of the time by which a share of the schedule's integral is reached; plain arithmetic that any engine computes alike."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:])]
    total, before, cases = sum(areas), 0.0, []
    for ((t0, w0), (t1, w1)), area in zip(zip(schedule, schedule[1:]), areas):
        rest = f"({share} * {_number(total)} - {_number(before)})"
        slope = (w1 - w0) / (t1 - t0)
        root = f"({_number(w0)} + sqrt(greatest({_number(0.0)}, {_number(w0 * w0)} + {_number(2 * slope)} * {rest})))"
        cases.append((before + area, f"({_number(t0)} + {_number(2.0)} * {rest} / {root})"))
        before += area
    sql = cases[-1][1]
    for until, value in reversed(cases[:-1]):
        sql = f"CASE WHEN {share} * {_number(total)} <= {_number(until)} THEN {value} ELSE {sql} END"
    return sql


def words_sql(p: int) -> str:
    """Words of a document that a pass over its source takes: ``due`` words of the source are taken in all."""
    return f"greatest(0, least(size, due - (start + {p} * source_size)))"


def share_sql(p: int) -> str:
    """Where the middle of a document's words of a pass lies in its source's target."""
    return f"((start + {p} * source_size + {_number(0.5)} * {words_sql(p)}) / target)"


def position_sql(schedules, share: str, turn: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {inverse_sql(s, share)}" for i, s in enumerate(schedules))
    return f"CASE {turn} {whens} END"


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Target words of every source; ``sizes``: one row per source with ``none, source, source_size``.

    Targets are ``min(cap * size, rate * weight)`` with one rate for all, so that they share ``share`` of all words: the
    excess over a cap goes to the others by weight until none is above. Sources sorted by size over weight are capped up to
    the first one that its share does not exceed. The windows run over one row per source.
    """
    by_name = Window.orderBy("none", "source")
    ranked = sizes.withColumn("turn", (F.row_number().over(by_name) - 1)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    )
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "turn")
    everything = Window.partitionBy()
    tried = (
        ranked.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("capped", F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("free", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("rate", (F.lit(share) * F.col("all_size") - F.lit(cap) * F.col("capped")) / F.col("free"))
        .withColumn("fits", F.col("rate") * F.col("weight") <= F.lit(cap) * F.col("source_size"))
        # the first that fits has the largest number of sources at or above it
        .withColumn("rate", F.max_by(F.when(F.col("fits"), F.col("rate")), F.when(F.col("fits"), F.col("free"))).over(everything))
    )
    capped = F.lit(cap) * F.col("source_size")
    # no source fits only if every one is at its cap
    return tried.select("none", "source", "turn", "source_size", F.least(capped, F.coalesce(F.col("rate") * F.col("weight"), capped)).alias("target"))


def mix_plan(
    docs: DataFrame,
    share: float = 1.5,
    cap: float = 2.0,
    weights: Sequence[int] = WEIGHTS,
    schedules=SCHEDULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, copies`` and ``document``, a struct of the ``carry`` columns.

    ``copies``: array of ``(pass, words, position)``, one for each pass over the source that reaches the document; ``words`` is
    less than ``size`` only where the source's target ends inside the document. Null and empty texts have size 0 and no copy;
    a null source is a source of its own. Documents of equal id are ordered by text, so a rerun gives the same plan.
    """
    # a source's layout is summed in buckets of its order, so that no task sorts a whole source
    digits, n = 0, docs.count()
    while 16**digits * ROWS_PER_BUCKET < n:
        digits += 1
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    place = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    source = [F.col(source_col).isNull().alias("none"), F.coalesce(F.col(source_col), F.lit("")).alias("source")]
    bucket = F.substring(place, 1, digits) if digits else F.lit("")
    key = ["none", "source", "bucket"]
    rows = docs.select(
        F.col(id_col).alias("doc_id"), *source, size.alias("size"), place.alias("place"), bucket.alias("bucket"),
        F.xxhash64(text_col).alias("tie"), *([F.struct(*carry).alias("document")] if carry else []),
    )
    sums = cut_lineage(docs.select(*source, bucket.alias("bucket"), size.alias("size")).groupBy(*key).agg(F.sum("size").alias("words")))
    sources = cut_lineage(targets(sums.groupBy("none", "source").agg(F.sum("words").alias("source_size")), share, cap, weights))
    before = Window.partitionBy("none", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*key, F.coalesce(F.sum("words").over(before), F.lit(0)).alias("bucket_start"))
    starts = cut_lineage(starts.join(sources, ["none", "source"]))
    inside = Window.partitionBy(*key).orderBy("place", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, key)
        .withColumn("start", F.col("inside") + F.col("bucket_start"))
        .withColumn("due", F.floor("target"))
    )
    passes = range(int(cap) + (cap > int(cap)))

    def copy(p):
        words = F.expr(words_sql(p)).cast("long")
        at = F.expr(position_sql(schedules, share_sql(p), f"turn % {len(schedules)}"))
        return F.when(words > 0, F.struct(F.lit(p).alias("pass"), words.alias("words"), at.alias("position")))

    copies = F.filter(F.array(*[copy(p) for p in passes]), lambda c: c.isNotNull())
    return placed.select("doc_id", "size", "source_size", "target", copies.alias("copies"), *(["document"] if carry else []))


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus in training order: one row per copy, with the columns of ``docs``.

    Documents stay whole: a copy that its source's target cuts is taken if at least half of its words are due.
    """
    plan = mix_plan(docs, carry=docs.columns, **options)
    due = F.filter("copies", lambda c: 2 * c["words"] >= F.col("size"))
    return plan.select(F.explode(due).alias("c"), "doc_id", "document").orderBy("c.position", "doc_id", "c.pass").select("document.*")
