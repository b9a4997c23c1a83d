"""Near duplicates by b-bit MinHash.

Equal word sequences are one node. A node's signature keeps the low bits of its minima, packed in a few integers; bands of full
minima give candidates. The share of equal b-bit values, counted with ``bit_count`` and corrected for chance collisions, estimates
the similarity; candidates that are clearly below the threshold are dropped there, the others are confirmed on full shingle sets.

Only links that join components are needed. Each band's bucket links its members to the one nearest to the bucket's consensus, so a
group of n copies costs n candidates per band; a large bucket has several such members, which are linked to its smallest node. What is
left are buckets whose members are in several components although no link may be missing. To be sure, their members get a
signature of more hash functions, and pairs across components are compared on it in pairs of blocks inside the tasks; the few
pairs that come close to the threshold are confirmed on full sets. Links found there only join components, so they are followed on the
components' roots.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import WordHashes, cut_lineage, mixed, raw_texts, shingles, words_of
from changeflow.llm.components import connected_components, joined_components

HASHES, BANDS, BITS = 128, 32, 4
PER_LONG = 64 // BITS
THRESHOLD_PERCENT = 75
# five standard deviations of the estimate at the threshold
MARGIN = 0.2
# hash functions of the finer signature, and its margin: 4.5 standard deviations
FINE_HASHES, FINE_MARGIN = 1024, 0.064
BLOCK = 2048
PER_TASK_HEAD = 512
# rows of a bucket that one task links to a pivot, and of these the rows that the pivot is chosen from
PIVOT_ROWS, PIVOT_SAMPLE = 65_536, 4_096
MULTIPLIERS = ((mixed(np.arange(1, FINE_HASHES + 1, dtype=np.uint64)) >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)[:, None]
BAND_MULTIPLIERS = mixed(np.arange(1000, 1000 + HASHES // BANDS, dtype=np.uint64)) | np.uint64(1)
LOW_BITS = 0x1111111111111111


def minima(sets: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """The smallest hash of a shingle set under each of the hash functions, in slices of bounded size."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    low, slice_ = np.full(hashes, 0xFFFFFFFF, dtype=np.uint32), (1 << 20) // hashes
    for i in range(0, len(x), slice_):
        np.minimum(low, (x[i : i + slice_] * MULTIPLIERS[:hashes]).min(axis=1), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """Low bits of the minima, ``PER_LONG`` in an integer."""
    bits = mixed(low.astype(np.uint64)) & np.uint64(2**BITS - 1)
    shifts = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(bits.reshape(-1, PER_LONG) << shifts, axis=1).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    mixed_rows = mixed(low.astype(np.uint64).reshape(BANDS, -1) + np.uint64(1)) * BAND_MULTIPLIERS
    return mixed(mixed_rows.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _sign(batches):
    import pyarrow as pa

    hashes = WordHashes()
    for batch in batches:
        nodes, counts, sigs, bands, offsets = [], [], [], [], [0]
        for raw in raw_texts(batch.column("text")):
            words = words_of(raw)
            sets = np.unique(shingles(hashes.of(words)))
            counts.append(len(sets))
            nodes.append(hashlib.md5(b" ".join(words)).digest() if words else None)
            if words:
                low = minima(sets)
                sigs.append(packed(low))
                bands.append(band_keys(low))
            offsets.append(len(sigs))
        at = np.array(offsets, dtype=np.int32)
        lists = [
            pa.ListArray.from_arrays(at * width, pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))
            for width, values in ((HASHES // PER_LONG, sigs), (BANDS, bands))
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.binary()), pa.array(counts, pa.int64()), *lists],
            names=["row", "doc_id", "text_hash", "node", "n_shingles", "sig", "bands"],
        )


SIGNED = "row long, doc_id long, text_hash long, node binary, n_shingles long, sig array<long>, bands array<long>"


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    return cut_lineage(rows.mapInArrow(_sign, SIGNED))


def similarity_estimate(a: Column, b: Column) -> Column:
    """Similarity from packed signatures, corrected for the chance that different minima share their low bits."""
    def differing(i):
        x = F.get(a, i).bitwiseXOR(F.get(b, i))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseAND(F.lit(LOW_BITS)))

    different = sum((differing(i) for i in range(1, HASHES // PER_LONG)), differing(0))
    chance = 2.0**-BITS
    return (1 - different / HASHES - chance) / (1 - chance)


def _routes(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Where each text goes: a member to its head's task, a head to each of the tasks its members are split over."""
    sizes = pairs.groupBy("head").agg(F.ceil(F.count(F.lit(1)) / PER_TASK_HEAD).cast("int").alias("parts"))
    members = pairs.join(sizes.hint("merge"), "head").select(
        "head", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "node"
    )
    heads = sizes.select(
        "head", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("head").alias("node")
    )
    return members.union(heads).join(nodes.select("node", "doc_id", "text_hash").hint("merge"), "node")


def _confirm(batches):
    """Rows of a head come first, then its members; only the head's set is kept."""
    import pyarrow as pa

    hashes, at, head = WordHashes(), None, None
    for batch in batches:
        a, b = [], []
        heads, parts, roles, nodes = (batch.column(c).to_pylist() for c in ("head", "part", "role", "node"))
        for i, raw in enumerate(raw_texts(batch.column("text"))):
            words = words_of(raw)
            if hashlib.md5(b" ".join(words)).digest() != nodes[i]:
                continue
            if roles[i] == 0 and at == (heads[i], parts[i]):
                continue
            sets = np.unique(shingles(hashes.of(words)))
            if roles[i] == 0:
                at, head = (heads[i], parts[i]), sets
                continue
            shared = len(np.intersect1d(head, sets, assume_unique=True))
            if 100 * shared >= THRESHOLD_PERCENT * (len(head) + len(sets) - shared):
                a.append(heads[i])
                b.append(nodes[i])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs ``(head, node)`` whose full shingle sets reach the threshold, as ``(a, b)``."""
    routed = with_texts(_routes(pairs, nodes), docs, id_col, text_col)
    return cut_lineage(
        routed.select("head", "part", "role", "node", "text")
        .repartition("head", "part")
        .sortWithinPartitions("head", "part", "role", "node")
        .mapInArrow(_confirm, "a binary, b binary")
        .distinct()
    )


def estimates(sigs: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Corrected similarity of packed signatures (rows) to one."""
    x = sigs ^ one
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    different = np.bitwise_count(x & np.uint64(LOW_BITS)).sum(axis=1)
    chance = 2.0**-BITS
    return (1 - different / (sigs.shape[1] * PER_LONG) - chance) / (1 - chance)


def _pair_batch(found):
    import pyarrow as pa

    found = list(dict.fromkeys(found))
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.binary())], names=["head", "node"])


def _runs(batches, key_columns, columns):
    """``(key, rows)`` pieces of sorted input; a key with many rows comes in several pieces of at least ``PIVOT_SAMPLE`` rows."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (*key_columns, *columns))):
            if row[: len(key_columns)] != key:
                if rows:
                    yield key, rows
                key, rows = row[: len(key_columns)], []
            elif len(rows) >= 2 * max(PIVOT_SAMPLE, BLOCK):
                yield key, rows
                rows = []
            rows.append(row[len(key_columns) :])
    if rows:
        yield key, rows


def _to_pivot(batches):
    """Links members of a bucket, or of a part of a large one, to the member that agrees with most of the others, and that one to the smallest."""
    near = THRESHOLD_PERCENT / 100 - MARGIN
    at, pivot = None, None
    shifts = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)
    for key, rows in _runs(batches, ("band", "part"), ("node", "head", "sig")):
        sigs = np.array([r[2] for r in rows], dtype=np.int64).view(np.uint64)
        if key != at:
            at, some = key, sigs[:PIVOT_SAMPLE]
            i = 0
            if len(some) > 2:
                values = ((some[:, :, None] >> shifts) & np.uint64(2**BITS - 1)).reshape(len(some), -1)
                common = np.array([np.bincount(column, minlength=2**BITS).argmax() for column in values.T.astype(np.int64)])
                i = int((values == common).sum(axis=1).argmax())
            pivot, first = (rows[i][0], sigs[i]), [(rows[i][1], rows[i][0])] if rows[i][0] != rows[i][1] else []
        close = estimates(sigs, pivot[1]) >= near
        yield _pair_batch(first + [(pivot[0], r[0]) for r, c in zip(rows, close) if c and r[0] != pivot[0]])


def _across(batches):
    """Pairs of different components in one pair of blocks whose fine signatures are close enough; the short one is their beginning."""

    def close(rows, band, lo, hi):
        fine = np.array([r[2] for r in rows], dtype=np.int64).view(np.uint64)
        short = np.ascontiguousarray(fine[:, : HASHES // PER_LONG])
        bands = np.array([r[3] for r in rows], dtype=np.int32)
        number = {c: i for i, c in enumerate(dict.fromkeys(r[1] for r in rows))}
        comp, block = np.array([number[r[1]] for r in rows]), np.array([r[4] for r in rows])
        here = np.int64(band).astype(np.int32)
        for i in np.flatnonzero(block == lo):
            others = np.flatnonzero((block == hi) & (comp != comp[i]))
            others = others[others > i] if lo == hi else others
            others = others[estimates(short[others], short[i]) >= THRESHOLD_PERCENT / 100 - MARGIN]
            others = others[estimates(fine[others], fine[i]) >= THRESHOLD_PERCENT / 100 - FINE_MARGIN]
            # a pair that shares several buckets comes from the first of them
            first = (bands[others] == bands[i]).argmax(axis=1)
            for j in others[bands[i][first] == here]:
                a, b = rows[i][0], rows[j][0]
                yield (a, b) if a < b else (b, a)

    # blocks are bounded, so all rows of a pair of blocks are one piece
    key, held = None, []
    for k, rows in _runs(batches, ("band", "lo", "hi"), ("node", "root", "fine", "places", "block")):
        if k != key:
            if held:
                yield _pair_batch(close(held, *key))
            key, held = k, []
        held += rows
    if held:
        yield _pair_batch(close(held, *key))


def _fine(batches):
    import pyarrow as pa

    hashes = WordHashes()
    for batch in batches:
        nodes, sigs = [], []
        for node, raw in zip(batch.column("node").to_pylist(), raw_texts(batch.column("text"))):
            words = words_of(raw)
            if hashlib.md5(b" ".join(words)).digest() == node:
                nodes.append(node)
                sigs.append(packed(minima(np.unique(shingles(hashes.of(words))), FINE_HASHES)).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sigs, pa.list_(pa.int64()))], names=["node", "fine"])


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``(band, node, root, n)`` of the buckets whose nodes are in several components; n: nodes of the bucket."""
    labelled = cut_lineage(members.join(labels.hint("merge"), "node", "left").select("band", "node", F.coalesce("root", "node").alias("root")))
    several = labelled.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("n"))
    return cut_lineage(labelled.join(several.filter("r0 != r1").select("band", "n").hint("merge"), "band"))


def pivot_pairs(rows: DataFrame, sigs: DataFrame) -> DataFrame:
    parts = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / PIVOT_ROWS)).cast("int"))
    return cut_lineage(
        parts.join(sigs.hint("merge"), "node")
        .select("band", "part", "node", "head", "sig")
        .repartition("band", "part")
        .sortWithinPartitions("band", "part", "node")
        .mapInArrow(_to_pivot, "head binary, node binary")
        .distinct()
    )


def leftover_pairs(rows: DataFrame, nodes: DataFrame, tested: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Untested pairs of different components that share a bucket and are close by their finer signatures."""
    places = rows.select("node").distinct().join(nodes.select("node", "doc_id", "text_hash").hint("merge"), "node")
    fine = with_texts(places, docs, id_col, text_col).select("node", "text").mapInArrow(_fine, "node binary, fine array<long>")
    fine = fine.dropDuplicates(["node"])
    # the low halves of the band keys tell in which buckets two nodes meet
    places = F.transform("bands", lambda b: F.shiftright(F.shiftleft(b, 32), 32).cast("int")).alias("places")
    fine = cut_lineage(fine.join(nodes.select("node", places).hint("merge"), "node"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    spread = rows.join(fine.hint("merge"), "node").withColumn("blocks", blocks)
    spread = spread.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "root", "fine", "places", "block")
    pairs = (
        spread.repartition("band", "lo", "hi")
        .sortWithinPartitions("band", "lo", "hi", "node")
        .mapInArrow(_across, "head binary, node binary")
        .distinct()
    )
    return cut_lineage(pairs.join(tested.hint("merge"), ["head", "node"], "left_anti"))


def with_texts(places: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``places`` (with ``doc_id, text_hash``) and the texts of the documents they name."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("t_id"), F.xxhash64(text).alias("t_hash"), text.alias("text"))
    return places.join(texts.hint("merge"), (F.col("text_hash") == F.col("t_hash")) & F.col("doc_id").eqNullSafe(F.col("t_id")))


def node_components(sign: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(node, root)`` of all nodes that are linked to another one."""
    pick = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    nodes = cut_lineage(
        sign.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min(pick).alias("pick"), F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands"))
        .select("node", F.col("pick.doc_id").alias("doc_id"), F.col("pick.text_hash").alias("text_hash"), "sig", "bands")
    )
    rows = nodes.select("node", F.explode("bands").alias("band"))
    heads = rows.groupBy("band").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = cut_lineage(rows.join(heads.hint("merge"), "band"))
    pairs = pivot_pairs(members, nodes.select("node", "sig"))
    labels = connected_components(confirmed(pairs, nodes, docs, id_col, text_col))
    rows = open_members(members.select("band", "node"), labels)
    if rows.isEmpty():
        return labels
    tested = pairs.select(F.least("head", "node").alias("head"), F.greatest("head", "node").alias("node"))
    rest = leftover_pairs(rows, nodes, tested, docs, id_col, text_col)
    if rest.isEmpty():
        return labels
    return joined_components(labels, confirmed(rest, nodes, docs, id_col, text_col))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept, text_hash``.

    Words are lower-cased (A-Z); a text of fewer than five words is one shingle, a null or empty text has none and is linked
    with nothing. ``component_id`` is the smallest id reachable over links of similarity 0.75 or more. One row of each component
    is kept: the smallest id, of rows that share it the first; null ids come last, and a component without ids has none.
    """
    sign = signed(docs, id_col, text_col)
    labels = node_components(sign, docs, id_col, text_col)
    rows = sign.select("row", "doc_id", "text_hash", "node", "n_shingles").join(labels.hint("merge"), "node", "left")
    lone = F.concat(F.lit("row "), F.col("row").cast("string")).cast("binary")
    rows = cut_lineage(rows.select("row", "doc_id", "text_hash", "n_shingles", F.coalesce("root", "node", lone).alias("root")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row")))
    groups = cut_lineage(rows.groupBy("root").agg(first.alias("first")))
    return rows.join(groups.hint("merge"), "root").select(
        "doc_id", "n_shingles", F.col("first.id").alias("component_id"), (F.col("row") == F.col("first.row")).alias("kept"), "text_hash"
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component left."""
    found = cut_lineage(near_duplicates(docs, id_col, text_col).select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"), "kept"))
    # a kept row may have copies with its id and text: of those rows any one stays
    twins = found.groupBy("k_id", "k_hash").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")).filter("kept")
    twins = cut_lineage(twins)
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    same = (text_hash == F.col("k_hash")) & F.col(id_col).cast("long").eqNullSafe(F.col("k_id"))
    single = docs.join(twins.filter("n = 1"), same, "left_semi")
    repeated = twins.filter("n > 1")
    if repeated.isEmpty():
        return single
    twin = docs.join(repeated, same, "left_semi").select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("i"), text_hash.alias("h"))
    return single.unionByName(twin.dropDuplicates(["i", "h"]).select("doc.*"))
