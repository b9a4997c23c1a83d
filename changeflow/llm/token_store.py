"""Token ids as binary files: static range asymmetric numeral system (rANS).

Documents are range-partitioned and sorted by id. In each partition, consecutive documents form groups of about four million ids; a
group has one frequency table, shared by its blocks of 2^18 ids. A block is coded by itself: its ids are dealt to
interleaved lanes, one 32-bit state each, that share one stream of 16-bit words, so that a step of all lanes is one vector
operation. Every few steps a checkpoint records the lanes' states, the place in the stream, from which decoding can start, and the CRC-32 of the
ids up to the next checkpoint; so each piece of a block can be decoded, and verified, by itself. ``read_pieces`` does so with the blocks of a
group dealt out to tasks.

Spark writes the groups as rows of Parquet files, so lost tasks are written again and partial files never show.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import cut_lineage, raw_texts
from changeflow.llm.tokens import loaded

SCALE_BITS = 16
LANES = 2048
BLOCK_IDS = 1 << 18
GROUP_IDS = 1 << 22
CHECKPOINT_STEPS = 64
LOWEST = 1 << 16
MAGIC = b"rans2"
HEAD = struct.Struct("<5sIIII")


# -- frequency tables ----------------------------------------------------------------------------------
def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2^16, at least 1 for every id that occurs."""
    total, scale = int(counts.sum()), 1 << SCALE_BITS
    used = counts > 0
    freq = np.where(used, np.maximum(1, counts.astype(np.int64) * scale // max(total, 1)), 0)
    rest = scale - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if rest >= 0:
        freq[order[0]] += rest
        return freq
    # the ones rounded up take from the most frequent, which keep half at least
    for i in order:
        take = min(-rest, int(freq[i]) - max(1, int(freq[i]) // 2))
        freq[i] -= take
        rest += take
        if rest == 0:
            return freq
    return frequencies(used.astype(np.int64))


def pack_table(freq: np.ndarray) -> bytes:
    ids = np.flatnonzero(freq)
    return zlib.compress(ids.astype("<u2").tobytes() + (freq[ids] - 1).astype("<u2").tobytes())


def unpack_table(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), dtype="<u2")
    ids, freq = raw[: len(raw) // 2], raw[len(raw) // 2 :].astype(np.int64) + 1
    out = np.zeros(1 << SCALE_BITS, dtype=np.int64)
    out[ids] = freq
    return out


class Coder:
    """Encoder and decoder of blocks under one table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint32)
        self.start = (np.cumsum(freq) - freq).astype(np.uint32)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16), freq)

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
        n = len(ids)
        lanes = max(1, min(lanes, n // 64))
        steps = -(-n // lanes)
        state = np.full(lanes, LOWEST, dtype=np.uint32)
        words, marks = [], []
        f_all, c_all = self.freq[ids], self.start[ids]
        for s in range(steps - 1, -1, -1):
            f, c = f_all[s * lanes : (s + 1) * lanes], c_all[s * lanes : (s + 1) * lanes]
            x = state[: len(f)]
            full = (x >> np.uint32(16)) >= f
            words.append(x[full].astype("<u2"))
            x = np.where(full, x >> np.uint32(16), x)
            q = x // f
            state[: len(f)] = (q << np.uint32(SCALE_BITS)) + (x - q * f) + c
            if s % every == 0:
                marks.append(state.copy())
        words.reverse()
        before = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        marks.reverse()
        places = np.array([before[j * every] for j in range(len(marks))], dtype="<u4")
        stream = b"".join(w.tobytes() for w in words)
        raw, span = memoryview(ids.astype("<u4").tobytes()), 4 * every * lanes
        crcs = np.array([zlib.crc32(raw[i : i + span]) for i in range(0, len(raw), span)], dtype="<u4")
        head = HEAD.pack(MAGIC, n, lanes, every, len(marks))
        return head + places.tobytes() + crcs.tobytes() + b"".join(m.astype("<u4").tobytes() for m in marks) + stream

    def pieces(self, data: bytes):
        """``(start, ids)`` of each piece of a block, from checkpoint to checkpoint."""
        _, n, lanes, every, marks = HEAD.unpack_from(data)
        for c in range(marks):
            yield c * every * lanes, self.decode(data, c, c + 1)

    def decode(self, data: bytes, checkpoint: int = 0, until: int | None = None) -> np.ndarray:
        """The block's ids from one checkpoint to another, or to the end.

        Verified whatever is read: each piece between two checkpoints by its checksum, the whole by the lanes' states and the place in
        the stream at its end.
        """
        magic, n, lanes, every, marks = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        if n == 0:
            return np.zeros(0, np.uint16)
        until = marks if until is None else until
        if not 0 <= checkpoint < until <= marks:
            raise ValueError(f"a block with {marks} checkpoints has no ids from {checkpoint} to {until}")
        places = np.frombuffer(data, "<u4", marks, HEAD.size)
        crcs = np.frombuffer(data, "<u4", marks, HEAD.size + 4 * marks)
        at = HEAD.size + 8 * marks
        states = np.frombuffer(data, "<u4", marks * lanes, at).reshape(marks, lanes)
        stream = np.frombuffer(data, "<u2", offset=at + 4 * marks * lanes).astype(np.uint32)
        state, p = states[checkpoint].astype(np.uint32), int(places[checkpoint])
        first, span = checkpoint * every, every * lanes
        steps = min(until * every, -(-n // lanes))
        out = np.empty(min(steps * lanes, n) - first * lanes, dtype=np.uint16)
        low = np.uint32(0xFFFF)
        for s in range(first, steps):
            width = min(lanes, n - s * lanes)
            x = state[:width]
            slot = x & low
            sym = self.symbol[slot]
            out[(s - first) * lanes : (s - first) * lanes + width] = sym
            x = self.freq[sym] * (x >> np.uint32(16)) + slot - self.start[sym]
            short = np.flatnonzero(x < np.uint32(LOWEST))
            x[short] = (x[short] << np.uint32(16)) | stream[p : p + len(short)]
            p += len(short)
            state[:width] = x
        ends = (states[until], int(places[until])) if until < marks else (LOWEST, len(stream))
        if (state != ends[0]).any() or p != ends[1]:
            raise ValueError("a block of token ids is damaged")
        raw = memoryview(out.astype("<u4").tobytes())
        for c in range(checkpoint, until):
            i = 4 * span * (c - checkpoint)
            if zlib.crc32(raw[i : i + 4 * span]) != crcs[c]:
                raise ValueError("the checksum of a block of token ids differs")
        return out


# -- writing and reading -------------------------------------------------------------------------------
GROUPS = "part int, group long, n_ids long, block_ids long, freq binary, doc_ids array<long>, lengths array<long>, blocks array<binary>"


def _encoder(tokenizer: str, end_id: int):
    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        ids_of, part = loaded(tokenizer), TaskContext.get().partitionId()
        end, group = struct.pack("<H", end_id), 0
        docs, lengths, pieces, held = [], [], [], 0

        def written():
            nonlocal group, held
            ids = np.frombuffer(b"".join(pieces), dtype="<u2")
            freq = frequencies(np.bincount(ids, minlength=1 << SCALE_BITS))
            coder = Coder(freq)
            blocks = [coder.encode(ids[i : i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)]
            row = {"part": part, "group": group, "n_ids": len(ids), "block_ids": BLOCK_IDS, "freq": pack_table(freq), "doc_ids": list(docs), "lengths": list(lengths), "blocks": blocks}
            docs.clear(), lengths.clear(), pieces.clear()
            group, held = group + 1, 0
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("part", pa.int32()), ("group", pa.int64()), ("n_ids", pa.int64()), ("block_ids", pa.int64()), ("freq", pa.binary()),
                ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("blocks", pa.list_(pa.binary())),
            ]))

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch.column("text"))):
                ids = ids_of.encode(raw) + end
                docs.append(doc)
                lengths.append(len(ids) // 2)
                pieces.append(ids)
                held += len(ids) // 2
                if held >= GROUP_IDS:
                    yield written()
        if docs:
            yield written()

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> None:
    """Encode all texts and write them in ascending order of id.

    A null text is empty and has the end id only; null ids come first. Repeated rows are written as often as they occur;
    rows that share an id are ordered by text.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the hash lets a repeated id be split over partitions
    placed = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    placed.select("doc_id", "text").mapInArrow(_encoder(tokenizer, end_id), GROUPS).write.option("compression", "none").parquet(path)


def _decode(batches):
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            coder = Coder(unpack_table(row["freq"]))
            ids = np.concatenate([coder.decode(b) for b in row["blocks"]]).astype("<u4").tobytes()
            ends = 4 * np.cumsum(row["lengths"])
            starts = ends - 4 * np.array(row["lengths"])
            crcs = [zlib.crc32(memoryview(ids)[a:b]) for a, b in zip(starts, ends)]
            n = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array((starts // 4 + row["first"]).astype(np.int64)), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            ) if n else pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """The written groups with ``first``, the number of ids before the group in the whole data set.

    Partitions are summed first, groups inside their partition then, so the only window over everything has one row per
    partition.
    """
    groups = spark.read.schema(GROUPS).parquet(path)
    sizes = groups.select("part", "group", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_first"))
    inside = Window.partitionBy("part").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("part", "group", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("group_first"))
    firsts = cut_lineage(firsts.join(parts, "part").select("part", "group", (F.col("part_first") + F.col("group_first")).alias("first")))
    return groups.join(F.broadcast(firsts) if firsts.count() < 100_000 else firsts, ["part", "group"])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per written document, from the decoded files: ``doc_id, start, n_tokens, ids_crc32``."""
    return read_groups(spark, path).mapInArrow(_decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _ids(batches):
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            coder = Coder(unpack_table(row["freq"]))
            ids = np.concatenate([coder.decode(b) for b in row["blocks"]]).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids))], names=["doc_id", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids`` of every written document."""
    return spark.read.schema(GROUPS).parquet(path).mapInArrow(_ids, "doc_id long, ids array<int>")


PIECES = "part int, group long, block int, first long, ids array<int>"


def _decode_pieces(batches):
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            coder = Coder(unpack_table(row["freq"]))
            for at, ids in coder.pieces(row["data"]):
                yield pa.RecordBatch.from_pylist(
                    [{"part": row["part"], "group": row["group"], "block": row["block"], "first": row["first"] + at, "ids": ids.astype(np.int32)}],
                    schema=pa.schema([("part", pa.int32()), ("group", pa.int64()), ("block", pa.int32()), ("first", pa.int64()), ("ids", pa.list_(pa.int32()))]),
                )


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """All ids in pieces of bounded size, decoded in parallel: ``first`` is the place of a piece's first id in the whole data set.

    The blocks of a group are dealt out, each with the group's table, so a task holds one block and not a group; each piece is
    verified by its own checksum. An empty data set has no pieces; documents without text are in them with their end id.
    """
    blocks = read_groups(spark, path).select("part", "group", "first", "block_ids", "freq", F.posexplode("blocks").alias("block", "data"))
    placed = blocks.select("part", "group", "block", (F.col("first") + F.col("block") * F.col("block_ids")).alias("first"), "freq", "data")
    return placed.repartition("part", "group", "block").mapInArrow(_decode_pieces, PIECES)
