"""Byte-level BPE ids of texts by a rank file, and back.

A text is split by a pattern into pre-tokens. Two tiers give their ids:

* a minimal perfect hash over the vocabulary: a pre-token's 64-bit hash leads to one slot, the slot's own token is compared with it; if
  they are equal, the slot's id is the answer. This is done for whole blocks of pre-tokens at once.
* otherwise the bytes of the pre-token are a linked list, a heap holds the adjacent pairs that are tokens by rank and place, and the
  lowest one is merged until none is left. Outcomes are remembered, those not seen for long are forgotten first.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import mixed, raw_texts

# pre-tokens in one block, characters of a long text that are split at a time
BLOCK_TOKENS, SLICE_CHARS = 200_000, 1 << 20
# longer pre-tokens are not remembered
REMEMBERED_CHARS = 64
BUCKET_KEYS, TRIALS = 2, 32


class MinimalPerfectHash:
    """n keys, given by distinct 64-bit hashes, to n slots: hash, and displace by a value of the hash's bucket.

    Buckets are placed from the largest to the smallest; a bucket of one key names its slot directly, which fills the last gaps.
    """

    def __init__(self, hashes: np.ndarray):
        self.n = n = len(hashes)
        self.buckets = max(1, n // BUCKET_KEYS)
        if len(np.unique(hashes)) != n:
            raise ValueError("two keys have the same 64-bit hash")
        self.displace = np.zeros(self.buckets, dtype=np.int64)
        bucket = self._bucket(hashes)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        taken, by_size = np.zeros(n, dtype=bool), np.argsort(-sizes, kind="stable")
        for b in by_size[: int((sizes > 1).sum())].tolist():
            keys, d = hashes[order[ends[b] - sizes[b] : ends[b]]][:, None], 1
            while True:
                slots = self._slot(keys, np.arange(d, d + TRIALS))
                for i in np.flatnonzero(~taken[slots].any(axis=0)).tolist():
                    if len(set(slots[:, i].tolist())) == len(slots):
                        break
                else:
                    d += TRIALS
                    continue
                break
            taken[slots[:, i]] = True
            self.displace[b] = d + i
        alone = np.flatnonzero(sizes == 1)
        self.displace[alone] = -1 - np.flatnonzero(~taken)

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def _slot(self, hashes: np.ndarray, d) -> np.ndarray:
        return (mixed(hashes + np.asarray(d).astype(np.uint64)) % np.uint64(self.n)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        d = self.displace[self._bucket(hashes)]
        return np.where(d < 0, -1 - d, self._slot(hashes, d))


class Remembered(dict):
    """Outcomes of ``compute`` in two generations of ``limit`` entries: a full one becomes the old one, and the one before it is forgotten."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        if len(key) <= REMEMBERED_CHARS:
            self[key] = value
        return value


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class ByteBpe:
    """Encoder and decoder of one rank file. ``pattern`` splits texts, in the syntax of the ``regex`` module."""

    def __init__(self, path: str, pattern: str, remember: int = 250_000):
        import regex

        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{path} has no token for the bytes {missing}")
        # a pre-token is text, so only tokens that are text can be whole pre-tokens
        words = []
        for token, rank in self.ranks.items():
            try:
                words.append((token.decode(), rank))
            except UnicodeDecodeError:
                pass
        hashes = self._hashes([w for w, _ in words])
        self.table = MinimalPerfectHash(hashes)
        at = self.table.slots(hashes)
        self.word_at, self.id_at = [""] * len(words), np.zeros(len(words), dtype="<u4")
        for slot, (word, rank) in zip(at.tolist(), words):
            self.word_at[slot], self.id_at[slot] = word, rank
        self.remembered = Remembered(self.missed, remember)

    @staticmethod
    def _hashes(tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))

    def merged(self, token: bytes) -> list[int]:
        """Ids of one pre-token that is no token itself."""
        rank_of, n = self.ranks.get, len(token)
        bits = n.bit_length()
        place = (1 << bits) - 1
        # part i is token[i : after[i]]; pair[i] is the heap's entry (rank and place) for part i and the one after it, -1 if there is none
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [-1 if (rank := rank_of(token[i : i + 2])) is None else rank << bits | i for i in range(n - 1)]
        pair.append(-1)
        heap = [x for x in pair if x >= 0]
        heapify(heap)
        while heap:
            x = heappop(heap)
            i = x & place
            # the pair may be gone: either part may have been merged meanwhile
            if pair[i] != x:
                continue
            j = after[i]
            end = after[i] = after[j]
            pair[i] = pair[j] = -1
            before[end] = i
            if end < n and (rank := rank_of(token[i : after[end]])) is not None:
                pair[i] = x = rank << bits | i
                heappush(heap, x)
            if i:
                h = before[i]
                if (rank := rank_of(token[h:end])) is None:
                    pair[h] = -1
                else:
                    pair[h] = x = rank << bits | h
                    heappush(heap, x)
        out, i = [], 0
        while i < n:
            out.append(rank_of(token[i : after[i]]))
            i = after[i]
        return out

    def missed(self, token: str) -> bytes:
        ids = self.merged(token.encode())
        return pack(f"<{len(ids)}I", *ids)

    def block(self, tokens: list[str], ends: list[int]) -> list[bytes]:
        """Ids of a block of pre-tokens, cut at ``ends`` (numbers of pre-tokens)."""
        ids = dict.fromkeys(tokens)
        if ids:
            distinct = list(ids)
            slots = self.table.slots(self._hashes(distinct))
            hit = map(str.__eq__, map(self.word_at.__getitem__, slots.tolist()), distinct)
            whole, again = self.id_at[slots].tobytes(), self.remembered
            for i, (token, found) in enumerate(zip(distinct, hit)):
                ids[token] = whole[4 * i : 4 * i + 4] if found else again[token]
        of = ids.__getitem__
        return [b"".join(map(of, tokens[a:b])) for a, b in zip([0, *ends], ends)]

    def encode_all(self, texts) -> list[bytes]:
        """Little-endian 32-bit ids of each text. Short texts share blocks, a long one takes several."""
        out, tokens, ends = [], [], []

        def flush():
            out.extend(self.block(tokens, ends))
            tokens.clear()
            ends.clear()

        for text in texts:
            if len(text) <= SLICE_CHARS:
                tokens.extend(self.pattern.findall(text))
                ends.append(len(tokens))
                if len(tokens) >= BLOCK_TOKENS:
                    flush()
                continue
            flush()
            parts, some = [], []
            for m in self.pattern.finditer(text):
                some.append(m.group())
                if len(some) >= BLOCK_TOKENS:
                    parts += self.block(some, [len(some)])
                    some = []
            out.append(b"".join(parts + self.block(some, [len(some)])))
        flush()
        return out

    def decoder(self):
        """Function from ids to bytes."""
        token = [b""] * (max(self.ranks.values()) + 1)
        for t, i in self.ranks.items():
            token[i] = t
        return lambda ids: b"".join(map(token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pattern: str) -> ByteBpe:
    """One encoder for each file, pattern and Python worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row; ``ids`` are little-endian unsigned 32-bit integers, none for a null or empty text.

    Special tokens of the vocabulary do not exist here: their strings are ordinary text. Bytes that are no UTF-8 are encoded as U+FFFD.
    Rows without an id, repeated rows and very long texts are encoded like others; further columns are not read. ``path`` must be
    readable on the executors.
    """
    def run(batches):
        import pyarrow as pa

        bpe = loaded(path, pattern)
        for batch in batches:
            ids = bpe.encode_all(raw.decode("utf-8", "replace") for raw in raw_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decoded(tokens: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with a column ``decoded``: the bytes of the ids; null ids give null, an id the file does not have fails the job."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in tokens.schema if f.name != 'decoded')}, decoded binary"

    def run(batches):
        import pyarrow as pa

        back = loaded(path, pattern).decoder()
        for batch in batches:
            out = [None if ids is None else back(ids) for ids in batch.column(ids_col).to_pylist()]
            kept = [i for i, name in enumerate(batch.schema.names) if name != "decoded"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(out, pa.binary())], names=[*(batch.schema.names[i] for i in kept), "decoded"]
            )

    return tokens.mapInArrow(run, schema)
