"""Benchmark decontamination by size-partitioned MinHash containment search.

The items are short, the documents may be long, so the similarity of whole sets says nothing. Items are partitioned by the size
of their shingle set into classes of powers of two; for the class of up to ``u`` shingles every document is cut into blocks of
``u`` shingles. Under one hash function the expected number of blocks that share their minimum with an item is the shared part
of the item over the sizes of block and item together, however the shared shingles lie in the document: at least 0.25 at the
threshold, so that 64 functions miss an item with a probability of about 1e-8. Blocks of a class are made of two
blocks of the class below, so each shingle is hashed once per function. Candidates are confirmed by exact containment of the item's word
shingles in the whole document.

Items come in blocks of bounded size, each sent once to the tasks that read the documents; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import SHINGLE_WORDS, WordHashes, mixed, shingles, words_of

HASHES = 64
THRESHOLD_PERCENT = 75
ITEMS_PER_BLOCK = 5_000
SLICE = 1 << 17
MULTIPLIERS = ((mixed(np.arange(500, 500 + HASHES, dtype=np.uint64)) >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)
HITS = "array<struct<item_id:long,shared:long,size:long>>"


def word_shingles(words: list[bytes], width: int = SHINGLE_WORDS) -> set[tuple]:
    return set(zip(*(words[i:] for i in range(width))))


class ItemBlock:
    """Minima of a block of items by size class, and the items' texts for the exact test."""

    def __init__(self, items: list[tuple[int, str]]):
        hashes, level = WordHashes(), []
        self.ids, self.texts, self.short, lows = [], [], {}, []
        for item_id, text in items:
            words = words_of((text or "").encode())
            if not words:
                continue
            if len(words) < SHINGLE_WORDS:
                # shorter than a shingle: found as one run of its words
                self.short.setdefault(len(words), {}).setdefault(tuple(words), []).append(item_id)
                continue
            sets = np.unique(shingles(hashes.of(words)))
            self.ids.append(item_id)
            self.texts.append(b" ".join(words))
            level.append(int(np.ceil(np.log2(len(sets)))))
            lows.append(((sets >> np.uint64(32)).astype(np.uint32)[None, :] * MULTIPLIERS[:, None]).min(axis=1))
        lows, level = np.array(lows, dtype=np.uint32).reshape(-1, HASHES), np.array(level, dtype=int)
        self.classes = {}
        for at in sorted(set(level.tolist())):
            members, tables = np.flatnonzero(level == at), []
            for h in range(HASHES):
                order = members[np.argsort(lows[members, h], kind="stable")]
                values = lows[order, h]
                likely = np.zeros(1 << 16, dtype=bool)
                likely[values & np.uint32(0xFFFF)] = True
                tables.append((values, order, likely))
            self.classes[at] = tables
        self.levels = sorted(self.classes)

    def candidates(self, sets: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        """``(document, item)`` pairs; ``sets``: shingle hashes of several documents, each filled up to whole smallest blocks."""
        x = (sets >> np.uint64(32)).astype(np.uint32)
        # owner of each block and the starts of pairs of blocks, for all levels
        low, top = self.levels[0], self.levels[-1]
        owner, owners, heads = np.repeat(np.arange(len(counts)), counts >> low), {}, {}
        for at in range(low, top + 1):
            owners[at] = owner
            sizes = np.bincount(owner, minlength=len(counts))
            place = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
            heads[at] = np.flatnonzero(place % 2 == 0)
            owner = owner[heads[at]]
        found = set()
        for h in range(HASHES):
            mins = x * MULTIPLIERS[h]
            for _ in range(low):
                mins = np.minimum(mins[::2], mins[1::2])
            for at in range(low, top + 1):
                if at in self.classes:
                    values, order, likely = self.classes[at][h]
                    for b in np.flatnonzero(likely[mins & np.uint32(0xFFFF)]):
                        k = np.searchsorted(values, mins[b])
                        while k < len(values) and values[k] == mins[b]:
                            found.add((int(owners[at][b]), int(order[k])))
                            k += 1
                if at < top:
                    mins = np.minimum.reduceat(mins, heads[at])
        return found

    def hits(self, words: list[bytes], items: list[int]) -> list[dict]:
        """Exact test of the candidate items of one document, and of all short ones."""
        found = []
        if items:
            mine = word_shingles(words)
            for i in items:
                theirs = word_shingles(self.texts[i].split())
                shared = len(theirs & mine)
                if 100 * shared >= THRESHOLD_PERCENT * len(theirs):
                    found.append((self.ids[i], shared, len(theirs)))
        for width, runs in self.short.items():
            for run in word_shingles(words, width) & runs.keys():
                found += [(item_id, 1, 1) for item_id in runs[run]]
        return [{"item_id": a, "shared": b, "size": c} for a, b, c in sorted(found, key=lambda x: (x[0] is None, x))]

    def search(self, texts) -> list[list[dict]]:
        hashes, out, pending = WordHashes(), [], []

        def flush():
            arrays = [(i, s) for i, _, s in pending if self.levels and len(s)]
            items: dict[int, list[int]] = {}
            if arrays:
                unit = 1 << self.levels[0]
                full = [np.concatenate([s, np.full(-len(s) % unit, s[-1])]) for _, s in arrays]
                for d, item in self.candidates(np.concatenate(full), np.array([len(s) for s in full])):
                    items.setdefault(arrays[d][0], []).append(item)
            for i, words, _ in pending:
                out.append(self.hits(words, items.get(i, [])))
            pending.clear()

        held = 0
        for i, text in enumerate(texts):
            words = words_of((text or "").encode())
            s = shingles(hashes.of(words)) if len(words) >= SHINGLE_WORDS and self.levels else np.zeros(0, np.uint64)
            pending.append((i, words, s))
            held += len(words)
            if held >= SLICE:
                flush()
                held = 0
        flush()
        return out


def _searcher(block):
    @F.pandas_udf(HITS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = block.value
        for texts in batches:
            yield pd.Series(own.search(texts))

    return search


def item_hits(benchmark: DataFrame, text: Column, item_col: str = "item_id", item_text: str = "text", per_block: int = ITEMS_PER_BLOCK) -> Column:
    """Column of the items contained in ``text``: array of ``(item_id, shared shingles, shingles of the item)``.

    The items pass through the driver in blocks of at most ``per_block``; each block is a broadcast of some 10 MB at most.
    """
    sc = benchmark.sparkSession.sparkContext
    items = iter(benchmark.select(F.col(item_col).cast("long"), item_text).distinct().toLocalIterator())
    found = None
    while block := [tuple(r) for r in islice(items, per_block)]:
        hits = _searcher(sc.broadcast(ItemBlock(block)))(text)
        found = hits if found is None else F.concat(found, hits)
    return F.array().cast(HITS) if found is None else found


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """One row per document: ``doc_id, hits``.

    An item is contained if the document holds at least 75 % of its distinct five-word shingles; an item of fewer words if the
    document holds them in a row; an empty or null item is contained in nothing. A null text is empty. Repeated rows and
    ids are kept as they are; a repeated item is listed once per id.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select("doc_id", item_hits(benchmark, F.col("text"), **names).alias("hits"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **names) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    return docs.filter(F.size(item_hits(benchmark, F.coalesce(F.col(text_col), F.lit("")), **names)) == 0)
