"""Shared by the operators: reading tables, words, word shingles, reliable cuts of the lineage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import cut_lineage, ensure_checkpoint_dir

__all__ = [
    "WORD", "WordHashes", "cut_lineage", "ensure_checkpoint_dir", "mixed", "pick_key", "raw_texts", "shared_folder", "shingles",
    "table", "words_of",
]

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    import uuid

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def pick_key(id_col: str, text_col: str) -> Column:
    """A key by which a row's text can be found again, for rows without an id too."""
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)))


def raw_texts(column) -> Iterator[bytes]:
    """UTF-8 bytes of an Arrow string column, null as empty, one value at a time."""
    import pyarrow as pa

    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for v in column:
        yield v.as_py() or b""


def words_of(raw: bytes) -> list[bytes]:
    """Words of a text with A-Z in lower case; ``bytes.split`` cuts at ASCII white space only."""
    return raw.translate(LOWER).split()


class WordHashes(dict):
    """Word -> 64-bit hash, emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) >= self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _multipliers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(hashes: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit hashes of the word shingles in order; a shorter text is one shingle of all its words, none has none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width, whole = (width, 0) if n >= width else (n, n)
    c = _multipliers(width)
    s = np.full(n - width + 1, whole, dtype=np.uint64)
    for i in range(width):
        s += mixed(hashes[i : n - width + 1 + i] + np.uint64(i)) * c[i]
    return mixed(s)
