"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts and a score per cut.

Texts are cut into pieces and pieces into words. Four passes read the texts:

1. Words are counted per language. A phrase can only be frequent if all its words and word pairs are, so the frequent words become a
   bit filter of bounded size (false positives only cost work).
2. Every task summarises the 64-bit hashes of its word pairs per hash partition. A summary keeps ``capacity`` counters; where it
   holds more, the counter after the last one kept is subtracted from all, so no count is too small by more than what was
   subtracted. Summaries of a partition are merged in the same way, and the subtractions add up. The capacity exceeds the mass divided by the
   threshold, so the sum stays below the threshold and every frequent n-gram keeps a counter. The sums are returned with the
   summaries and compared with the threshold: if a partition is so uneven that its own mass breaks the bound, the pass is
   repeated with twice the capacity.
3. The same for the longer n-grams whose pairs all survived.
4. N-grams whose hash survived are counted by their words; counts below the threshold go.

What follows works on the frequent phrases only and is ordinary joins.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import cut_lineage, mixed, raw_texts

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
BREAK = b"."
# A-Z in lower case; what separates pieces becomes BREAK (itself such a character), tab a space
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
SCANNED = bytes(c + 32 if 65 <= c <= 90 else BREAK[0] if c in SEPARATORS else 32 if c == 9 else c for c in range(256))
SLICE_BYTES = 1 << 22
# words in one block, n-grams in a task's summary before it is sent, words remembered by a task
BLOCK_WORDS, SUMMARY_LIMIT, MEMORY_WORDS = 300_000, 1_000_000, 250_000
# phrases counted by a task before they are sent, and those whose counts one task adds up
COUNTED_LIMIT, PARTITION_PHRASES = 250_000, 100_000
# bits of a filter: 16 for each key, at most 128 MB
FILTER_MIN, FILTER_MAX = 1 << 20, 1 << 30
PARTITION_CAPACITY = 250_000
STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Numbers of words, exact within a task; ``hashes`` and ``text`` by number. 0 is the end of a piece."""

    def __init__(self):
        super().__init__()
        self.reset()

    def reset(self) -> None:
        self.clear()
        self[BREAK] = 0
        self.text, self.hashes = [BREAK], [0]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.text)
        self.text.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, 42))
        return n

    def numbers(self, raw: bytes) -> list[np.ndarray]:
        """Numbers of the words of one text, with an end of piece after the last; long texts are read in slices."""
        out, at = [], 0
        while at < len(raw):
            end = at + SLICE_BYTES
            if end < len(raw):
                scanned = raw[at:end].translate(SCANNED)
                cut = max(scanned.rfind(b" "), scanned.rfind(BREAK))
                while cut < 0 and end < len(raw):
                    end += SLICE_BYTES
                    scanned = raw[at:end].translate(SCANNED)
                    cut = max(scanned.rfind(b" "), scanned.rfind(BREAK))
                if end < len(raw):
                    scanned = scanned[: cut + 1]
            else:
                scanned = raw[at:].translate(SCANNED)
            at += len(scanned)
            found = scanned.replace(BREAK, b" . ").split()
            out.append(np.fromiter(map(self.__getitem__, found), dtype=np.int64, count=len(found)))
        out.append(np.zeros(1, dtype=np.int64))
        return out


def _blocks(batches, words: Words):
    """``(numbers, language of each, names of the languages)`` of many texts at a time."""
    numbers, langs, sizes, names, held = [], [], [], {}, 0
    for batch in batches:
        for lang, raw in zip(batch.column("lang").to_pylist(), raw_texts(batch.column("text"))):
            if not raw:
                continue
            if not held and len(words) > MEMORY_WORDS:
                words.reset()
            found = words.numbers(raw)
            numbers += found
            langs.append(names.setdefault(lang, len(names)))
            sizes.append(sum(map(len, found)))
            held += sizes[-1]
            if held >= BLOCK_WORDS:
                yield np.concatenate(numbers), np.repeat(langs, sizes), list(names)
                numbers, langs, sizes, names, held = [], [], [], {}, 0
    if held:
        yield np.concatenate(numbers), np.repeat(langs, sizes), list(names)


def _windows(block):
    """Slices of a block with the words that phrases begun in them may still need; ``starts`` phrases begin in a slice."""
    numbers, langs, names = block
    for at in range(0, len(numbers), BLOCK_WORDS):
        end = at + BLOCK_WORDS + LONGEST - 1
        yield numbers[at:end], langs[at:end], names, min(BLOCK_WORDS, len(numbers) - at)


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[(slots >> np.uint64(3)).astype(np.int64)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _count_words(batches):
    import pyarrow as pa

    words = Words()
    for numbers, langs, names in _blocks(batches, words):
        key, count = np.unique((numbers * len(names) + langs)[numbers > 0], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in key % len(names)], pa.string()),
                pa.array([words.text[i] for i in key // len(names)], pa.binary()),
                pa.array(count, pa.int64()),
            ],
            names=["lang", "word", "f"],
        )


def added(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counters added up, sorted by hash."""
    h, c = np.concatenate(hashes), np.concatenate(counts)
    if not len(h):
        return h, c
    order = np.argsort(h)
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(c, first)


def trimmed(hashes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A summary of at most ``capacity`` counters, and what was subtracted from every count."""
    if len(counts) <= capacity:
        return hashes, counts, 0
    lost = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    stays = counts > lost
    return hashes[stays], counts[stays] - lost, lost


def packed(values: np.ndarray) -> bytes:
    """Integers byte by byte, lowest bytes first: the higher ones are mostly zeros, which Spark's compression removes."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(8, -1).T).reshape(-1).view("<i8")


def _bits(filter_) -> np.ndarray:
    return np.frombuffer(filter_.value, dtype=np.uint8)


class Survivors:
    """Test of phrase hashes against a filter of their top bits."""

    def __init__(self, filter_):
        self.bits, self.shift = _bits(filter_[0]), np.uint64(filter_[1])

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        return in_filter(self.bits, hashes >> self.shift)


def _phrases(window, words: Words, frequent: np.ndarray, pairs: Survivors | None = None):
    """``(n, places, hashes)`` of the phrases of frequent words that begin in a window: the pairs, and with a filter of pairs the longer ones."""
    numbers, langs, names, starts = window
    of_lang = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in names], dtype=np.uint64)
    one = np.array(words.hashes, dtype=np.uint64)[numbers] ^ of_lang[langs]
    good = (numbers > 0) & in_filter(frequent, one)
    one = mixed(one)
    # a text ends with an end of piece, so a phrase is in one text and one language
    places = np.flatnonzero(good[:-1] & good[1:])
    hashes = mixed(one[places] * STEP + one[places + 1])
    if pairs is None:
        here = places < starts
        yield 2, places[here], hashes[here]
        return
    stays = pairs(hashes)
    places, hashes = places[stays], hashes[stays]
    chained = np.zeros(len(numbers), dtype=bool)
    chained[places] = True
    here = places < starts
    places, hashes = places[here], hashes[here]
    yield 2, places, hashes
    for n in range(3, LONGEST + 1):
        # the pair that ends the phrase
        stays = chained[places + (n - 2)]
        places = places[stays]
        hashes = mixed(hashes[stays] * STEP + one[places + (n - 1)])
        yield n, places, hashes


def _summarise(frequent, pairs, capacity: int, partition_bits: int, hash_bits: int):
    """Summaries of the pairs, or with a filter of pairs of the longer phrases.

    Sorted hashes are sent as differences. Their top ``hash_bits`` are enough: phrases that share them share a counter, which is then
    too large rather than too small.
    """

    def run(batches):
        import pyarrow as pa

        words, bits, chain = Words(), _bits(frequent), None if pairs is None else Survivors(pairs)
        hashes, counts, held = [], [], 0

        def send():
            h, c = added([x >> np.uint64(64 - hash_bits) for x in hashes], counts)
            part = (h >> np.uint64(hash_bits - partition_bits)).astype(np.int64)
            edges = np.searchsorted(part, np.arange((1 << partition_bits) + 1))
            rows = []
            for p in np.flatnonzero(np.diff(edges)):
                some = slice(edges[p], edges[p + 1])
                x, y, lost = trimmed(h[some], c[some], capacity)
                rows.append((int(p), packed(np.diff(x, prepend=np.uint64(0)).view(np.int64)), packed(y), lost))
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["p", "hashes", "counts", "lost"])

        for block in _blocks(batches, words):
            for window in _windows(block):
                found = [x for n, _, x in _phrases(window, words, bits, chain) if n > 2 or chain is None]
                h, c = np.unique(np.concatenate(found), return_counts=True)
                if len(h):
                    hashes.append(h)
                    counts.append(c.astype(np.int64))
                    held += len(h)
                if held > SUMMARY_LIMIT:
                    hashes, counts = ([x] for x in added(hashes, counts))
                    held = len(hashes[0])
                    if held > SUMMARY_LIMIT // 2:
                        yield send()
                        hashes, counts, held = [], [], 0
        if held:
            yield send()

    return run


SUMMARY = "p int, hashes binary, counts binary, lost long"


def _merge(capacity: int, min_count: int):
    """Summaries of the partitions that a task holds; counters that cannot reach ``min_count`` are left out."""

    def run(batches):
        import pyarrow as pa

        held: dict[int, list] = {}

        def shrink(s):
            s[0], s[1] = ([x] for x in added(s[0], s[1]))
            s[0][0], s[1][0], lost = trimmed(s[0][0], s[1][0], capacity)
            s[2], s[3] = s[2] + lost, len(s[0][0])

        for batch in batches:
            for p, h, c, lost in zip(*(batch.column(x).to_pylist() for x in ("p", "hashes", "counts", "lost"))):
                s = held.setdefault(p, [[], [], 0, 0])
                s[0].append(np.cumsum(unpacked(h)))
                s[1].append(unpacked(c))
                s[2], s[3] = s[2] + lost, s[3] + len(s[0][-1])
                if s[3] > 2 * capacity:
                    shrink(s)
        for p, s in held.items():
            shrink(s)
            most = s[1][0] + s[2]
            reached = most >= min_count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s[2]], pa.int64()), pa.array([int(most[reached].sum())], pa.int64()),
                    pa.array([s[0][0][reached]], pa.list_(pa.int64())),
                ],
                names=["lost", "mass", "survivors"],
            )

    return run


COUNTED = "p int, lang array<string>, phrase array<binary>, a array<long>"


def _count_phrases(frequent, pairs, longer, parts: int):
    """Counts of the surviving phrases, added up within a task; one row for each of the ``parts`` that they are dealt to."""

    def run(batches):
        import pyarrow as pa

        words, bits, chain, wanted = Words(), _bits(frequent), Survivors(pairs), Survivors(longer)
        # by language and numbers of the words, which are exact within a task until the words are forgotten
        counted: dict[tuple, int] = {}
        texts: list[bytes] = []

        def send():
            rows: dict[int, tuple[list, list, list]] = {}
            for (lang, *phrase), n in counted.items():
                text = b" ".join([texts[i] for i in phrase])
                row = rows.setdefault(xxhash.xxh64_intdigest(text) % parts, ([], [], []))
                row[0].append(lang)
                row[1].append(text)
                row[2].append(n)
            counted.clear()
            kinds = [pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.int64())]
            columns = [pa.array(x, t) for x, t in zip(zip(*rows.values()), kinds)]
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *columns], names=["p", "lang", "phrase", "a"])

        for block in _blocks(batches, words):
            if counted and (len(counted) > COUNTED_LIMIT or texts is not words.text):
                yield send()
            texts = words.text
            for window in _windows(block):
                numbers, langs, names, _ = window
                for n, places, hashes in _phrases(window, words, bits, chain):
                    if n > 2:
                        stays = wanted(hashes)
                        places, hashes = places[stays], hashes[stays]
                    if not len(places):
                        continue
                    _, first, group, c = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                    rows = np.column_stack([langs[places], numbers[places[:, None] + np.arange(n)]])
                    if (rows != rows[first[group]]).any():
                        # two phrases with one hash: count by the words themselves
                        _, first, c = np.unique(rows, axis=0, return_index=True, return_counts=True)
                    for (lang, *phrase), k in zip(rows[first].tolist(), c.tolist()):
                        key = (names[lang], *phrase)
                        counted[key] = counted.get(key, 0) + k
        if counted:
            yield send()

    return run


def _add_counts(min_count: int):
    def run(batches):
        import pyarrow as pa

        held: dict[tuple, int] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                lang, phrase, a = (batch.column(x)[i].as_py() for x in ("lang", "phrase", "a"))
                for key, n in zip(zip(lang, phrase), a):
                    held[key] = held.get(key, 0) + n
        rows = [(lang, phrase, phrase.count(b" ") + 1, n) for (lang, phrase), n in held.items() if n >= min_count]
        if rows:
            kinds = [pa.string(), pa.binary(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["lang", "phrase", "length", "a"])

    return run


def bit_filter(spark: SparkSession, keys: DataFrame, n_keys: int):
    """Broadcast bit filter of the long column ``key``; its size is bounded by ``FILTER_MAX`` bits, whatever the number of keys."""
    size = min(FILTER_MAX, max(FILTER_MIN, 1 << (16 * n_keys).bit_length()))
    # the built-in bit maps count from 1, in buckets of 32,768
    place = F.col("key").bitwiseAND(F.lit(size - 1)) + 1
    maps = keys.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    bits = bytearray(size // 8)
    for row in maps.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        at = (row.bucket - 1) * 4096
        bits[at : at + 4096] = row.bits
    return spark.sparkContext.broadcast(bytes(bits))


def _survivors(texts: DataFrame, frequent, pairs, mass: int, min_count: int):
    """Filter of the phrases that may be frequent, a bound of their occurrences and their number; about ``mass`` phrases are summarised."""
    counters = 2 * mass // min_count + 1
    partition_bits = max(4, (counters // PARTITION_CAPACITY).bit_length())
    capacity = (counters >> partition_bits) + 1
    # one phrase in 2^12 shares its counter with another
    hash_bits = min(63, max(32, mass.bit_length() + 12))
    while True:
        summaries = texts.mapInArrow(_summarise(frequent, pairs, capacity, partition_bits, hash_bits), SUMMARY)
        merged = summaries.repartition(1 << partition_bits, "p").mapInArrow(_merge(capacity, min_count), "lost long, mass long, survivors array<long>")
        merged = cut_lineage(merged)
        found = merged.agg(F.max("lost").alias("lost"), F.sum("mass").alias("mass"), F.sum(F.size("survivors")).alias("n")).first()
        # the proof: no count is too small by the threshold or more
        if (found.lost or 0) < min_count:
            bits = bit_filter(texts.sparkSession, merged.select(F.explode("survivors").alias("key")), found.n or 0)
            return (bits, 64 - hash_bits), found.mass or 0, found.n or 0
        capacity *= 2


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """``(words, phrases)``: ``(lang, word, f)`` of all words, ``(lang, phrase, length, a)`` of the phrases with ``a >= min_count``."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(_count_words, "lang string, word binary, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    words = cut_lineage(counted.select("lang", F.col("word").cast("string").alias("word"), "f"))
    often = words.filter(F.col("f") >= min_count)
    total = often.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("f"), F.lit(0)).alias("mass")).first()
    key = F.xxhash64("word").bitwiseXOR(F.xxhash64("lang")).alias("key")
    frequent = bit_filter(spark, often.select(key), total.n)

    # a pair begins at a frequent word, longer phrases at a surviving pair
    pairs, mass, n_pairs = _survivors(texts, frequent, None, total.mass, min_count)
    longer, _, n_longer = _survivors(texts, frequent, pairs, (LONGEST - 2) * mass, min_count)
    parts = max(16, (n_pairs + n_longer) // PARTITION_PHRASES)
    exact = texts.mapInArrow(_count_phrases(frequent, pairs, longer, parts), COUNTED).repartition(parts, "p")
    exact = exact.mapInArrow(_add_counts(min_count), "lang string, phrase binary, length int, a long")
    return words, cut_lineage(exact.select("lang", F.col("phrase").cast("string").alias("phrase"), "length", "a"))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int | None = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by score (all of them with ``top=None``).

    A null text is empty, a null language is ``und``, other columns and repeated rows' ids play no part: every row counts. A phrase
    of ``a`` occurrences is cut in two parts with ``l`` and ``r`` occurrences; the cut with the lowest ``floor(1000 a n / (l r))``
    counts, of equal ones the first; ``n`` is the number of words of the language. Phrases that occur only inside one longer
    frequent phrase are left out. Ties in the score go to the higher ``a``, then to the phrase in byte order. Without frequent phrases the result is empty.
    """
    words, phrases = frequent_phrases(docs, text_col, lang_col, min_count)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    parts = words.filter(F.col("f") >= min_count).select("lang", F.col("word").alias("part"), "f").union(phrases.select("lang", "phrase", "a"))
    split = F.split("phrase", " ")
    cut = phrases.select("lang", "phrase", "length", "a", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(split, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(split, F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("right"),
    )
    cut = cut.join(parts.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(parts.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(sizes, "lang")
    exact = F.expr("cast(1000 * cast(a as decimal(18,0)) as decimal(38,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    scored = cut.withColumn("score", exact).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # a longer phrase that holds it with as many occurrences: then there is one that is longer by one word
    inner = phrases.filter("length > 2").select(
        "lang", "a", F.explode(F.array(
            F.array_join(F.slice(split, F.lit(1), F.col("length") - 1), " "), F.array_join(F.slice(split, F.lit(2), F.col("length") - 1), " ")
        )).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(F.coalesce("longer", F.lit(0)) < F.col("a"))
    kept = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        # a language may hold most phrases: each share of them sends its best ones only
        salt = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        kept = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(salt)))
        kept = kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("place") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    ranked = ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return ranked if top is None else ranked.filter(F.col("rank") <= top)
