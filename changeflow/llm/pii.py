"""Personal data: fixed patterns, and bootstrapped contextual extraction for identifiers that no pattern describes.

The entities found by the fixed patterns are seeds. The one or two words before the word that holds a seed are a lexical pattern. Patterns with
enough different seeds are scored on the graph of patterns and instances: a pattern's confidence is the summed score of the instances in its
slot over all its occurrences in the corpus, an instance's score combines the confidences of its patterns; both are
repeated a few times, seeds staying at 1. Words of five characters and more in the slot of a confident pattern are reported as
``context`` if they hold a digit. Those of letters only are no evidence for a pattern, as ordinary words would raise it; they are
reported if the confident patterns around the same word in the whole corpus together give it a score of ``MIN_LETTERS``.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import LOWER, WordHashes, cut_lineage, mixed, raw_texts

KINDS = ("email", "ip", "card", "phone", "context")
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.5
MIN_LETTERS = 0.9
ROUNDS = 3
# what is sent to every task about the patterns: one bit for each value of their hash modulo this
BITMAP = 1 << 20

# fixed values of the base patterns, written so that each run is tried once
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
DIGIT = re.compile(rb"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the local part is the whole run before an ``@``, as far as the match before leaves it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            free = m.end()
            found.append((start, free))
        else:
            # a run that failed cannot be part of a later match, which starts after this @
            free = at + 1
        at = text.find("@", max(free, at + 1))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of all entities of the fixed patterns, in order."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def contexts(before: np.ndarray) -> list[int]:
    """Hashes of the patterns of one slot; ``before``: hashes of the words before it."""
    out = [int(mixed(before[-1:])[0])] if len(before) else []
    if len(before) > 1:
        out.append(int(_pairs(before[-2:])[0]))
    return out


def _pairs(h: np.ndarray) -> np.ndarray:
    return mixed(mixed(h[:-1]) * np.uint64(0x9E3779B97F4A7C15) + h[1:])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _instance(text: str) -> int:
    import xxhash

    return _signed(xxhash.xxh3_64_intdigest(text.lower().encode()))


def _may_hold(raw: bytes) -> bool:
    return b"@" in raw or DIGIT.search(raw) is not None


def _seeds(batches):
    """Patterns and instances of the seeds."""
    import pyarrow as pa

    hashes = WordHashes()
    for batch in batches:
        patterns, instances = [], []
        for raw in raw_texts(batch.column("text")):
            if not _may_hold(raw):
                continue
            text = raw.decode("utf-8", "replace")
            own = base_spans(text)
            if not own:
                continue
            words, tokens = raw.translate(LOWER).split(), [m.start() for m in TOKEN.finditer(text)]
            for start, _, end in own:
                # the words before the one that holds the seed, as for a slot
                at = bisect_right(tokens, start) - 1
                for p in contexts(hashes.of(words[max(0, at - 2) : at])):
                    patterns.append(_signed(p))
                    instances.append(_instance(text[start:end]))
        yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.int64()), pa.array(instances, pa.int64())], names=["pattern", "instance"])


def _found(bits: np.ndarray, letters: bool):
    """Entities and candidates of each document, and for each batch how often the patterns occur; words without digits on demand."""

    def find(batches):
        import pyarrow as pa

        span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
        candidate = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("digit", pa.bool_()), ("patterns", pa.list_(pa.int64()))])
        seen = pa.struct([("pattern", pa.int64()), ("n", pa.int64())])
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("spans", pa.list_(span)), ("candidates", pa.list_(candidate)), ("seen", pa.list_(seen))])
        hashes, any_pattern = WordHashes(), bool(bits.any())
        for batch in batches:
            spans, candidates, slots = [], [], []
            counted: dict[int, int] = {}

            def count():
                values, n = np.unique(np.concatenate(slots), return_counts=True) if slots else ([], [])
                for v, k in zip(values.tolist() if len(values) else [], n.tolist() if len(n) else []):
                    counted[v] = counted.get(v, 0) + k
                slots.clear()

            for raw in raw_texts(batch.column("text")):
                text = raw.decode("utf-8", "replace") if _may_hold(raw) else ""
                own = base_spans(text) if text else []
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in own])
                candidates.append([])
                if not any_pattern:
                    continue
                words = raw.translate(LOWER).split()
                h = hashes.of(words)
                single, double = mixed(h[:-1]), _pairs(h) if len(h) > 1 else h[:0]
                # the slot of single[i] and double[i - 1] is word i + 1
                hit1, hit2 = bits[single % np.uint64(BITMAP)], bits[double[:-1] % np.uint64(BITMAP)]
                slots += [single[hit1], double[:-1][hit2]]
                if len(slots) > 400:
                    count()
                if not (hit1.any() or hit2.any()) or not (text or letters):
                    continue
                text = text or raw.decode("utf-8", "replace")
                for i, m in enumerate(TOKEN.finditer(text)):
                    if i == 0 or not (hit1[i - 1] or (i > 1 and hit2[i - 2])):
                        continue
                    word = m.group().strip("\"'()[]<>{},;:.!?")
                    digit = any("0" <= c <= "9" for c in word)
                    if len(word) < 5 or not (digit or letters and any(c.isalpha() for c in word)):
                        continue
                    start = m.start() + m.group().index(word)
                    end = start + len(word)
                    if any(a < end and start < b for a, _, b in own):
                        continue
                    by = [_signed(int(single[i - 1]))] * bool(hit1[i - 1]) + ([_signed(int(double[i - 2]))] if i > 1 and hit2[i - 2] else [])
                    candidates[-1].append({"start": start, "end": end, "instance": _instance(word), "digit": digit, "patterns": by})
            count()
            rows, ids, n = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), len(spans)
            totals = [{"pattern": _signed(p), "n": k} for p, k in counted.items()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*rows, None], pa.int64()), pa.array([*ids, None], pa.int64()), pa.array([*spans, []], schema.field("spans").type),
                    pa.array([*candidates, []], schema.field("candidates").type), pa.array([[]] * n + [totals], schema.field("seen").type),
                ],
                schema=schema,
            )

    return find


FOUND = (
    "row long, doc_id long, spans array<struct<start:long,kind:int,end:long>>, "
    "candidates array<struct<start:long,end:long,instance:long,digit:boolean,patterns:array<long>>>, seen array<struct<pattern:long,n:long>>"
)


def scored_patterns(seeds: DataFrame, found: DataFrame, support: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(pattern, confidence)`` after the given number of rounds over the graph of patterns and instances."""
    totals = found.select(F.inline("seen")).groupBy("pattern").agg(F.sum("n").alias("total")).join(support, "pattern")
    totals = cut_lineage(totals)
    edges = found.select(F.inline("candidates")).select(F.explode("patterns").alias("pattern"), "instance", F.lit(0).alias("seed"))
    edges = seeds.select("pattern", "instance", F.lit(1).alias("seed")).unionByName(edges).groupBy("pattern", "instance")
    edges = cut_lineage(edges.agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")).join(totals.select("pattern"), "pattern"))
    instances = cut_lineage(edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"), F.max("seed").alias("seed")))
    for _ in range(rounds):
        mass = edges.select("pattern", "instance", "n").join(instances, "instance").groupBy("pattern").agg(F.sum(F.col("n") * F.col("score")).alias("mass"))
        patterns = cut_lineage(mass.join(totals, "pattern").select("pattern", F.least(F.lit(1.0), F.col("mass") / F.col("total")).alias("confidence")))
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
        combined = edges.join(patterns, "pattern").groupBy("instance").agg((1 - F.exp(doubt)).alias("combined"), F.max("seed").alias("seed"))
        instances = cut_lineage(combined.select("instance", F.when(F.col("seed") == 1, 1.0).otherwise(F.col("combined")).alias("score"), "seed"))
    return patterns


def _bitmap(patterns: DataFrame) -> np.ndarray:
    bits = np.zeros(BITMAP, dtype=bool)
    # at most BITMAP integers, whatever the number of patterns
    unsigned_low = F.col("pattern").bitwiseAND(F.lit(BITMAP - 1))
    for r in patterns.select(unsigned_low.alias("bit")).distinct().toLocalIterator():
        bits[r["bit"]] = True
    return bits


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per document: ``doc_id, spans`` - array of ``(start, kind number, end, kind)`` in order of start, then kind.

    Offsets are code points, ends exclusive. A null text is empty and has no spans; rows may share an id or have none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    seeds = cut_lineage(docs.select(text.alias("text")).mapInArrow(_seeds, "pattern long, instance long"))
    pairs = seeds.distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= min_seeds)
    support = cut_lineage(pairs.select("pattern"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    found = cut_lineage(rows.mapInArrow(_found(_bitmap(support), False), FOUND).select("candidates", "seen"))
    patterns = scored_patterns(seeds, found, support)
    confident = cut_lineage(patterns.filter(F.col("confidence") >= min_confidence))
    # once more with the confident patterns only: their slots are few, so words without digits can be looked at
    found = cut_lineage(rows.mapInArrow(_found(_bitmap(confident), True), FOUND).select("row", "doc_id", "spans", "candidates"))
    slots = (
        found.select("row", F.inline("candidates"))
        .select("row", "start", "end", "instance", "digit", F.explode("patterns").alias("pattern"))
        .join(confident, "pattern")
    )
    doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
    likely = slots.filter(~F.col("digit")).groupBy("instance", "pattern").agg(F.max("confidence").alias("confidence"))
    likely = likely.groupBy("instance").agg((1 - F.exp(doubt)).alias("score")).filter(F.col("score") >= MIN_LETTERS).select("instance")
    new = (
        slots.filter("digit")
        .unionByName(slots.filter(~F.col("digit")).join(likely, "instance", "left_semi"))
        .select("row", "start", F.lit(KINDS.index("context")).alias("kind"), "end")
        .distinct()
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("new"))
    )
    spans = F.concat("spans", F.coalesce("new", F.array().cast("array<struct<start:long,kind:int,end:long>>")))
    names = F.array(*[F.lit(k) for k in KINDS])
    named = F.transform(F.array_sort(spans), lambda s: F.struct(s["start"], s["kind"].alias("ordinal"), s["end"], F.get(names, s["kind"]).alias("kind")))
    return found.filter(F.col("row").isNotNull()).join(new, "row", "left").select("doc_id", named.alias("spans"))
