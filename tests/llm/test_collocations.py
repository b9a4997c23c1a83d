"""Phrases against a plain count, and the guarantee of the summaries."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import LONG

import changeflow.llm.collocations as m
from changeflow.llm.collocations import added, collocations, frequent_phrases, packed, trimmed, unpacked

SCHEMA = "text string, lang string, n long, phrase string, a long, score string"


def frame(spark, rows):
    return spark.createDataFrame([(t, lang, 1, "x", 2, "y") for t, lang in rows], SCHEMA)


def brute(rows, least, top):
    out = []
    for lang in {x or "und" for _, x in rows}:
        f, n = Counter(), 0
        for text in (t or "" for t, x in rows if (x or "und") == lang):
            lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        found = []
        for p, a in often.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts(seed, n=300):
    r = random.Random(seed)
    vocabulary = ["New", "york", "big", "apple", "é", "a", "of", "the", "x-y", "日本"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randrange(30)):
            words += ["new", "York", "city"] if r.random() < 0.2 else [r.choice(vocabulary)]
        seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?!", "\x0b"]
        rows.append(("".join(w + r.choice(seps) for w in words) if r.random() > 0.05 else None, r.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_counts(spark, seed):
    rows = texts(seed)
    got = sorted(tuple(r) for r in collocations(frame(spark, rows), min_count=8, top=15).collect())
    assert got == brute(rows, 8, 15)


def test_small_blocks_and_memories(monkeypatch):
    """Phrases cross the borders of blocks, words are forgotten, summaries and counts are sent often."""
    rows = [(t or "", lang or "und") for t, lang in texts(7, 60)] + [("new york city " * 200, "en")]
    batch = pa.RecordBatch.from_pydict({"lang": [x for _, x in rows], "text": [t for t, _ in rows]})
    full = type("Filter", (), {"value": bytes([255]) * 128})()

    def run():
        words, pairs, counts = Counter(), Counter(), Counter()
        for b in m._count_words([batch]):
            for lang, w, f in zip(*(c.to_pylist() for c in b.columns)):
                words[lang, w] += f
        for length in (None, (full, 0)):
            for b in m._summarise(full, length, 10**9, 4, 60)([batch]):
                for _, h, c, lost in zip(*(x.to_pylist() for x in b.columns)):
                    assert lost == 0
                    pairs.update(dict(zip(np.cumsum(unpacked(h)).tolist(), unpacked(c).tolist())))
        for b in m._count_phrases(full, (full, 0), (full, 0), 3)([batch]):
            for _, lang, phrase, a in zip(*(x.to_pylist() for x in b.columns)):
                for key in zip(lang, phrase, a):
                    counts[key[:2]] += key[2]
        return words, pairs, counts

    large = run()
    for name, value in (("BLOCK_WORDS", 40), ("MEMORY_WORDS", 6), ("SUMMARY_LIMIT", 30), ("COUNTED_LIMIT", 10)):
        monkeypatch.setattr(m, name, value)
    assert run() == large and sum(large[1].values()) == sum(large[2].values())


def test_every_row_counts_and_edge_cases(spark):
    rows = [("a b", "en")] * 12 + [("a b", None)] * 7 + [(None, "en"), ("", "en"), (" .\n", "en"), (LONG, "en"), ("a" * 200_000 + " b", "de")]
    got = sorted(tuple(r) for r in collocations(frame(spark, rows), min_count=7).collect())
    assert got == brute(rows, 7, 2000) and ("und", 1, "a b", 7, 7, 7, 14, 2000) in got
    assert collocations(frame(spark, []), min_count=2).collect() == []
    assert collocations(frame(spark, [("a b c", "en")]), min_count=2).collect() == []


def test_long_text_is_read_in_slices(monkeypatch):
    whole = m.Words().numbers(LONG.encode())
    monkeypatch.setattr(m, "SLICE_BYTES", 50)
    for text in (LONG, "x" * 500, "ab. " * 100 + "y" * 120 + ".z"):
        words = m.Words()
        got = b" ".join(words.text[i] for i in np.concatenate(words.numbers(text.encode())))
        assert got == b" ".join(text.encode().translate(m.SCANNED).replace(b".", b" . ").split() + [b"."])
    assert len(whole) == 2


def test_summaries_lose_less_than_mass_by_capacity():
    r = np.random.default_rng(1)
    for capacity in (5, 20, 100):
        true, summary, lost, mass = Counter(), (np.zeros(0, np.int64), np.zeros(0, np.int64)), 0, 0
        for _ in range(30):
            h, c = np.unique(r.zipf(1.3, 400) % 1000, return_counts=True)
            true.update(dict(zip(h.tolist(), c.tolist())))
            mass += int(c.sum())
            h, c, less = trimmed(h, c, capacity)
            lost += less
            summary = added([summary[0], h], [summary[1], c])
            *summary, less = trimmed(*summary, capacity)
            lost += less
        assert lost <= mass / (capacity + 1)
        left = dict(zip(summary[0].tolist(), summary[1].tolist()))
        assert all(n - lost <= left.get(h, 0) <= n for h, n in true.items())


def test_uneven_partitions_are_repeated_with_more_counters(spark, monkeypatch):
    calls = []
    merge = m._merge
    monkeypatch.setattr(m, "_merge", lambda capacity, least: calls.append(capacity) or merge(capacity, least))
    monkeypatch.setattr(m, "trimmed", lambda h, c, capacity: (h[:0], c[:0], 99) if capacity < 50 and len(h) else (h, c, 0))
    rows = [(f"a b c{i}", "en") for i in range(30)]
    _, phrases = frequent_phrases(frame(spark, rows), min_count=9)
    assert [(r.phrase, r.a) for r in phrases.collect()] == [("a b", 30)]
    assert calls


def test_packed():
    x = np.array([0, 1, 255, 256, 2**40, 2**62], dtype=np.int64)
    assert unpacked(packed(x)).tolist() == x.tolist() and len(unpacked(packed(x[:0]))) == 0
