"""Documents with every odd case, and plain Python versions of words and shingles."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, name string, size string, node string, kept string"
LONG = " ".join(f"w{i % 977}" for i in range(20_000))


def docs_of(spark, rows):
    """rows: (doc_id, text[, source]); the further columns clash with names that the operators use."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "r", "n", "z", "x", "k") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "one  two"), (6, "a b c d e f g"), (6, "a b c d e f g"), (None, "a b c d e f g"),
    (None, None), (7, LONG), (8, LONG + " end"), (9, "é x ünï"), (10, "A B C D E F G"),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
