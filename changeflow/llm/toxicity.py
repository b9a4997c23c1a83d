"""Toxicity: cumulative-link ordinal regression.

Severity grades are 0 (not toxic) to 3. One weight vector over sparse text features is shared by three ordered thresholds:
P(grade >= k) = sigmoid(w x - t_k). The labels say only whether a document is toxic, so the grades 1 to 3 of the toxic ones of the
sample are the terciles of the share of their words that are marked, a word being marked if it or its beginning is significantly
more frequent in toxic documents. Output is the expected severity, the sum of the three probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import LOWER, raw_texts
from changeflow.llm.labelled import fit_sample, held_out

# rows that the model is fitted on, and features that it may use, at most
MAX_FIT_ROWS = 20_000
MAX_FEATURES = 20_000
BITS = 20
MIN_DOCS, MIN_SIGNIFICANCE = 4, 4.0
GRADES = 4
STRIP = bytes(c for c in range(0x21, 0x7F) if not (chr(c).isalnum()))


def bins_of(word: bytes) -> list[int]:
    """Bins of a word's features: itself and its first four and five bytes."""
    out = [word] + [b"^" + word[:n] for n in (4, 5) if len(word) > n]
    return [xxhash.xxh3_64_intdigest(f) & ((1 << BITS) - 1) for f in out]


class Words(dict):
    """Word -> three bins in one integer (a missing one repeats the first); emptied when it holds ``limit`` words."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        core = word.strip(STRIP)
        bins = bins_of(core)
        bins += bins[:1] * (3 - len(bins))
        code = bins[0] | bins[1] << BITS | bins[2] << 2 * BITS
        if len(self) < self.limit:
            self[word] = code
        return code

    def of(self, raw: bytes) -> np.ndarray:
        """Array of (words, 3) bins in order."""
        if len(self) >= self.limit:
            self.clear()
        words = raw.translate(LOWER).split()
        code = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        low = (1 << BITS) - 1
        return np.stack([code & low, (code >> BITS) & low, code >> 2 * BITS], axis=1)


def _document_counts(batches):
    """For each bin, the documents of each class that hold it; combined for each batch."""
    import pyarrow as pa

    words = Words()
    for batch in batches:
        counts = np.zeros((2, 1 << BITS), dtype=np.int64)
        for raw, label in zip(raw_texts(batch.column("text")), batch.column("label").to_pylist()):
            counts[int(label > 0)][np.unique(words.of(raw))] += 1
        held = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[0][held]), pa.array(counts[1][held])], names=["bin", "clean", "toxic"])


def features_of(bins: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and values of a document's features, and the share of its words that are marked.

    ``place``: for every bin its place among the chosen features, or -1. A feature counts twice: by presence, so that one word
    in a long text is enough, and by its rate.
    """
    at = place[bins]
    marked = (at >= 0).any(axis=1)
    found, n = np.unique(at[at >= 0], return_counts=True)
    total = max(1, len(bins))
    chosen = int(place.max()) + 1
    return np.concatenate([found, found + chosen]), np.concatenate([np.ones(len(found)), np.sqrt(n / total)]), float(marked.mean()) if len(bins) else 0.0


def _chosen_features(place):
    def choose(batches):
        import pyarrow as pa

        words = Words()
        for batch in batches:
            rows = [features_of(words.of(raw), place) for raw in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([r[0].astype(np.int64).tobytes() for r in rows], pa.binary()), pa.array([r[1].tobytes() for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.float64())],
                names=["label", "at", "value", "share"],
            )

    return choose


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class OrdinalModel:
    place: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: float) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        return sigmoid(score - self.thresholds)


def fit_cumulative_link(at, value, grade: np.ndarray, size: int, grades: int = GRADES, l2: float = 1e-5, steps: int = 500, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by gradient steps on the likelihood; thresholds are a first one and positive gaps."""
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    col = np.concatenate(at) if len(at) else np.zeros(0, int)
    val = np.concatenate(value) if len(value) else np.zeros(0)
    n = max(1, len(grade))
    share = np.array([(grade >= k).mean() if len(grade) else 0.0 for k in range(1, grades)])
    start = -np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    p = np.concatenate([np.zeros(size), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        w, cuts = p[:size], np.cumsum(np.concatenate([p[size : size + 1], np.exp(p[size + 1 :])]))
        s = np.bincount(row, val * w[col], minlength=len(grade))
        lower = np.where(grade > 0, sigmoid(s - cuts[np.maximum(grade, 1) - 1]), 1.0)
        upper = np.where(grade < grades - 1, sigmoid(s - cuts[np.minimum(grade, grades - 2)]), 0.0)
        mass = np.maximum(lower - upper, 1e-9)
        dl, du = lower * (1 - lower) / mass, upper * (1 - upper) / mass
        ds = -(dl - du) / n
        g = np.zeros_like(p)
        g[:size] = np.bincount(col, val * ds[row], minlength=size) + l2 * w
        d_cut = np.array([(dl[grade == k].sum() - du[grade == k - 1].sum()) / n for k in range(1, grades)])
        # a gap moves all thresholds above it
        tail = np.cumsum(d_cut[::-1])[::-1]
        g[size], g[size + 1 :] = tail[0], tail[1:] * np.exp(p[size + 1 :])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return p[:size], np.cumsum(np.concatenate([p[size : size + 1], np.exp(p[size + 1 :])]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, **names) -> OrdinalModel:
    """Fit on at most ``max_rows`` labelled documents; without toxic or clean ones nothing is found toxic."""
    sample = fit_sample(docs, labels, "toxic", max_rows, **names).select("text", "label")
    sizes = {r["label"] > 0: r["n"] for r in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(False, 0), sizes.get(True, 0)
    place = np.full(1 << BITS, -1, dtype=np.int32)
    if not n0 or not n1:
        return OrdinalModel(place, np.zeros(0), np.full(GRADES - 1, 30.0))
    counts = sample.mapInArrow(_document_counts, "bin long, clean long, toxic long").groupBy("bin").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    expected = (F.col("clean") + F.col("toxic")) * F.lit(n1 / (n0 + n1))
    z = (F.col("toxic") - expected) / F.sqrt(expected * F.lit(n0 / (n0 + n1)))
    chosen = counts.filter(F.col("toxic") >= MIN_DOCS).withColumn("z", z).filter(F.col("z") >= MIN_SIGNIFICANCE).orderBy(F.desc("z"), "bin").limit(MAX_FEATURES)
    for i, r in enumerate(chosen.select("bin").collect()):
        place[r["bin"]] = i
    found = sample.mapInArrow(_chosen_features(place), "label int, at binary, value binary, share double").collect()
    found = sorted((r["label"], r["share"], bytes(r["at"]), bytes(r["value"])) for r in found)
    label, share = np.array([r[0] > 0 for r in found]), np.array([r[1] for r in found])
    cuts = np.quantile(share[label], [1 / 3, 2 / 3])
    grade = np.where(label, 1 + (share > cuts[0]).astype(int) + (share > cuts[1]), 0)
    at = [np.frombuffer(r[2], dtype=np.int64) for r in found]
    w, thresholds = fit_cumulative_link(at, [np.frombuffer(r[3]) for r in found], grade, 2 * (int(place.max()) + 1))
    return OrdinalModel(place, w, thresholds)


def severity_column(sent, text: Column) -> Column:
    """Column ``(severity, p1, p2, p3)`` of a text column; ``sent``: the broadcast model, bounded by its number of bins and features."""

    @F.pandas_udf("severity double, p1 double, p2 double, p3 double")
    def severity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, words = sent.value, Words()
        for texts in batches:
            out = np.empty((len(texts), 3))
            for i, t in enumerate(texts):
                at, value, _ = features_of(words.of((t or "").encode()), model.place)
                out[i] = model.at_least(float(model.weights[at] @ value) if len(at) else 0.0)
            yield pd.DataFrame({"severity": out.sum(axis=1), "p1": out[:, 0], "p2": out[:, 1], "p3": out[:, 2]})

    return severity(text)


def toxicity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, severity, grade, toxic, kept``.

    ``severity`` is the expected grade, ``grade`` the number of grades that are likelier reached than not, and a document is
    toxic from grade 1 on. A null text is scored as an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), severity_column(sent, F.coalesce(F.col(text_col), F.lit(""))).alias("s"))
    grade = sum(((F.col(f"s.p{k}") >= 0.5).cast("int") for k in range(2, GRADES)), (F.col("s.p1") >= 0.5).cast("int"))
    return rows.select("doc_id", "held_out", F.col("s.severity").alias("severity"), grade.alias("grade"), (grade > 0).alias("toxic"), (grade == 0).alias("kept"))


def without_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the toxic ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.filter(severity_column(sent, F.coalesce(F.col(text_col), F.lit("")))["p1"] < 0.5)
