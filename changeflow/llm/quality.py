"""Quality classifier: Naive Bayes support vectors.

Features are indicators of n-grams: words, and runs of one to three word shapes (letter case, digits and punctuation of a
word, and whether it repeats the word before). They are scaled by the log ratio of their counts in the two classes; a linear
hinge-loss model over them is fitted by dual coordinate descent, and its margins become probabilities by a logistic curve fitted
on a part of the sample that the model has not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import LOWER, mixed, raw_texts
from changeflow.llm.labelled import fit_sample, held_out

# rows that the model is fitted on, at most; the driver holds their features (about 20 MB)
MAX_FIT_ROWS = 8_000
BITS = 18
SMOOTHING, INTERPOLATION, COST, EPOCHS = 1.0, 0.25, 1.0, 20
THRESHOLD = 0.3


def shape(word: str) -> str:
    out = []
    for c in word:
        k = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


class Grams(dict):
    """Word -> bin of the word and hash of its shape in one integer; emptied when it holds ``limit`` words."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        shaped = xxhash.xxh3_64_intdigest(shape(word.decode("utf-8", "replace"))) & 0xFFFFFFFF
        code = (shaped << BITS) | (xxhash.xxh3_64_intdigest(word.translate(LOWER)) & ((1 << BITS) - 1))
        if len(self) < self.limit:
            self[word] = code
        return code

    def of(self, raw: bytes) -> np.ndarray:
        """Sorted bins of the n-grams that a text holds: words first, shapes above ``2^BITS``."""
        if len(self) >= self.limit:
            self.clear()
        words = raw.split()
        code = np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
        if not len(code):
            return np.zeros(0, dtype=np.int32)
        s = code >> np.uint64(BITS)
        s[1:] = s[1:] * np.uint64(2) + (code[1:] == code[:-1])
        grams = [mixed(s)]
        for n in (2, 3):
            if len(s) >= n:
                grams.append(mixed(sum((s[i : len(s) - n + 1 + i] * np.uint64(2 * i * i + 3) for i in range(1, n)), s[: len(s) - n + 1]) + np.uint64(n)))
        bins = np.unique(np.concatenate([np.unique(g) for g in grams]) >> np.uint64(64 - BITS)) + np.uint64(1 << BITS)
        return np.concatenate([np.unique(code & np.uint64((1 << BITS) - 1)), bins]).astype(np.int32)


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = np.full((2, 2 << BITS), SMOOTHING)
    for bins, label in zip(rows, y):
        counts[int(label > 0)][bins] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows, values, y, cost: float = COST, epochs: int = EPOCHS, seed: int = 0, size: int = 2 << BITS) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model; one dual variable per row, each step solved exactly."""
    w, b = np.zeros(size), 0.0
    dual = np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + b) - 1.0
            new = min(max(dual[i] - gradient / norm[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                w[rows[i]] += step * values[i]
                b += step
                largest = max(largest, abs(new - dual[i]))
                dual[i] = new
        if largest < 1e-3 * cost:
            break
    return w, b


def logistic_curve(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps on smoothed targets."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margins * margins).sum() + 1e-6, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, bins: np.ndarray) -> float:
        margin = float(self.weights[bins].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def _grams(batches):
    import pyarrow as pa

    grams = Grams()
    for batch in batches:
        bins = [grams.of(raw).tobytes() for raw in raw_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(bins, pa.binary())], names=["label", "bins"])


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, **names) -> QualityModel:
    """Fit on at most ``max_rows`` labelled documents; with one class only, every score is that class's smoothed share."""
    sample = fit_sample(docs, labels, "quality", max_rows, **names)
    found = sample.select("text", "label").mapInArrow(_grams, "label int, bins binary").collect()
    found = sorted((r["label"], bytes(r["bins"])) for r in found)
    y = np.array([1 if label > 0 else -1 for label, _ in found])
    rows = [np.frombuffer(b, dtype=np.int32) for _, b in found]
    n1, n0 = int((y > 0).sum()), int((y < 0).sum())
    if min(n1, n0) < FOLD_MIN:
        return QualityModel(np.zeros(2 << BITS, np.float32), 0.0, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    # sorted rows: every fifth row of each class measures the margins
    seen = np.arange(len(rows)) % 5 != 0
    train = [r for r, s in zip(rows, seen) if s]
    ratio = log_count_ratio(train, y[seen])
    w, b = dual_coordinate_descent(train, [ratio[r] for r in train], y[seen])
    # shrinking towards the mean weight keeps the Naive Bayes signs where the data are thin
    used = w[w != 0]
    w = (1 - INTERPOLATION) * w + INTERPOLATION * (np.abs(used).mean() if len(used) else 0.0) * (w != 0)
    scaled = (w * ratio).astype(np.float32)
    margins = np.array([float(scaled[r].sum()) + b for r, s in zip(rows, seen) if not s])
    return QualityModel(scaled, b, *logistic_curve(margins, y[~seen] > 0))


FOLD_MIN = 5


def _scorer(model):
    def score(batches):
        import pyarrow as pa

        own, grams = model.value, Grams()
        for batch in batches:
            scores = [own.probability(grams.of(raw)) for raw in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    return score


def quality_scores(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``; a null text is scored as an empty one."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.mapInArrow(_scorer(sent), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
