"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams (n = 1, 2) over the shapes of a text's
white-space tokens (runs of letters, capitals and digits become one sign each,
other signs stay), each together with the octave of its share of the text, and
of the octaves in which tokens repeat the token or the token pair before them and
lines repeat an earlier line.  They are hashed to ``FEATURES``.

Each feature is scaled by the class log-count ratio r, counted over all labelled
training documents, and rows are scaled to unit length.  A linear hinge-loss
model is then fitted by dual coordinate descent on a bounded sample: the
``SAMPLE`` training rows of each class with the smallest hash of their id.  A
logistic curve, fitted on the sample with the classes weighing what they weigh
in all training rows, turns margins into scores.

Scale: one map over the texts makes narrow feature rows, written once; labels
meet those, not the texts.  The model is a vector of ``FEATURES`` numbers.

Defined cases: null counts as empty, and an empty text has a feature of its own;
with labels of fewer than two classes every score is the smoothed share of
label 1; null labels and labels of unknown ids are not used; a repeated label
row counts again; repeated rows get equal scores; extra columns are not read, or
pass through where rows are filtered.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, fresh, id_crc32, materialize

FEATURES = 1 << 18
OCTAVES = 7
#: Rows of each class that the hinge-loss model is fitted on.
SAMPLE = 4000
SMOOTH = 1.0
COST = 1.0
ROUNDS = 20
THRESHOLD = 0.3

_SHAPE = bytes(0x41 if 0x41 <= b <= 0x5A else 0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x30 if 0x30 <= b <= 0x39
               else 0x20 if b <= 0x20 else b for b in range(256))
_RUNS = [(re.compile(c + b"{2,}"), c) for c in (b"a", b"A", b"0")]


def _octave(n: int, of: int) -> int:
    """0: over a half of it, 1: over a quarter, and so on."""
    return min(OCTAVES, max(0, (of // n).bit_length() - 1)) if n else OCTAVES + 1


def features(text: str | None) -> list[int]:
    """Sorted hashed features of a whole text."""
    if not text or not text.strip():
        return [zlib.crc32(b"empty") % FEATURES]
    shapes = text.encode("utf-8", "surrogatepass").translate(_SHAPE)
    for run, sign in _RUNS:
        shapes = run.sub(sign, shapes)
    tokens = shapes.split()
    n = len(tokens)
    grams = Counter(tokens)
    found = {b"1 %d %b" % (_octave(c, n), g) for g, c in grams.items()}
    found |= {b"2 %d %b %b" % (_octave(c, n), *g) for g, c in Counter(zip(tokens, tokens[1:])).items()}
    said = text.split()
    for lag in (1, 2):
        found.add(b"lag %d %d" % (lag, _octave(sum(map(eq, said, said[lag:])), n)))
    lines = [x for x in text.split("\n") if x]
    found.add(b"lines %d" % _octave(len(lines) - len(set(lines)), max(1, len(lines))))
    return sorted({zlib.crc32(f) % FEATURES for f in found})


def feature_column(text: Column) -> Column:
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([features(t) for t in texts.to_pylist()], pa.list_(pa.int32()))

    return F.arrow_udf(make, T.ArrayType(T.IntegerType()))(text)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int,
                            cost: float = COST, rounds: int = ROUNDS, seed: int = 1) -> np.ndarray:
    """Weights (the last one is the bias) of the L2-regularised hinge-loss model."""
    w, alpha = np.zeros(size + 1), np.zeros(len(y))
    norm = np.array([v @ v + 1.0 for v in values])
    share = len(y) / 2 / np.array([max(1, (y == s).sum()) for s in y])
    upper, order, rng = cost * share, np.arange(len(y)), np.random.default_rng(seed)
    for _ in range(rounds):
        rng.shuffle(order)
        moved = 0.0
        for i in order.tolist():
            g = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), upper[i])
            if step := (new - alpha[i]) * y[i]:
                w[rows[i]] += step * values[i]
                w[-1] += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def logistic_curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """a, b of P(label 1) = 1 / (1 + exp(-(a * margin + b))), by Newton steps on smoothed targets."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        d, h = weight * (p - target), weight * p * (1 - p) + 1e-12
        grad = np.array([d @ margin, d.sum()])
        hess = np.array([[h @ margin ** 2 + 1e-6, h @ margin], [h @ margin, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


class Model:
    """weight per feature (log-count ratio times hinge-loss weight), ratio for the norm, bias, curve."""

    def __init__(self, ratio: np.ndarray, w: np.ndarray, curve: tuple[float, float]):
        self.ratio, self.weight, self.bias, self.curve = ratio.astype(np.float32), (ratio * w[:-1]).astype(np.float32), w[-1], curve

    def score(self, found: list[int]) -> float:
        at = np.array(found, np.int64)
        r = self.ratio[at]
        margin = float(self.weight[at].sum()) / max(1e-9, float(np.sqrt((r * r).sum()))) + self.bias
        a, b = self.curve
        return float(1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500))))


def train(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """rows: doc_id, features, quality (0 or 1)."""
    known = materialize(rows.filter("quality in (0, 1)").select("doc_id", "features", "quality"), "quality-training")
    docs = {r.quality: r.n for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    counts = np.full((2, FEATURES), SMOOTH)
    per_feature = known.select("quality", F.explode("features").alias("f")).groupBy("quality", "f").agg(F.count("*").alias("n"))
    table = per_feature.toPandas()  # at most 2 x FEATURES rows
    counts[table["quality"].to_numpy(int), table["f"].to_numpy(int)] += table["n"].to_numpy()
    if len(docs) < 2:
        share = (docs.get(1, 0) + 1) / (sum(docs.values()) + 2)
        return Model(np.zeros(FEATURES), np.zeros(FEATURES + 1), (0.0, float(np.log(share / (1 - share)))))
    ratio = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))

    x, values, y = [], [], []
    pick = F.xxhash64(F.lit("sample"), F.col("doc_id").cast("string"))
    for label in (0, 1):
        for (found,) in known.filter(F.col("quality") == label).orderBy(pick, "doc_id").select("features").limit(sample).collect():
            at = np.array(found, np.int64)
            v = ratio[at]
            x.append(at)
            values.append(v / max(1e-9, np.sqrt(v @ v)))
            y.append(2 * label - 1)
    y = np.array(y, float)
    w = dual_coordinate_descent(x, values, y, FEATURES)
    margin = np.array([w[at] @ v + w[-1] for at, v in zip(x, values)])
    weight = np.where(y > 0, docs[1] / (y > 0).sum(), docs[0] / (y < 0).sum())
    return Model(ratio, w, logistic_curve(margin, y, weight / weight.sum() * len(y)))


def score_column(model: Model, found: Column) -> Column:
    """Scores of feature arrays."""
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield pa.array([model.score(f) for f in rows.to_pylist()], pa.float64())

    return F.arrow_udf(score, T.DoubleType())(found)


def _training(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.filter("doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    return rows.filter(id_crc32(F.col("doc_id")) % 5 != 0).join(known, "doc_id")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    bounded_batches(docs.sparkSession)
    rows = materialize(docs.select("doc_id", feature_column(F.col("text")).alias("features")), "quality-features")
    model = train(_training(rows, labels))
    return rows.select("doc_id", (id_crc32(F.col("doc_id")) % 5 == 0).alias("held_out"),
                       score_column(model, F.col("features")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def drop_poor(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least the threshold, all columns as they came."""
    bounded_batches(docs.sparkSession)
    model = train(_training(docs.select("doc_id", feature_column(F.col("text")).alias("features")), labels))

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([model.score(features(t)) for t in texts.to_pylist()], pa.float64())

    name = fresh(docs, "score")
    scored = docs.withColumn(name, F.arrow_udf(score, T.DoubleType())(F.col("text")))
    return scored.filter(F.col(name) >= threshold).drop(name)
