"""Language identification by error-correcting output codes.

Every learned language has a codeword; one binary n-gram classifier per bit
tells the languages with a 1 from those with a 0.  Codewords are the exhaustive
code for up to ``EXHAUSTIVE`` languages and, beyond, the best of some seeded
random dense codes by its least Hamming distance.  A bit's classifier sums
smoothed log-ratios of byte n-gram probabilities (n = 2 and 3, over lower-cased
letters and single blanks, hashed to ``BUCKETS``), each language weighing the
same, and divides by the number of n-grams: its margin.

Decoding is loss-weighted: a codeword costs the logistic loss of the margins
against its bits, weighted by how well each bit's classifier did on that
language's training documents.  The cheapest codeword wins; the score is its
share of a softmax over the costs, and a prediction is ambiguous when the
runner-up costs less than ``AMBIGUOUS`` times as much.

Training reads all labelled documents of the training part: n-gram counts are
summed per language.  Languages are the values of ``lang``, however many (a noisy
column has thousands): the driver fits the classifiers, bits x BUCKETS numbers,
from ``LANGS_AT_ONCE`` languages' counts at a time, and bits grow with the
logarithm of the number of languages.

Defined cases: a null text or one without a letter is "und" with score 0; with
no training documents every text is; rows with a null lang are predicted but
not learned from; a null id counts as the empty string in the split; repeated
rows get equal results; extra columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, id_crc32, materialize

UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (2, 3)
SMOOTH = 0.5
EXHAUSTIVE = 7
#: Languages whose counts (BUCKETS numbers each) are on the driver at once.
LANGS_AT_ONCE = 64
#: Distances between codewords, over all random codes that are tried.
TRIES = 10 ** 8
AMBIGUOUS = 1.25
#: The slope that turns a margin (in nats per n-gram) into a loss.
SLOPE = 8.0

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_ASCII_LETTER = re.compile(r"[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or (not text.isascii() and any(map(str.isalpha, text))))


def grams(text: str) -> np.ndarray:
    """Buckets of a text's byte n-grams."""
    letters = b" ".join(text.encode("utf-8", "surrogatepass").translate(_LETTERS).split())
    a = np.frombuffer(b" " + letters + b" ", np.uint8).astype(np.uint32)
    found = []
    for n in ORDERS:
        h = np.full(max(0, len(a) - n + 1), n, np.uint32)
        for k in range(n):
            h = h * np.uint32(259) + a[k:len(a) - n + 1 + k]
        found.append((h * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(found)


def _least_distance(code: np.ndarray) -> int:
    """Smallest Hamming distance of two codewords, some rows at a time."""
    least, signs = code.shape[1], code.astype(np.float32)
    for s in range(0, len(code), 256):
        distance = (code.shape[1] - signs[s:s + 256] @ signs.T) / 2
        distance[np.arange(len(distance)), np.arange(s, s + len(distance))] = code.shape[1]
        least = min(least, int(distance.min()))
    return least


def codewords(n: int, seed: int = 1) -> np.ndarray:
    """n rows of +1 and -1; no column is constant or another's complement.  The
    more languages, the fewer random codes are tried: long ones are all alike."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= EXHAUSTIVE:
        columns = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, np.int8).T
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, most = None, -1
    for _ in range(max(1, min(200, TRIES // (n * n)))):
        code = rng.choice(np.array([1, -1], np.int8), (n, bits))
        while (constant := np.abs(code.sum(0, dtype=np.int64)) == n).any():
            code[:, constant] = rng.choice(np.array([1, -1], np.int8), (n, int(constant.sum())))
        if (least := _least_distance(code)) > most:
            best, most = code, least
    return best


class Model:
    """Bit classifiers and codewords.  The classifiers are sums over languages, so
    a model is fitted from a few languages' counts at a time."""

    def __init__(self, langs: list[str], counts: Iterable[np.ndarray]):
        """``counts``: n-gram counts of consecutive languages, a row each."""
        self.langs, self.code = langs, codewords(len(langs))
        one = self.code.T == 1  # bits x languages
        sums = np.zeros((2, len(one), BUCKETS))
        at = 0
        for block in counts:
            p = (block + SMOOTH) / (block.sum(1, keepdims=True) + SMOOTH * BUCKETS)
            here = one[:, at:at + len(block)].astype(float)
            sums[0] += here @ p
            sums[1] += (1 - here) @ p
            at += len(block)
        n_one = one.sum(1)[:, None]
        self.ratios = list(np.log((sums[0] / np.maximum(n_one, 1)) / (sums[1] / np.maximum(len(langs) - n_one, 1)))) if len(one) else []

    def margins(self, text: str | None) -> list[float] | None:
        if not self.langs or not has_letter(text):
            return None
        found = grams(text)
        return [float(r[found].sum() / max(1, len(found))) for r in self.ratios]


def _counts(docs: DataFrame) -> tuple[list[str], Iterator[np.ndarray]]:
    """The languages of labelled rows and their n-gram counts, some languages at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = by_lang.setdefault(lang, [])
                if has_letter(text):
                    found.append(grams(text))
            for lang, found in by_lang.items():
                total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for g in found:
                    total += np.bincount(g, minlength=BUCKETS)
        for lang, total in sums.items():
            # a language's first row says that it is there, even without a letter
            at = np.union1d(np.flatnonzero(total), [0])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at])],
                                             names=["lang", "bucket", "n"])

    sums = (docs.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    sums = materialize(sums, "langid-counts")
    langs = sorted(r.lang for r in sums.select("lang").distinct().collect())

    def blocks() -> Iterator[np.ndarray]:
        for s in range(0, len(langs), LANGS_AT_ONCE):
            some = langs[s:s + LANGS_AT_ONCE]
            counts = np.zeros((len(some), BUCKETS))
            found = sums.filter(F.col("lang").isin(some)).select("lang", "bucket", "n").toPandas()
            counts[found["lang"].map({lang: k for k, lang in enumerate(some)}).to_numpy(int), found["bucket"].to_numpy()] = found["n"]
            yield counts

    return langs, blocks()


def predict(docs: DataFrame, is_training: Column) -> DataFrame:
    """docs: doc_id, text, lang. Returns doc_id, is_training, lang_pred, score,
    ambiguous, margins."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select("doc_id", "text", "lang", is_training.alias("training"))
    model = Model(*_counts(rows.filter("training and lang is not null")))

    def bits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([model.margins(t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    margins = F.arrow_udf(bits, T.ArrayType(T.DoubleType()))(F.col("text"))
    marked = materialize(rows.select("doc_id", "lang", "training", margins.alias("margins")), "langid-margins")

    n, code = len(model.langs), model.code.astype(float)
    weight = np.ones_like(code)
    if n > 1:
        per_bit = marked.filter("training and lang is not null and margins is not null").select(
            "lang", F.posexplode("margins").alias("bit", "margin"))
        right = per_bit.groupBy("lang", "bit").agg(F.avg((F.col("margin") > 0).cast("double")).alias("one")).collect()
        row_of = {lang: k for k, lang in enumerate(model.langs)}
        for r in right:
            weight[row_of[r.lang], r.bit] = max(1e-3, r.one if code[row_of[r.lang], r.bit] > 0 else 1 - r.one)
        weight /= weight.sum(1, keepdims=True)
    return _decode(marked, model.langs, code, weight)


def _decode(marked: DataFrame, langs: list[str], code: np.ndarray, weight: np.ndarray) -> DataFrame:
    def choose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])
        for margins in batches:
            out = []
            for m in margins.to_pylist():
                if m is None:
                    out.append({"lang_pred": UNKNOWN, "score": 0.0, "ambiguous": False})
                    continue
                cost = (weight * np.logaddexp(0, -SLOPE * code * np.array(m))).sum(1)
                order = np.argsort(cost, kind="stable")
                share = np.exp(-(cost - cost[order[0]]) * max(1, code.shape[1]))
                close = len(order) > 1 and cost[order[1]] < AMBIGUOUS * cost[order[0]]
                out.append({"lang_pred": langs[order[0]], "score": float(1 / share.sum()), "ambiguous": bool(close)})
            yield pa.array(out, kind)

    result = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("ambiguous", T.BooleanType())])
    found = F.arrow_udf(choose, result)(F.col("margins"))
    return marked.select("doc_id", "training", found.alias("found"), "margins").select(
        "doc_id", "training", "found.*", "margins")


def language_id(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous.
    Learned from documents with crc32(id) mod 4 other than 2."""
    held_out = (id_crc32(F.col("doc_id")) % 4) == 2
    return predict(docs, ~held_out).select("doc_id", (~F.col("training")).alias("held_out"), "lang_pred", "score", "ambiguous")
