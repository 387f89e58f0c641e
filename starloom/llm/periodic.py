"""Runs of periodically repeated words, by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``LEAST_PERIODS`` * q and ``LEAST_WORDS`` words long, that no
neighbouring word extends with that period.

Splitting.  Every word of a run occurs in it at least ``LEAST_PERIODS`` times, so a
word that occurs less often within its segment is in no run and splits the
segment; the parts are counted again, all at once, until nothing changes.
Prose falls apart in a round or two.

Lag scan.  For each lag q a surviving segment is read at every q-th word: a run of
period q holds at least three of those places in a row with equal words, so
about n/q words are looked at and n log n for all lags.  Where three agree the
stretch is extended to both sides in doubling pieces.  Lags ascend, so a stretch
inside a run whose period divides the lag has that smaller period and is
skipped before it is extended.

Each text is read in one task, on its own; nothing is shuffled.

Defined cases: null text has no words; empty texts have no runs and an empty
collapsed text; a null id is the empty string to a rewriting; repeated rows get
equal results; ties for the longest run go to the smallest start, then period;
an empty table gives no rows; other columns are not read; texts may have any
length.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Rounds of splitting; what still changes then goes to the lag scan, which is exact by itself.
ROUNDS = 64

Rewrite = Callable[[str, list[bytes]], list[bytes]]
Run = tuple[int, int, int]


def repeat_tails(doc_id: str, words: list[bytes]) -> list[bytes]:
    """Gives one document in ten, by crc32 of its id, a periodic tail."""
    h, n = zlib.crc32(doc_id.encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


# splitting

def _parts(at: np.ndarray) -> np.ndarray:
    """Bounds of the stretches of consecutive numbers in an ascending array."""
    return np.concatenate([[0], np.flatnonzero(np.diff(at) != 1) + 1, [len(at)]])


def segments(codes: np.ndarray, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Segments (start, end) that frequency splitting leaves."""
    if len(codes) < LEAST_WORDS:
        return []
    kinds = int(codes.max()) + 1
    at = np.flatnonzero(np.bincount(codes)[codes] >= LEAST_PERIODS)  # places that are still in a segment
    done: list[tuple[int, int]] = []
    for _ in range(rounds):
        if not len(at):
            return sorted(done)
        bounds = _parts(at)
        sizes = np.diff(bounds)
        segment = np.repeat(np.arange(len(sizes)), sizes)
        _, word, counts = np.unique(segment * kinds + codes[at], return_inverse=True, return_counts=True)
        keep = (counts[word] >= LEAST_PERIODS) & (sizes >= LEAST_WORDS)[segment]
        changed = np.zeros(len(sizes), bool)
        changed[segment[~keep]] = True
        done += [(int(at[bounds[s]]), int(at[bounds[s + 1] - 1]) + 1) for s in np.flatnonzero(~changed)]
        at = at[keep & changed[segment]]
    bounds = _parts(at)
    return sorted(done + [(int(at[s]), int(at[e - 1]) + 1) for s, e in zip(bounds[:-1], bounds[1:]) if e > s])


# lag scan

def _equal_ahead(codes: np.ndarray, i: int, q: int, end: int) -> int:
    """First place from i on whose word differs from the one q further, or end - q."""
    step = 16
    while i < end - q:
        stop = min(i + step, end - q)
        same = codes[i:stop] == codes[i + q:stop + q]
        if not same.all():
            return i + int(same.argmin())
        i, step = stop, step * 2
    return i


def _equal_behind(codes: np.ndarray, i: int, q: int, start: int) -> int:
    """Smallest place from which on, up to i, all words equal those q further."""
    step = 16
    while i > start:
        low = max(i - step, start)
        same = codes[low:i] == codes[low + q:i + q]
        if not same.all():
            return i - int(same[::-1].argmin())
        i, step = low, step * 2
    return i


def scan(codes: np.ndarray, start: int, end: int) -> list[Run]:
    """Runs (start, length, period) of one segment, by ascending lags."""
    runs: dict[tuple[int, int], int] = {}  # (start, end) -> period
    found: list[tuple[int, int, int]] = []
    owner = np.full(end - start, -1)  # the last run found over each place
    for q in range(1, (end - start) // LEAST_PERIODS + 1):
        sample = codes[start:end:q]
        same = sample[1:] == sample[:-1]
        three = np.flatnonzero(same[1:] & same[:-1])
        k = 0
        while k < len(three):
            i = start + int(three[k]) * q
            s, e, p = found[owner[i - start]] if owner[i - start] >= 0 else (0, 0, 1)
            if i + q >= e or q % p:  # else the stretch is that run
                s, e = _equal_behind(codes, i, q, start), _equal_ahead(codes, i, q, end) + q
                # a stretch of smaller period has the very bounds of the run of that period
                if e - s >= max(LEAST_WORDS, LEAST_PERIODS * q) and (s, e) not in runs:
                    runs[s, e] = q
                    owner[s - start:e - start] = len(found)
                    found.append((s, e, q))
            k = max(k + 1, int(np.searchsorted(three, -((start - e + q) // q))))
    return [(s, e - s, q) for s, e, q in found]


def runs_of(words: list[bytes]) -> list[Run]:
    """All runs (start, length, period) by start, then period."""
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    return sorted((r for s, e in segments(codes) for r in scan(codes, s, e)), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (array of start, length and
    period, by start, then period) and the collapsed text.  ``rewrite`` may change
    a document's words first."""
    bounded_batches(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            n, runs, texts = [], [], []
            for doc_id, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.split() if text else []
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                found = runs_of(words)
                n.append(len(words))
                runs.append([{"start": s, "length": m, "period": q} for s, m, q in found])
                texts.append(collapse(words, found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(runs, run),
                                              pa.array(texts, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.col(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(find, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                                  "collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def digests(found: DataFrame) -> DataFrame:
    """One narrow row per document: its longest run and digests of all runs and
    of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.withColumn("longest", longest)
    length, period = F.col("longest.length"), -F.col("longest.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
