"""Spelling variants of a corpus' words, by blocked Gram matrices of letter counts.

Words.  Runs of Latin letters, A-Z lower-cased, are counted over all texts; a
task sums a batch before its rows move, so a word that is everywhere costs one
row a batch.  ``noise`` may change a run (it depends on document and run).

Near pairs.  Two words are near if one inserted, deleted or replaced code point
makes them equal.  Then their letter counts differ in one or two letters: the
squared distance |a|^2 + |b|^2 - 2ab is 1 for lengths that differ by one and 2
for equal lengths.  The letters are dealt into ``PARTS`` parts, so near words
agree in the counts of all parts but two, and meet in the block of that choice
of two parts and those counts.  A block's words go by length into matrices of
letter counts; NumPy products of a length's matrix with itself and with the next
length's give all distances; pairs at most two apart are kept and their edit is
verified on the code points (common prefix + common suffix).  A pair counts only
in the first block that holds it, so blocks return sums a word and never pairs.

Scale.  Blocks with few words are packed into one product.  A block beyond
``BLOCK_LETTERS`` letters is dealt into units of one length and one tile of at
most that many letters on the left, with the later tiles of its length and all of
the next length streamed past it: no task holds more than one tile and one
piece of the stream, and no pair is left out.

Forms.  A word's form is its near word of largest count, if that is ``RATIO``
times its own; counts grow along forms, so roots are found by doubling the
steps, at most seven rounds.

Defined cases: null and empty texts have no words; a null id counts as the empty
string in the noise; repeated rows count each; ties go to the smallest word in
code-point order; an empty table gives no rows; other columns are not read;
words and texts may have any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2
PARTS = 5
#: Letters of the words that one unit holds at once.
BLOCK_LETTERS = 1 << 18
#: Words that are multiplied at once.
PRODUCT_ROWS = 1024
#: Words of small blocks that share one product.
PACKED_ROWS = 512

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
_LOWER = {u: u + 32 for u in range(ord("A"), ord("Z") + 1)}
_LETTERS = 26 + 0x100 - 0xC0

Noise = Callable[[str, str], str]


def one_in(every: int) -> Noise:
    """Deletes one code point of a run where ``every`` divides the crc32 of
    ``<doc_id>:<run>``; the place is that number modulo the run's length."""
    def change(doc_id: str, run: str) -> str:
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        at = h % len(run)
        return run[:at] + run[at + 1:] if h % every == 0 else run
    return change


def text_words(doc_id: str, text: str, noise: Noise | None = None) -> Counter:
    """Words of one text with at least ``LEAST_LETTERS`` letters (noise only
    shortens, so shorter runs never make one)."""
    counts: Counter = Counter()
    for run, n in Counter(_RUN.findall(text)).items():
        word = run.lower() if run.isascii() else run.translate(_LOWER)
        if noise is not None:
            word = noise(doc_id, word)
        if len(word) >= LEAST_LETTERS:
            counts[word] += n
    return counts


def vocabulary(docs: DataFrame, noise: Noise | None = None, least_count: int = LEAST_COUNT,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct words with at least ``least_count`` occurrences: word, n."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update(text_words(doc_id, text, noise))
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                                             ["word", "n"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    part = rows.filter("text is not null").mapInArrow(count, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# blocks

def _choices() -> list[tuple[int, int]]:
    return [(a, b) for a in range(PARTS) for b in range(a + 1, PARTS)]


def _others(letters: Column, choice: tuple[int, int]) -> Column:
    """The letters of all parts but two."""
    return F.array_join(F.filter(letters, lambda c: ~(F.ascii(c) % PARTS).isin(*choice)), "")


def blocks(words: DataFrame) -> DataFrame:
    """Every word once for each choice of two parts: ``block`` is a digest of the
    choice and of the letters of the other parts (words that meet by a collision
    are told apart by their products)."""
    letters = F.array_sort(F.regexp_extract_all(F.col("word"), F.lit("(?s)."), F.lit(0)))
    rows = words.withColumn("length", F.char_length("word")).withColumn("letters", letters)
    keys = F.array(*(F.struct(
        F.lit(i).alias("choice"),
        F.xxhash64(F.lit(i), _others(F.col("letters"), choice)).alias("block"))
        for i, choice in enumerate(_choices())))
    return rows.select("word", "n", "length", F.inline(keys))


def units(rows: DataFrame, most: int = BLOCK_LETTERS) -> DataFrame:
    """Rows of blocks dealt to units of bounded size: unit, side, word, n,
    length, choice.  A block within the bound is one unit (side 0); a larger one
    becomes a unit for each tile of each length, with what has to pass it on side 1."""
    sizes = rows.groupBy("block", "length").agg(F.sum("length").alias("letters"))
    large = sizes.groupBy("block").agg(F.sum("letters").alias("all")).filter(F.col("all") > most).select("block")
    tiles = materialize(sizes.join(large, "block").select(
        "block", "length", F.ceil(F.col("letters") / most).cast("int").alias("tiles")), "spelling-tiles")
    own = tiles.select("block", "length", "tiles")
    shorter = tiles.select("block", (F.col("length") + 1).alias("length"), F.col("tiles").alias("below"))
    dealt = rows.join(own, ["block", "length"], "left").join(shorter, ["block", "length"], "left")
    small = dealt.filter("tiles is null").select(F.xxhash64("block").alias("unit"), F.lit(0).alias("side"),
                                                 "word", "n", "length", "choice")
    tile = F.pmod(F.xxhash64("word", F.lit("tile")), F.col("tiles")).cast("int")
    place = F.transform(F.sequence(F.lit(0), F.col("tile")), lambda i: F.struct(
        F.xxhash64("block", "length", i).alias("unit"), (i < F.col("tile")).cast("int").alias("side")))
    beside = F.when(F.col("below").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("below") - 1), lambda i: F.struct(
        F.xxhash64("block", F.col("length") - 1, i).alias("unit"), F.lit(1).alias("side")))).otherwise(F.array())
    tiled = dealt.filter("tiles is not null").withColumn("tile", tile).select(
        F.inline(F.concat(place, beside)), "word", "n", "length", "choice")
    return small.unionByName(tiled)


# products

class Words:
    """Words of one length as arrays: units, choices, codes and letter counts."""

    def __init__(self, at: np.ndarray, words: list[str], unit: np.ndarray, choice: np.ndarray, length: int):
        self.at, self.unit, self.choice, self.length = at, unit, choice, length
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)
        self.codes = np.where(codes < 0xC0, codes - ord("a"), codes - 0xC0 + 26).astype(np.uint8)
        flat = (np.arange(len(words))[:, None] * _LETTERS + self.codes).ravel()
        kind = np.float32 if length < 2000 else np.float64  # products stay exact
        self.counts = np.bincount(flat, minlength=len(words) * _LETTERS).reshape(len(words), _LETTERS).astype(kind)
        self.half = (self.counts * self.counts).sum(1) / 2


_CHOICE = np.zeros((PARTS, PARTS), np.int64)
for _i, (_a, _b) in enumerate(_choices()):
    _CHOICE[_a, _b] = _CHOICE[_b, _a] = _i
for _d in range(PARTS):  # a difference within one part counts in the first choice that has it
    _CHOICE[_d, _d] = _CHOICE[0, _d] if _d else _CHOICE[0, 1]
_PART_OF = np.array([(c + ord("a") if c < 26 else c - 26 + 0xC0) % PARTS for c in range(_LETTERS)])


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows."""
    same = a == b
    return np.where(same.all(1), a.shape[1], same.argmin(1))


def near_pairs(a: Words, b: Words) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of one unit between two lengths (equal or adjacent, a's the
    smaller), each in the first block that holds it, as places in a and b."""
    left, right = [], []
    for r in range(0, len(a.at), PRODUCT_ROWS):
        rows = slice(r, r + PRODUCT_ROWS)
        for c in range(r if a is b else 0, len(b.at), PRODUCT_ROWS):
            cols = slice(c, c + PRODUCT_ROWS)
            gram = a.counts[rows] @ b.counts[cols].T
            gram -= b.half[cols]
            i, j = np.nonzero(gram >= (a.half[rows] - 1)[:, None])  # |a|^2 + |b|^2 - 2ab <= 2
            i, j = i + r, j + c
            keep = (a.unit[i] == b.unit[j]) & (a.choice[i] == b.choice[j])
            if a is b:
                keep &= i < j
            left.append(i[keep])
            right.append(j[keep])
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    found = []
    step = max(1, (1 << 22) // max(_LETTERS, b.length))
    for s in range(0, len(i), step):
        x, y = i[s:s + step], j[s:s + step]
        parts = np.zeros((len(x), PARTS), bool)
        differ = a.counts[x] != b.counts[y]
        for p in range(PARTS):
            parts[:, p] = differ[:, _PART_OF == p].any(1)
        first, last = parts.argmax(1), PARTS - 1 - parts[:, ::-1].argmax(1)
        ok = parts.any(1) & (_CHOICE[first, last] == a.choice[x])
        x, y, n = x[ok], y[ok], a.length
        head = _agree(a.codes[x], b.codes[y][:, :n])
        tail = _agree(a.codes[x][:, ::-1], b.codes[y][:, ::-1][:, :n])
        ok = head + tail >= b.length - 1
        found.append((x[ok], y[ok]))
    if not found:
        return i, j
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class Sums:
    """Number of near words and the best of them, for the words of one product."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n, self.pairs = words, n, []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        if len(x):
            self.pairs += [(x, y), (y, x)]

    def rows(self) -> pa.RecordBatch:
        x, y = ((np.concatenate([p[k] for p in self.pairs]) for k in (0, 1)) if self.pairs
                else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        touched = np.unique(x)
        order = sorted(touched.tolist(), key=lambda w: (-self.n[w], self.words[w]))
        rank = np.zeros(len(self.words), np.int64)
        rank[order] = np.arange(len(order))
        best = np.full(len(self.words), len(order), np.int64)
        np.minimum.at(best, x, rank[y])
        n_near = np.bincount(x, minlength=len(self.words))
        forms = [order[k] for k in best[touched]]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.words[w] for w in touched], pa.string()), pa.array(n_near[touched], pa.int64()),
             pa.array([self.words[w] for w in forms], pa.string()), pa.array(self.n[forms].astype(np.int64), pa.int64())],
            ["word", "n_near", "form", "form_n"])


class Rows:
    """Columns of consecutive rows."""

    def __init__(self, words: list[str], n, unit, side, choice, length):
        self.words, self.n, self.unit, self.side, self.choice, self.length = words, n, unit, side, choice, length

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> "Rows":
        return cls(batch.column("word").to_pylist(), *(batch.column(c).to_numpy() for c in (
            "n", "unit", "side", "choice", "length")))

    def __len__(self) -> int:
        return len(self.words)

    def __getitem__(self, at: slice) -> "Rows":
        return Rows(*(c[at] for c in self._columns()))

    def __add__(self, other: "Rows") -> "Rows":
        return Rows(self.words + other.words, *(np.concatenate(c) for c in zip(self._columns()[1:], other._columns()[1:])))

    def _columns(self) -> tuple:
        return self.words, self.n, self.unit, self.side, self.choice, self.length

    def by_length(self, at: np.ndarray) -> dict[int, Words]:
        length = self.length[at]
        return {int(n): Words(where := at[length == n], [self.words[w] for w in where], self.unit[where],
                              self.choice[where], int(n)) for n in np.unique(length)}


def block_sums(rows: Rows, itself: bool = True) -> pa.RecordBatch:
    """Sums over the near pairs of whole units; pairs of two side-1 words don't
    count, nor (where ``itself`` is false: a tile that has met itself before)
    those of two side-0 words."""
    sums = Sums(rows.words, rows.n)
    left, right = (rows.by_length(np.flatnonzero(rows.side == k)) for k in (0, 1))
    for size, a in left.items():
        for b in ((a, left.get(size + 1)) if itself else ()) + (right.get(size), right.get(size + 1)):
            if b is not None:
                x, y = near_pairs(a, b)
                sums.add(a.at[x], b.at[y])
    return sums.rows()


def multiply(batches: Iterator[pa.RecordBatch], packed: int = PACKED_ROWS, most: int = BLOCK_LETTERS) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit and side: small units share a product; past a large
    unit's tile the rest of the unit goes in pieces."""
    open_unit: Rows | None = None  # rows of the last unit, which may go on
    tile: Rows | None = None  # of the unit that is passing
    for batch in batches:
        rows = Rows.of(batch)
        if tile is not None and len(rows):
            more = len(rows) if rows.unit[-1] == tile.unit[0] else int((rows.unit != tile.unit[0]).argmax())
            if more:
                yield block_sums(tile + rows[:more], itself=False)
            if more == len(rows):
                continue
            rows, tile = rows[more:], None
        if open_unit is not None:
            rows = open_unit + rows
        if not len(rows):
            continue
        starts = np.concatenate([[0], np.flatnonzero(rows.unit[1:] != rows.unit[:-1]) + 1])
        at, last = 0, int(starts[-1])
        while at < last:
            end = int(starts[min(np.searchsorted(starts, at + packed), len(starts) - 1)])
            yield block_sums(rows[at:end])
            at = end
        open_unit = rows[last:]
        if open_unit.side[-1] == 1 and int(open_unit.length.sum()) > 2 * most:
            yield block_sums(open_unit)
            tile, open_unit = open_unit[:int(np.searchsorted(open_unit.side, 1))], None
    if open_unit is not None:
        yield block_sums(open_unit)


def near_words(words: DataFrame, most: int = BLOCK_LETTERS) -> DataFrame:
    """Words with a near word: word, n_near, form (the near word of largest
    count, ties: the smallest) and form_n."""
    spark = words.sparkSession
    bounded_batches(spark)
    dealt = units(materialize(blocks(words), "spelling-blocks"), most)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return multiply(batches, most=most)

    sums = (dealt.repartition(parts, "unit").sortWithinPartitions("unit", "side")
            .mapInArrow(products, "word string, n_near long, form string, form_n long"))
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form").alias("form")))
    return (sums.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus")).alias("form_n")))


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root``: the last word that the forms lead to from each word.  Every
    round doubles the steps taken; counts grow along forms, so there are few."""
    links = materialize(forms.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = materialize(links.join(on, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        links = step.drop("moved")
        if step.filter("moved").limit(1).count() == 0:
            break
    return forms.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, noise: Noise | None = None, least_count: int = LEAST_COUNT, ratio: int = RATIO,
                      most: int = BLOCK_LETTERS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = materialize(vocabulary(docs, noise, least_count), "spelling-words")
    joined = words.join(materialize(near_words(words, most), "spelling-near"), "word", "left")
    holds = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    forms = materialize(joined.select(
        "word", F.when(holds, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(holds, F.col("form_n")).alias("form_n")), "spelling-forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


#: The same rows as DuckDB SQL over ``documents``, noise of ``one_in(97)`` included:
#: crc32 by its table of remainders, near pairs by masking or deleting each place.
SQL = r"""
WITH RECURSIVE rest(k, i, v) AS (
  SELECT k, 0, k FROM range(256) t(k) UNION ALL
  SELECT k, i + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM rest WHERE i < 8),
tab AS (SELECT list(v ORDER BY k) AS t FROM rest WHERE i = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
low AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
               translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
        FROM runs GROUP BY ALL),
bytes AS (SELECT w, n, hex(encode(id || ':' || w)) AS x FROM low WHERE length(w) >= 5),
crc AS (SELECT w, n, xor(list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
                 lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295), 4294967295) AS h FROM bytes, tab),
words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word,
                 n FROM crc),
vocab AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
place AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM vocab),
cut AS (SELECT DISTINCT word, n, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS shorter FROM place),
mask AS (SELECT word, n, substr(word, 1, i::INT) || '_' || substr(word, i::INT + 2) AS masked FROM place),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM mask a JOIN mask b ON a.masked = b.masked AND a.word <> b.word
         UNION SELECT c.word, v.word, v.n FROM cut c JOIN vocab v ON c.shorter = v.word
         UNION SELECT v.word, c.word, c.n FROM cut c JOIN vocab v ON c.shorter = v.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS form, max(m) AS form_n FROM near GROUP BY word),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * v.n THEN form END AS form,
                 CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n FROM vocab v LEFT JOIN best b USING (word)),
walk(word, here, step) AS (SELECT word, word, 0 FROM forms UNION ALL
  SELECT w.word, f.form, step + 1 FROM walk w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
