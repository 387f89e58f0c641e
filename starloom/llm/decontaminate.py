"""Benchmark decontamination over suffix arrays of the training text.

Every Arrow batch of documents is cut into shards of at most ``SHARD_WORDS``
words (a longer document is a shard of its own).  A shard gets a suffix array
over its words, built by prefix doubling on packed 64-bit keys until the order
is settled to the length of the longest test item.  Every suffix of every test
item is then binary-searched in every shard, one word deeper at a time for all
suffixes together; this gives its longest verbatim match, the places of that
match, and the places of its window.  Shards share nothing, so documents never
move, no group can be hot, and a lost executor only repeats its own batches.

The test set goes to the tasks in blocks of about ``BLOCK_BYTES`` of text: one
block for usual benchmarks.  A larger test set is written as a table that knows
the block of each item; the documents are written too, numbered, and scanned by
one job a block, whose results are written.  Only one block at a time is on the
driver and in a task, and it exceeds the bound by less than one item, since items
aren't cut.  The results of all passes then meet per document.

Words are compared exactly (a shard numbers its own distinct words), never by
hash.

Defined cases: null and wordless texts have no words, so they neither hit nor
are hit; an item of fewer words than the window is one window; equal windows of
several items count for each of them; a null item id is written as the empty
string; repeated rows get equal results; extra columns of ``docs`` stay as they
are, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, fresh, materialize, words

WINDOW = 10
SHARD_WORDS = 1 << 19
BLOCK_BYTES = 4 << 20
#: Places of longest matches that are looked at together.
PLACES = 1 << 20

_MATCH = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("item_word", T.LongType()),
                       T.StructField("doc_word", T.LongType()), T.StructField("n_words", T.LongType())])
_RANGE = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(_RANGE)),
                       T.StructField("items", T.ArrayType(T.StringType())), T.StructField("matches", T.ArrayType(_MATCH))])


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``symbols`` (>= 0) in the order of their suffixes' first
    ``depth`` symbols at least; equal ones by position."""
    n = len(symbols)
    bits = max(1, int(n).bit_length())
    rank, step = symbols.astype(np.int64) + 1, 1
    top = int(rank.max(initial=0))
    if top > n:  # dense ranks, so that two of them and a position fit a key
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1
    place = np.arange(n, dtype=np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:max(0, n - step)] = rank[step:]
        if 3 * bits + 2 <= 63:
            packed = ((rank << (bits + 1) | after) << bits) | place
            packed.sort()
            order, key = packed & ((1 << bits) - 1), packed >> bits
        else:
            order = np.lexsort((after, rank))
            key = rank[order] * (n + 2) + after[order]
        step *= 2
        fresh_rank = np.concatenate(([1], 1 + np.cumsum(key[1:] != key[:-1])))[:n]
        if step >= depth or n == 0 or fresh_rank[-1] == n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = fresh_rank


class TestSet:
    """Suffixes and windows of one block of test items."""

    __test__ = False  # not a pytest class

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids = [i for i, w in items if w]
        self.texts = [w for _, w in items if w]
        self.depth = max((len(w) for w in self.texts), default=0)
        self.item = np.array([k for k, w in enumerate(self.texts) for _ in w], np.int64)
        self.start = np.array([j for w in self.texts for j in range(len(w))], np.int64)
        self.left = np.array([len(w) - j for w in self.texts for j in range(len(w))], np.int64)
        #: Length of the window that starts at each suffix; 0: none does.
        whole = np.array([len(w) for w in self.texts], np.int64)[self.item] if self.texts else np.zeros(0, np.int64)
        self.window = np.where(whole < window, np.where(self.start == 0, whole, 0), np.where(self.left >= window, window, 0))


class Shard:
    """Suffix array over the words of some documents."""

    def __init__(self, docs: list[list[bytes]], depth: int):
        number: dict[bytes, int] = defaultdict(count(1).__next__)
        sizes = np.array([len(d) + 1 for d in docs], np.int64)
        self.ends = np.cumsum(sizes)  # a separator, symbol 0, ends every document
        self.begins = self.ends - sizes
        self.symbols = np.zeros(int(self.ends[-1]) if len(docs) else 0, np.int64)
        for b, d in zip(self.begins.tolist(), docs):
            self.symbols[b:b + len(d)] = np.fromiter(map(number.__getitem__, d), np.int64, len(d))
        self.number = dict(number)
        self.array = suffix_array(self.symbols, depth)

    def _bound(self, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, word: np.ndarray, after: bool) -> np.ndarray:
        """First place in [lo, hi) whose symbol at depth ``at`` is >= (after: >) word."""
        lo, hi = lo.copy(), hi.copy()
        n = len(self.symbols)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            place = self.array[mid] + at[open_]
            seen = np.where(place < n, self.symbols[np.minimum(place, n - 1)], -1)
            right = seen <= word[open_] if after else seen < word[open_]
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]

    def search(self, test: TestSet):
        """Of every test suffix: the length of its longest match, the range of
        its places in the array, and the range of its window's places."""
        words_of = [np.fromiter((self.number.get(w, -1) for w in t), np.int64, len(t)) for t in test.texts]
        flat = np.concatenate(words_of) if words_of else np.zeros(0, np.int64)
        n = len(flat)
        lo, hi = np.zeros(n, np.int64), np.full(n, len(self.array), np.int64)
        length = np.zeros(n, np.int64)
        w_lo, w_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live, depth = np.arange(n), 0
        while len(live):
            live = live[(test.left[live] > depth)]
            live = live[flat[live + depth] > 0]
            at, word = np.full(len(live), depth, np.int64), flat[live + depth]
            a = self._bound(lo[live], hi[live], at, word, False)
            b = self._bound(a, hi[live], at, word, True)
            found = a < b
            live, a, b = live[found], a[found], b[found]
            depth += 1
            lo[live], hi[live], length[live] = a, b, depth
            full = live[test.window[live] == depth]
            w_lo[full], w_hi[full] = lo[full], hi[full]
        return length, lo, hi, w_lo, w_hi


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each range and the values in it, for all ranges together."""
    sizes = hi - lo
    owner = np.repeat(np.arange(len(lo)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo, sizes)


def _merged(places: np.ndarray, sizes: np.ndarray) -> list[dict]:
    """The union of word ranges as disjoint ranges."""
    order = np.argsort(places, kind="stable")
    s, e = places[order], np.maximum.accumulate((places + sizes)[order])
    head = np.concatenate(([True], s[1:] > e[:-1]))
    last = np.concatenate((np.flatnonzero(head)[1:] - 1, [len(s) - 1]))
    return [{"first": a, "end": b} for a, b in zip(s[head].tolist(), e[last].tolist())]


def scan(docs: list[list[bytes]], test: TestSet, matches: bool = True) -> list[dict]:
    """One result per document of a shard; without ``matches`` their list stays empty."""
    out = [{"n_words": len(d), "hits": [], "items": [], "matches": []} for d in docs]
    if not test.texts or not any(docs):
        return out
    shard = Shard(docs, test.depth)
    length, lo, hi, w_lo, w_hi = shard.search(test)
    _windows(out, shard, test, w_lo, w_hi)
    if matches:
        _longest(out, shard, test, length, lo, hi)
    return out


def _windows(out: list[dict], shard: Shard, test: TestSet, w_lo: np.ndarray, w_hi: np.ndarray) -> None:
    """Hits and items of each document.  Equal windows have one range of places,
    and ranges of one window length are disjoint: each is opened once, however
    often its words repeat within and among items."""
    occurs = np.flatnonzero(w_lo < w_hi)
    if not len(occurs):
        return
    ranges, of_range = np.unique(np.stack([w_lo[occurs], w_hi[occurs], test.window[occurs]]), axis=1, return_inverse=True)
    pairs = np.unique(np.stack([of_range.ravel(), test.item[occurs]]), axis=1)
    items_of = np.split(pairs[1], np.flatnonzero(np.diff(pairs[0])) + 1)

    owner, place = _ranges(ranges[0], ranges[1])
    place = shard.array[place]
    doc = np.searchsorted(shard.ends, place, side="right")
    order = np.argsort(doc, kind="stable")
    owner, place, doc = owner[order], place[order], doc[order]
    for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1):
        d = int(doc[part[0]])
        out[d]["hits"] = _merged(place[part] - shard.begins[d], ranges[2][owner[part]])
        out[d]["items"] = sorted({test.ids[i] for r in np.unique(owner[part]) for i in items_of[r].tolist()})


def _longest(out: list[dict], shard: Shard, test: TestSet, length: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
    """Longest matches: those that no match one word earlier in the same item
    extends.  Suffixes are opened some ``PLACES`` places at a time."""
    long_ = np.flatnonzero((length >= test.window) & (test.window > 0) & (lo < hi))
    number, start = shard.number, 0
    sizes = np.cumsum(hi[long_] - lo[long_])
    while start < len(long_):
        end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + PLACES, "right")))
        some, start = long_[start:end], end
        owner, place = _ranges(lo[some], hi[some])
        suffix, place = some[owner], shard.array[place]
        ahead = shard.symbols[np.maximum(place - 1, 0)] * (place > 0)
        head = np.array([number.get(test.texts[test.item[s]][test.start[s] - 1], -1) if test.start[s] else -1 for s in some.tolist()],
                        np.int64)[owner]
        alone = head != ahead  # symbol 0, an item's or document's begin, extends nothing
        for s, p in zip(suffix[alone].tolist(), place[alone].tolist()):
            d = int(np.searchsorted(shard.ends, p, side="right"))
            out[d]["matches"].append({"item_id": test.ids[test.item[s]], "item_word": int(test.start[s]),
                                      "doc_word": p - int(shard.begins[d]), "n_words": int(length[s])})


def _scan_batch(texts: list[str | None], test: TestSet, shard_words: int, matches: bool = True) -> list[dict]:
    out, docs, n = [], [], 0
    for t in texts:
        w = words(t)
        if docs and n + len(w) > shard_words:
            out += scan(docs, test, matches)
            docs, n = [], 0
        docs.append(w)
        n += len(w) + 1
    return out + scan(docs, test, matches) if docs else out


def _scanner(items: list[tuple[str, list[bytes]]], window: int, shard_words: int, matches: bool) -> Callable[[Column], Column]:
    def scan_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        test = TestSet(items, window)
        kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string())),
                          ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int64()),
                                                          ("doc_word", pa.int64()), ("n_words", pa.int64())])))])
        for texts in batches:
            yield pa.array(_scan_batch(texts.to_pylist(), test, shard_words, matches), kind)

    return F.arrow_udf(scan_texts, RESULT)


def _pieces(benchmark: DataFrame, block_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """The test items with a place (part, piece): items of equal place are at most
    ``block_bytes``, the last one aside."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, size = 0, 0
        for batch in batches:
            sizes, pieces = [sum(map(len, words(t))) + 64 for t in batch.column(2).to_pylist()], []
            for s in sizes:
                if size >= block_bytes:
                    piece, size = piece + 1, 0
                size += s
                pieces.append(piece)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64()), pa.array(sizes, pa.int64())],
                                             names=["part", "item_id", "text", "piece", "size"])

    items = benchmark.select(F.spark_partition_id().alias("part"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"),
                             F.col(text_col).alias("text"))
    return items.mapInArrow(cut, "part int, item_id string, text string, piece long, size long")


def test_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "item_id",
                text_col: str = "text") -> list[DataFrame]:
    """The test items (item_id, text) in blocks of bounded size, as parts of a written table."""
    bounded_batches(benchmark.sparkSession)
    items = materialize(_pieces(benchmark, block_bytes, id_col, text_col), "test-items")
    blocks, size = [], block_bytes
    # a row a partition and a row a block, no texts
    for r in items.groupBy("part", "piece").agg(F.sum("size").alias("size")).orderBy("part", "piece").collect():
        if size + r["size"] > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((r["part"], r["piece"]))
        size += r["size"]
    found = []
    for places in blocks:  # neighbours in order of place
        place, first, last = F.struct("part", "piece"), places[0], places[-1]
        found.append(items.filter((place >= F.struct(F.lit(first[0]).alias("part"), F.lit(first[1]).cast("long").alias("piece"))) & (
            place <= F.struct(F.lit(last[0]).alias("part"), F.lit(last[1]).cast("long").alias("piece")))).select("item_id", "text"))
    return found


test_blocks.__test__ = False


def _items(block: DataFrame) -> list[tuple[str, list[bytes]]]:
    return [(r["item_id"], words(r["text"])) for r in block.toLocalIterator()]


def with_matches(docs: DataFrame, benchmark: DataFrame, into: str, window: int = WINDOW, text_col: str = "text",
                 shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES, matches: bool = True) -> DataFrame:
    """``docs`` with a column ``into``: an array with the RESULT of the first test
    block, and of each further block that has a hit or match in the document.
    Longest matches are looked for and returned only where ``matches`` says so."""
    bounded_batches(docs.sparkSession)
    blocks = test_blocks(benchmark, block_bytes)
    if len(blocks) < 2:
        items = _items(blocks[0]) if blocks else []
        return docs.withColumn(into, F.array(_scanner(items, window, shard_words, matches)(F.col(text_col))))
    row = fresh(docs, "row")
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "scan-documents")
    passes = None
    for k, block in enumerate(blocks):
        found = docs.select(F.col(row).alias("row"), F.lit(k).alias("block"),
                            _scanner(_items(block), window, shard_words, matches)(F.col(text_col)).alias("result"))
        if k:
            found = found.filter((F.size("result.hits") > 0) | (F.size("result.matches") > 0))
        found = materialize(found, "scan-block")
        passes = found if passes is None else passes.unionByName(found)
    merged = passes.groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("block", "result"))).alias(into))
    merged = merged.select(row, F.transform(into, lambda x: x["result"]).alias(into))
    return docs.join(merged, row).drop(row)


def _covered(ranges: Column) -> Column:
    """Words in the union of ranges (those of several test blocks may overlap)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(F.array_sort(ranges), start, lambda acc, r: F.struct(
        (acc["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(r["first"], acc["upto"]))).alias("n"),
        F.greatest(acc["upto"], r["end"]).alias("upto")), lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **bounds) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, matches (longest verbatim matches and their locations)."""
    found = with_matches(docs.select("doc_id", "text"), benchmark, "found", window, **bounds)

    def all_blocks(name: str) -> Column:
        return F.flatten(F.transform("found", lambda x: x[name]))

    out = found.select("doc_id", F.element_at("found", 1)["n_words"].alias("n_words"), all_blocks("hits").alias("hits"),
                       F.array_sort(F.array_distinct(all_blocks("items"))).alias("items"),
                       all_blocks("matches").alias("matches"))
    return out.select("doc_id", "n_words", _covered(F.col("hits")).alias("n_hit"),
                      F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.size("hits") > 0).alias("contaminated"), "matches")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                      **bounds) -> DataFrame:
    """The documents without a window of any test item, all columns as they came."""
    found = fresh(docs, "found")
    scanned = with_matches(docs, benchmark, found, window, text_col, matches=False, **bounds)
    return scanned.filter(~F.exists(found, lambda x: F.size(x["hits"]) > 0)).drop(found)


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

#: The same result (without match locations) as DuckDB SQL over ``documents`` and ``benchmark``.
SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[j:j + least(len(w), {WINDOW}) - 1], ' ') AS win
       FROM i, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS t(j) WHERE len(w) > 0),
dw AS (SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS win
       FROM d, (SELECT DISTINCT n FROM iw) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(p)),
h AS (SELECT DISTINCT r, p, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM h, unnest(range(p, p + n)) AS t(q) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
