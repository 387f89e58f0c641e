"""N-gram Jaccard self-join with Bayesian candidate pruning.

Two documents are linked when the Jaccard similarity of their sets of word
5-grams is at least the threshold.  Classes are the connected components of the
links.

1. Equal texts become one node; the node keeps how many rows it stands for.
2. A node gets ``BANDS`` x ``ROWS`` MinHash values.  Nodes that agree on a band
   share a bucket.  A pair at similarity s shares none with probability
   (1 - s ** ROWS) ** BANDS: 1.0e-11 at 0.8, and the pair is lost only then.
3. Pairs of buckets of at most ``SMALL`` nodes are compared on their MinHash
   values, ``STEP`` at a time.  After m values with k matches, the similarity
   has a Beta(k + 1, m - k + 1) posterior under a flat prior; the pair is
   dropped once P(similarity >= threshold) < ``TOLERANCE``.  A larger bucket
   doesn't emit pairs; its nodes are tied to its smallest node.
   Components of these edges with more than ``BLOCK`` nodes, which ties of merely
   alike pages can bring, are pruned in the same way before any text moves: their
   MinHash values alone meet in blocks of ``SIGNATURES`` nodes, a block pair returns
   the edges of a forest over the pairs that survive, and the components of these
   edges take the large ones' place.
4. What is left falls into components.  A component's nodes
   meet in blocks of about ``BLOCK`` nodes and ``BLOCK_GRAMS`` n-grams: within a block pair, all pairs go through
   the same incremental pruning, and the rest are verified exactly on their
   n-gram sets.  A block pair returns a row a node (rows linked to it, smallest
   node reached), never pairs.  Every pair that step 3 left lies in one
   component, so each is verified, and each exactly once.
5. Links are summed per node; components of the links are the classes.

Scale: buckets of one node, nearly all of them, vanish in a group-by of counts;
pairs per bucket row are at most SMALL / 2; a group of n near copies costs n *
n / 2 comparisons of MinHash values in blocks, n * n / BLOCK rows moved, and no
task holds more than two blocks, bounded in nodes and in bytes.  Texts move once,
to the blocks; of equal texts only one does.

Defined cases: null counts as empty; a text without words has no n-grams and is
linked to nothing, not even its copies; a text of fewer than five words, but not
none, is one n-gram; equal texts are linked; a null id is never a class id
unless the whole class has null ids; rows repeated as a whole are copies of each
other; extra columns are not read, or pass through where rows are filtered.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, fresh, materialize, words
from .components import components

N = 5
THRESHOLD = 0.8
BANDS, ROWS = 48, 4
TOLERANCE = 1e-9
STEP = 16
SMALL = 64
#: Nodes and n-grams of a block (a node with more is a block by itself and what chance adds).
BLOCK = 512
BLOCK_GRAMS = 1 << 21
#: Nodes of a block of MinHash values (two bytes each).
SIGNATURES = 4096
SEED = 7


_RNG = np.random.default_rng(SEED)
#: The MinHash family: odd factors and offsets of 32-bit multiplicative hashes.
_FACTORS = _RNG.integers(0, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


class _Hashes(dict):
    """64-bit hashes of words, made once per distinct word of a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingles(text: str | None, hashes: dict | None = None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    hashes = _Hashes() if hashes is None else hashes
    h = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i]
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return np.unique(out)


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values of a set, 16 bits each; every four of them are a band's key."""
    least = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    h = (grams >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(h), 256):
        least = np.minimum(least, (h[i:i + 256, None] * _FACTORS + _OFFSETS).min(0))
    return ((least * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For m = STEP, 2 STEP, ...: the fewest matches with which
    P(similarity >= threshold) = P(Binomial(m + 1, threshold) <= matches) reaches the tolerance."""
    found = []
    for m in range(STEP, BANDS * ROWS + 1, STEP):
        total, k = 0.0, 0
        while True:
            total += comb(m + 1, k) * threshold ** k * (1 - threshold) ** (m + 1 - k)
            if total >= tolerance:
                break
            k += 1
        found.append(k)
    return tuple(found)


def survivors(sig_a: np.ndarray, sig_b: np.ndarray, i: np.ndarray, j: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Which of the pairs (i, j) of rows of two signature tables survive the
    incremental comparison; ``least``: see least_matches."""
    live, matches = np.arange(len(i)), np.zeros(len(i), np.int64)
    for step, fewest in enumerate(least):
        if not len(live):
            break
        part = slice(step * STEP, (step + 1) * STEP)
        kept = []
        for c in range(0, len(live), 1 << 16):
            at = live[c:c + (1 << 16)]
            matches[at] += (sig_a[i[at], part] == sig_b[j[at], part]).sum(1)
            kept.append(at[matches[at] >= fewest])
        live = np.concatenate(kept)
    return live


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, key of the text, n-grams, MinHash values (four to a long)."""
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _Hashes()
        kind = pa.struct([("n", pa.int32()), ("sig", pa.list_(pa.int64()))])
        for texts in batches:
            out = []
            for t in texts.to_pylist():
                g = shingles(t, hashes)
                out.append({"n": len(g), "sig": signature(g).view(np.int64) if len(g) else []})
            yield pa.array(out, kind)

    kind = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("sig", T.ArrayType(T.LongType()))])
    signed = F.arrow_udf(sign, kind)(F.col("text"))
    rows = docs.select("doc_id", _key(F.col("text")).alias("key"), signed.alias("s")).select("doc_id", "key", "s.*")
    return materialize(rows, "join-signed")


def _key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _candidates(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges u, v: pairs that the pruning left, and ties within large buckets."""
    bands = nodes.filter("n > 0").select("node", F.posexplode("sig").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "node")
    sizes = materialize(bands.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("first")).filter("size > 1"), "join-buckets")
    members = materialize(bands.join(sizes, "bucket"), "join-members")
    ties = members.filter((F.col("size") > SMALL) & (F.col("node") != F.col("first"))).select(
        F.col("node").alias("u"), F.col("first").alias("v"))

    groups = members.filter(F.col("size") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list("node")).alias("nodes"))
    groups = groups.select("nodes").distinct()
    pairs = groups.select(F.explode(F.flatten(F.transform("nodes", lambda x, i: F.transform(
        F.slice("nodes", i + 2, F.size("nodes")), lambda y: F.struct(x.alias("u"), y.alias("v")))))).alias("p"))
    pairs = pairs.select("p.u", "p.v").distinct()

    least = least_matches(threshold, tolerance)

    def prune(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            sig = [x.values.to_numpy()[x.offsets[0].as_py():x.offsets[-1].as_py()].view(np.uint16).reshape(-1, BANDS * ROWS)
                   for x in (a, b)]
            all_ = np.arange(len(a))
            keep = np.zeros(len(a), bool)
            keep[survivors(*sig, all_, all_, least)] = True
            yield pa.array(keep)

    a = nodes.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("sig").alias("sig_u"))
    b = nodes.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("sig").alias("sig_v"))
    compared = pairs.join(a, "u").join(b, "v").filter(F.least("n_u", "n_v") >= threshold * F.greatest("n_u", "n_v"))
    left = compared.filter(F.arrow_udf(prune, T.BooleanType())("sig_u", "sig_v"))
    return materialize(left.select("u", "v").unionByName(ties), "join-candidates")


class _Forest:
    """Smallest reachable row of each row."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def link_block(grams_a: list[np.ndarray], grams_b: list[np.ndarray], sig_a: np.ndarray, sig_b: np.ndarray, same: bool,
               threshold: float, least: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """(row of a, its linked rows of b) for a block pair; only b > a if they are the same block."""
    n_b = np.array([len(g) for g in grams_b], np.int64)
    flat = np.concatenate(grams_b) if grams_b else np.zeros(0, np.uint64)
    known, local = np.unique(flat, return_inverse=True)
    ends = np.cumsum(n_b)
    for i, g in enumerate(grams_a):
        j = np.arange(i + 1 if same else 0, len(grams_b))
        j = j[np.minimum(n_b[j], len(g)) >= threshold * np.maximum(n_b[j], len(g))]
        j = j[survivors(sig_a, sig_b, np.full(len(j), i), j, least)]
        if not len(j):
            continue
        at = np.searchsorted(known, g)
        at = at[at < len(known)][known[at[at < len(known)]] == g[at < len(known)]]
        mark = np.zeros(len(known) + 1, np.int64)
        mark[at] = 1
        rows = np.concatenate([local[ends[x] - n_b[x]:ends[x]] for x in j])
        cuts = np.cumsum(n_b[j]) - n_b[j]
        both = np.add.reduceat(mark[rows], cuts)
        hit = j[both / (len(g) + n_b[j] - both) >= threshold]
        if len(hit):
            yield i, hit


def _pruned(nodes: DataFrame, roots: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Components of more than ``BLOCK`` nodes fall apart into those of the pairs that
    the pruning leaves; smaller ones stay."""
    least = least_matches(threshold, tolerance)
    both = materialize(_with_roots(roots), "join-tied")
    sizes = materialize(both.groupBy("root").agg(F.count("*").alias("size")).filter(F.col("size") > BLOCK), "join-large")
    blocks = F.ceil(F.col("size") / SIGNATURES).cast("int")
    placed = both.join(sizes, "root").select("node", F.col("root").alias("comp"), blocks.alias("blocks"),
                                             F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    dealt = _dealt(placed.join(nodes.select("node", "n", "sig"), "node"), "n", "sig")

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), part in group.groupby(["comp", "i", "j"], sort=False):
            part = part.sort_values("node", ignore_index=True)
            sig = np.vstack([np.asarray(x, np.int64).view(np.uint16) for x in part["sig"]])
            node, block, n = part["node"].to_numpy(), part["block"].to_numpy(), part["n"].to_numpy()
            rows_a, rows_b = np.flatnonzero(block == i), np.flatnonzero(block == j)
            root = np.arange(len(part))
            for k, x in enumerate(rows_a):
                y = rows_b[k + 1:] if i == j else rows_b
                # rows that are tied already need no comparison, so a group of near copies costs few
                y = y[(root[y] != root[x]) & (np.minimum(n[y], n[x]) >= threshold * np.maximum(n[y], n[x]))]
                met = np.unique(root[y[survivors(sig, sig, np.full(len(y), x), y, least)]])
                if len(met):
                    tied = np.isin(root, met) | (root == root[x])
                    root[tied] = min(met[0], root[x])
            out.append(pd.DataFrame({"u": node, "v": node[root]})[root != np.arange(len(part))])
        return pd.concat(out)

    edges = dealt.withColumn("task", F.xxhash64("comp", "i", "j")).groupBy("task").applyInPandas(forest, "u long, v long")
    left = components(materialize(edges, "join-pruned"))
    return roots.join(sizes, "root", "left_anti").select("node", "root").unionByName(left.select("node", "root"))


def _with_roots(roots: DataFrame) -> DataFrame:
    """Components with a row for their root as well."""
    return roots.select("node", "root").unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _dealt(placed: DataFrame, *columns: str) -> DataFrame:
    """Nodes of a block, dealt to all pairs i <= j with the blocks of their component."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.select("node", "comp", "blocks", "block", *columns, other.alias("other"))
    return dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))


def _verify(threshold: float, tolerance: float):
    least = least_matches(threshold, tolerance)

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), part in group.groupby(["comp", "i", "j"], sort=False):
            part = part.drop_duplicates("node").sort_values("node", ignore_index=True)
            grams = [np.frombuffer(x, np.uint64) for x in part["grams"]]
            sig = np.vstack([np.frombuffer(x, np.uint16) for x in part["sig"]])
            copies, node, block = part["copies"].to_numpy(), part["node"].to_numpy(), part["block"].to_numpy()
            links, forest = np.zeros(len(part), np.int64), _Forest(len(part))
            rows_a, rows_b = np.flatnonzero(block == i), np.flatnonzero(block == j)
            for x, hit in link_block([grams[k] for k in rows_a], [grams[k] for k in rows_b], sig[rows_a], sig[rows_b],
                                     i == j, threshold, least):
                x, hit = rows_a[x], rows_b[hit]
                links[x] += copies[hit].sum()
                links[hit] += copies[x]
                for y in hit.tolist():
                    forest.join(int(x), y)
            roots = np.array([forest.root(k) for k in range(len(part))], np.int64)
            out.append(pd.DataFrame({"node": node, "links": links, "root": node[roots]}))
        return pd.concat(out)

    return verify


def _blocks(docs: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The components' nodes with their n-grams, dealt to block pairs."""
    both = materialize(_with_roots(roots).join(nodes.select("node", "n"), "node"), "join-grouped")
    sizes = materialize(both.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").cast("long").alias("grams")), "join-sizes")
    total = sizes.agg(F.sum(F.greatest(F.col("size") / BLOCK, F.col("grams") / BLOCK_GRAMS))).first()[0] or 0
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("grams") / BLOCK_GRAMS)).cast("int")
    placed = both.join(sizes, "root").select("node", F.col("root").alias("comp"), blocks.alias("blocks"),
                                             F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    placed = materialize(placed.join(nodes.select("node", "key", "rep", "copies"), "node"), "join-placed")

    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _Hashes()
        kind = pa.struct([("grams", pa.binary()), ("sig", pa.binary())])
        for texts in batches:
            grams = [shingles(t, hashes) for t in texts.to_pylist()]
            yield pa.array([{"grams": g.tobytes(), "sig": signature(g).tobytes()} for g in grams], kind)

    kind = T.StructType([T.StructField("grams", T.BinaryType()), T.StructField("sig", T.BinaryType())])
    texts = docs.select(F.col("doc_id"), _key(F.col("text")).alias("key"), "text")
    # both sides grow with the input: one plan at every size, and the texts move once
    # by id as well: of a text's copies only the one that stands for them meets anything
    mine = placed.withColumnRenamed("key", "node_key").hint("merge")
    found = texts.join(mine, (F.col("key") == F.col("node_key")) & F.col("doc_id").eqNullSafe(F.col("rep"))).withColumn(
        "made", F.arrow_udf(make, kind)(F.col("text")))
    dealt = _dealt(found.select("*", "made.grams", "made.sig"), "copies", "grams", "sig")
    bins = max(1, int(total))
    return dealt.withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(bins)))
                            .otherwise(F.xxhash64("comp", "i", "j")))


def join_classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes). rows: doc_id, key of every input row. nodes, one per
    distinct text: key, rep (smallest id), copies, n, links (rows of other
    texts linked to it), class_node, class_id."""
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows = _signed(docs)
    nodes = materialize(rows.groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()), "join-nodes")
    roots = _pruned(nodes, components(_candidates(nodes, threshold, tolerance)), threshold, tolerance)
    verified = _blocks(docs, nodes, roots).groupBy("task").applyInPandas(
        _verify(threshold, tolerance), "node long, links long, root long")
    verified = materialize(verified, "join-verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.select(F.col("node").alias("u"), F.col("root").alias("v")))
    labelled = nodes.drop("sig").join(links, "node", "left").join(classes, "node", "left").select(
        "key", "node", "rep", "copies", "n", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("root", "node").alias("class_node"))
    labelled = materialize(labelled, "join-labelled")
    ids = materialize(labelled.groupBy("class_node").agg(F.min("rep").alias("class_id")), "join-classes")
    return rows, materialize(labelled.join(ids, "class_node"), "join-result")


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class),
    n_links (other rows at or above the threshold), n_grams."""
    rows, nodes = join_classes(docs, threshold, tolerance)
    found = rows.select("doc_id", "key").join(nodes, "key")
    return found.select("doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                        F.when(F.col("n") > 0, F.col("copies") - 1 + F.col("links")).otherwise(0).cast("long").alias("n_links"),
                        F.col("n").cast("long").alias("n_grams"))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One document of each class, the one with the smallest id, all columns as
    they came; documents without words all stay."""
    _, nodes = join_classes(docs, threshold, tolerance)
    key, kept = fresh(docs, "key"), fresh(docs, "kept")
    best = nodes.filter(F.col("rep").eqNullSafe(F.col("class_id")) | (F.col("n") == 0))
    # one node of a class, should several rows share the smallest id
    one = best.filter("n > 0").groupBy("class_node").agg(F.min("node").alias("node"))
    keep = best.filter("n = 0").select("key", "rep", "n", "copies").unionByName(
        best.join(one, ["class_node", "node"]).select("key", "rep", "n", "copies"))
    keep = materialize(keep.select(F.struct("*").alias(kept)), "join-kept")
    joined = docs.withColumn(key, _key(F.col("text"))).join(keep, F.col(key) == F.col(kept)["key"])
    joined = joined.filter((F.col(kept)["n"] == 0) | F.col("doc_id").eqNullSafe(F.col(kept)["rep"]))
    several = (F.col(kept)["n"] > 0) & (F.col(kept)["copies"] > 1)
    return joined.filter(~several).unionByName(joined.filter(several).dropDuplicates([key])).drop(key, kept)


#: The join's rows as DuckDB SQL over ``documents``.
SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[p:p + least(len(w), {N}) - 1], ' ') AS gram
      FROM d, unnest(range(1, len(w) - least(len(w), {N}) + 2)) AS t(p) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
b AS (SELECT x.r AS a, y.r AS b, count(*) AS shared FROM g AS x JOIN g AS y ON x.gram = y.gram AND x.r < y.r GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM b JOIN n AS x ON x.r = a JOIN n AS y ON y.r = b WHERE shared / (x.n + y.n - shared) >= {THRESHOLD}),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c(r, m) AS (SELECT r, r FROM n UNION SELECT c.r, e.b FROM c JOIN e ON e.a = c.m),
k AS (SELECT c.r, min(doc_id) AS class_id FROM c JOIN d ON d.r = c.m GROUP BY c.r),
s AS (SELECT a AS r, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, CASE WHEN n.n > 0 THEN class_id ELSE doc_id END AS class_id, coalesce(n_links, 0)::BIGINT AS n_links,
       coalesce(n.n, 0)::BIGINT AS n_grams
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r) LEFT JOIN s USING (r)
"""
