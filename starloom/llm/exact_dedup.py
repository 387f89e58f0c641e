"""Exact dedup as a tree-merge of sorted digest runs (DataFrame operations only).

Runs.  Every input partition is one run: its rows reduced to (digest, best row).
Digests are aligned by range: the leading bits name one of ``segments``, the same
for every run.  A run is sorted by digest and equal digests become one row.

Rounds.  In each round runs 2i and 2i+1 meet and are merged (``fan_in`` runs, if
more are to be merged at once): the segments of either go to one task, which
sorts them together and keeps the smallest (-code points, id) of equal digests.
n runs take ceil(log2(n)) rounds at any size; the last round leaves one run, in
as many tasks as there are segments.  A round moves digests, never texts, and a
digest that many rows share is one row per run from the start.

Verified.  Groups form on SHA-256 together with an independent 64-bit hash and the
byte length at every level, so a collision of one of them can't merge different
texts.

Rows back.  Only digests of two rows or more are joined to the documents.  For
whole rows (``drop_copies``) a bit map of the repeated digests, of a fixed number
of bits, goes to every task: rows whose bit isn't set pass without a shuffle, and
the others (repeated ones, and few by chance) are joined.

Defined cases: null text counts as empty; an empty text is a text like any
other; a null id sorts after all ids; of repeated rows (same id and length)
exactly one stays; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, fresh, materialize

#: Runs that one merge takes together.
FAN_IN = 2
#: Bits of the map of repeated digests, in pieces of 2^15 (the size of Spark's bit maps).
MAP_BITS = 1 << 23
_PIECE = 1 << 15

_KEY = ["digest", "n_bytes", "check"]


def _normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _digests(text: Column) -> list[Column]:
    normal = _normal(text)
    return [F.unhex(F.sha2(normal, 256)).alias("digest"), F.octet_length(normal).alias("n_bytes"),
            F.xxhash64(normal).alias("check"), F.char_length(F.coalesce(text, F.lit(""))).alias("n_cp")]


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document, written once: its run, a row number that is
    unique in the table, digests and length in code points."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *_digests(F.col(text_col)),
                       F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row_no"))
    return materialize(rows, "digest-runs")


def rounds(n_runs: int, fan_in: int = FAN_IN) -> int:
    """Rounds that merge this many runs into one."""
    found = 0
    while n_runs > 1:
        n_runs, found = -(-n_runs // fan_in), found + 1
    return found


def _merged(rows: DataFrame, tasks: int) -> DataFrame:
    """Runs in order, equal digests of a run merged: each segment of a run in one
    task, which sorts it and walks along it."""
    dealt = rows.repartition(tasks, "run", "segment").sortWithinPartitions("run", "segment", *_KEY)
    return dealt.groupBy("run", "segment", *_KEY).agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))


def merge_runs(runs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Merge all runs: one row per digest with its best row and group size.
    Written, so that a join against it gets a plain shuffle on either side."""
    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = 4 * tasks  # several a task, so that tasks get even shares
    lead = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    best = F.struct((-F.col("n_cp")).alias("minus_cp"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")
    n_runs = (runs.agg(F.max("run")).first()[0] or 0) + 1
    level = _merged(runs.select("run", F.shiftright(lead * segments, 32).cast("int").alias("segment"), *_KEY,
                                best.alias("best"), F.lit(1).cast("long").alias("group_size")), tasks)
    for _ in range(rounds(n_runs, fan_in)):
        level = _merged(level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")), tasks)
    return materialize(level.select(*_KEY, F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"),
                                    F.col("best.minus_cp").alias("minus_cp"), "group_size"), "digest-winners")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    runs = digest_runs(docs, id_col, text_col)
    repeated = merge_runs(runs, fan_in).filter("group_size > 1").drop("minus_cp").withColumn("found", F.lit(True))
    alone = F.col("found").isNull()
    return runs.join(materialize(repeated, "digest-repeated"), _KEY, "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row_no") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def _place(check: Column, bits: int) -> Column:
    return F.pmod(check, F.lit(bits))


def repeated_bits(repeated: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """Bit map of the repeated digests: ``piece`` and its bits; at most bits / 2^15
    rows of 4 KB, whatever the number of digests."""
    at = repeated.select(_place(F.col("check"), bits).alias("at"))
    return at.groupBy(F.floor(F.col("at") / _PIECE).cast("int").alias("piece")).agg(
        F.bitmap_construct_agg(F.col("at") % _PIECE).alias("bits"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN,
                bits: int = MAP_BITS) -> DataFrame:
    """The input's rows without copies, all columns as they came.

    Rows that are repeated as a whole all equal their group's best row; such
    groups (only they) are reduced to one row by digest."""
    runs = digest_runs(docs, id_col, text_col)
    winners = merge_runs(runs, fan_in).filter("group_size > 1")
    best = (F.col("n_cp") == -F.col("minus_cp")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    tied = runs.join(winners, _KEY).filter(best).groupBy(*_KEY).count().filter("count > 1")
    winners = materialize(winners.join(tied, _KEY, "left").select(
        *(F.col(k).alias("w_" + k) for k in _KEY), "keep_id", "minus_cp",
        F.col("count").isNotNull().alias("tied")), "digest-kept")

    mine, kept, piece = fresh(docs, "digests"), fresh(docs, "kept"), fresh(docs, "bits")
    at = _place(F.xxhash64(_normal(F.col(text_col))), bits)
    # bounded: MAP_BITS bits in all
    filters = F.broadcast(repeated_bits(winners.withColumnRenamed("w_check", "check"), bits).select(F.struct("*").alias(piece)))
    placed = docs.withColumn(mine, at)
    placed = placed.join(filters, F.floor(F.col(mine) / _PIECE).cast("int") == F.col(piece)["piece"], "left")
    byte = F.conv(F.hex(F.substring(F.col(piece)["bits"], F.floor(F.col(mine) % _PIECE / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.coalesce(F.getbit(byte.cast("long"), (F.col(mine) % 8).cast("int")) == 1, F.lit(False))
    alone = placed.filter(~is_set).drop(mine, piece)

    wide = placed.filter(is_set).drop(piece).withColumn(mine, F.struct(*_digests(F.col(text_col))))
    won = winners.select(F.struct("*").alias(kept))
    joined = wide.join(won, [F.col(mine)[k] == F.col(kept)["w_" + k] for k in _KEY], "left")
    chosen = (F.col(mine)["n_cp"] == -F.col(kept)["minus_cp"]) & F.col(id_col).eqNullSafe(F.col(kept)["keep_id"])
    joined = joined.filter(F.col(kept).isNull() | chosen).withColumn(mine, F.col(mine)["digest"])
    is_tied = F.coalesce(F.col(kept)["tied"], F.lit(False))
    one = joined.filter(~is_tied).unionByName(joined.filter(is_tied).dropDuplicates([mine]))
    return alone.unionByName(one.drop(mine, kept))


#: The same groups as DuckDB SQL over ``documents``.
SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY cp DESC, doc_id NULLS LAST) AS n,
             first_value(doc_id) OVER (PARTITION BY h ORDER BY cp DESC, doc_id NULLS LAST) AS keep_id,
             count(*) OVER (PARTITION BY h) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, n = 1 AS kept, h AS text_sha256 FROM r
"""
