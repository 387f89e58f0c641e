"""Dense, deterministic surrogate keys (row numbers over a total order).

``row_number() over (order by k)`` with no partition is planned by Spark as a
single-partition exchange: one task sees every row.  The distributed form
here gives the same numbers:

  1. range-partition on the order and sort inside each partition; partition p
     then holds a contiguous slice of the global order;
  2. tag every row with its partition id and ``monotonically_increasing_id``
     (partition id in the upper bits, position in the partition below);
  3. write the tagged rows once to the shared checkpoint folder so both later
     passes see identical rows (range bounds come from sampling);
  4. count rows per partition id: one row per partition, so the running sum
     over it is tiny and its broadcast has a proven bound (number of
     partitions);
  5. key = offset + start of the partition + position inside it + 1.

Only the per-partition count table is ever small enough to sit in one task;
no data row is funnelled anywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import concurrently, materialize

_PID, _MID, _START, _CNT, _GID = "__pid", "__mid", "__start", "__cnt", "__gid"


def _sort_exprs(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def row_number_global(df: DataFrame, order: Sequence[Column | str], out_col: str,
                      offset: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Append ``out_col`` = offset + 1..n following ``order`` (ties: keep order total).

    ``order`` items are column names (ascending, NULLs last) or sort Columns
    such as ``F.col("sales").desc()``.  The order must be total over the rows
    for the numbering to be deterministic.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = _sort_exprs(order)
    tagged = (df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id()))
    tagged = materialize(tagged, "rownum")
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    starts = counts.select(
        _PID,
        (F.sum(_CNT).over(Window.orderBy(_PID)) - F.col(_CNT)).alias(_START))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (tagged.join(F.broadcast(starts), _PID)
            .withColumn(out_col, F.lit(offset + 1).cast("long") + F.col(_START) + local)
            .drop(_PID, _MID, _START))


def dense_key(df: DataFrame, natural_key: Sequence[str], out_col: str, offset: int = 0) -> DataFrame:
    """Distinct natural keys numbered offset+1..offset+n in key order
    (binary string order, NULLs last).  Output: out_col, *natural_key."""
    distinct = df.select(*natural_key).distinct()
    keyed = row_number_global(distinct, list(natural_key), out_col, offset)
    return keyed.select(out_col, *natural_key)


def dense_keys(df: DataFrame, specs: Mapping[str, tuple[Sequence[str], str, int]]) -> dict[str, DataFrame]:
    """Several dense keys from one pass: name -> (natural key, out_col, offset).

    GROUPING SETS computes the distinct values of every natural key in one
    aggregation (one scan, partial aggregation, one shuffle), written once;
    each set is then numbered like ``dense_key``.  Specs may share a natural
    key (e.g. the same ship modes with two offsets)."""
    cols: list[str] = []
    sets: list[list[str]] = []
    for keys, _, _ in specs.values():
        for c in keys:
            if c not in cols:
                cols.append(c)
        if list(keys) not in sets:
            sets.append(list(keys))
    n = len(cols)

    def gid(keys: Sequence[str]) -> int:
        return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in keys)

    snap = materialize(df.groupingSets(sets, *cols).agg(F.grouping_id().alias(_GID)), "keysets")

    def number(keys: Sequence[str], out_col: str, offset: int) -> DataFrame:
        part = snap.where(F.col(_GID) == gid(keys)).select(*keys)
        return row_number_global(part, list(keys), out_col, offset).select(out_col, *keys)

    # the sets are independent: numbered as concurrent jobs
    return dict(zip(specs, concurrently([lambda spec=spec: number(*spec) for spec in specs.values()])))
