"""Joining many rows to a key-unique lookup (returns per order, match counts,
parent keys).

When the lookup is an aggregate keyed like the join, Spark reuses the
aggregate's hash partitioning and puts no exchange under that side of the
sort-merge join.  AQE's skew handling only splits joins with a plain shuffle
under both sides, so a hot key on the many side would then run in one task.
Writing the lookup once to the shared folder gives the join two plain
shuffles: AQE broadcasts the lookup if its measured size is small, and
otherwise splits a hot key of the many side across tasks (the lookup side of
that key is one row, copied to each split).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import materialize


def lookup_join(df: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left",
                tag: str = "lookup", written: bool = False) -> DataFrame:
    """``df`` joined to a lookup that has at most one row per key
    (``written=True``: the lookup is already a written snapshot)."""
    return df.join(lookup if written else materialize(lookup, tag), list(on), how)
