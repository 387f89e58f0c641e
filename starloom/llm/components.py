"""Connected components of an edge table, by alternating large-star and
small-star steps.  Every step is a group-by and an equi join on narrow rows
whose sides are written tables, so Spark can split the rows of a hub; the number
of edges never grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _least(edges: DataFrame) -> DataFrame:
    return materialize(edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")), "cc-least")


def _state(edges: DataFrame) -> tuple:
    # differences of ids reach 2^63, and their sum passes it after a few edges: 38 digits hold 10^18 edges
    apart = F.col("u").cast("decimal(28,0)") - F.col("v").cast("decimal(28,0)")
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(apart)).first())


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (longs; order and repeats don't matter). Returns node, root
    for every node that isn't the smallest of its component."""
    now = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        # large star: larger neighbours of u point to the least of u and its neighbours
        large = both.filter("v > u").join(least, F.col("u") == F.col("c"))
        large = materialize(large.select(F.col("v").alias("u"), F.least("c", "m").alias("v")).distinct(), "cc-large")
        # small star: u and its smaller neighbours point to the least of them
        least = _least(large)
        small = large.join(least, F.col("u") == F.col("c")).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct(), "cc-edges")
        state, before = _state(now), state
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
