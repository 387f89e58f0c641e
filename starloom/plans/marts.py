"""H4: retail dashboard marts.

Counting per order is done in two aggregation stages (order, then group)
instead of several COUNT DISTINCTs: each stage is a partial + final hash
aggregate, so a group holding a third of the rows is combined map-side and
no Expand multiplies the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum, half_up_div, scaled_decimal
from ..operators.clean import dedup_returns, with_return_flag
from ..operators.joins import lookup_join
from ..schemas import FLAT_COLUMNS


def manager_lookup(people: DataFrame) -> DataFrame:
    """One manager per region, as a sheet lookup returns the first match
    (deterministic: smallest name).  Regions with two managers are reported
    by the join-loss audit, not silently multiplied here."""
    return people.groupBy("region").agg(F.min("person").alias("manager"))


def wide_orders(flat: DataFrame, people: DataFrame, returns: DataFrame) -> DataFrame:
    """Order lines + manager + return flag, one row per line.  The few
    managers are written first: their size is then known when the join is
    planned, and the lines aren't shuffled on the region.  They come last, so
    their names aren't moved with the lines that meet their returns."""
    w = with_return_flag(flat, dedup_returns(returns), lines=True)
    w = lookup_join(w, manager_lookup(people), ["region"], "left", "managers")
    return w.select(*FLAT_COLUMNS, "manager", "returned")


def _per_order(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (wide.groupBy(*keys, "order_id")
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.max((F.col("returned") == "Yes").cast("int")).alias("is_returned"),
                 F.sum("sales").alias("sales"), F.sum("profit").alias("profit")))


def returns_count_by_year(wide: DataFrame) -> DataFrame:
    """Orders and lines, all and returned, per order year."""
    per_order = _per_order(wide, [F.year("order_date").cast("long").alias("year")])
    return (per_order.groupBy("year")
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.sum("is_returned").cast("long").alias("returned_orders"),
                 F.sum("lines").cast("long").alias("lines"),
                 F.sum(F.col("lines") * F.col("is_returned")).cast("long").alias("returned_lines"))
            .orderBy("year"))


def pivot_sales_category_year(flat: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Sales by year (rows) and category (columns).  The columns are an
    explicit list, so the result's schema doesn't depend on the data; sales of
    every category outside it, null included, are in ``other``, and ``total`` is
    the sum of all lines."""
    def sales(of: Column) -> Column:
        return exact_sum(flat, "sales", F.when(of, F.col("sales")))

    listed = F.coalesce(F.col("category").isin(list(categories)), F.lit(False))
    return (flat.groupBy(F.year("order_date").cast("long").alias("year"))
            .agg(*[sales(F.col("category") == c).alias(c) for c in categories],
                 sales(~listed).alias("other"), sales(F.lit(True)).alias("total"))
            .orderBy("year"))


def manager_performance(wide: DataFrame) -> DataFrame:
    """Sales, profit, orders, returned orders and return rate per manager."""
    per_order = _per_order(wide, ["manager"])
    agg = (per_order.groupBy("manager")
           .agg(exact_sum(wide, "sales").alias("sales"), exact_sum(wide, "profit").alias("profit"),
                F.count(F.lit(1)).alias("orders"), F.sum("is_returned").cast("long").alias("returned_orders"),
                F.sum("lines").cast("long").alias("lines")))
    return agg.select(
        "manager", "sales", "profit", "orders", "returned_orders", "lines",
        scaled_decimal(half_up_div("returned_orders * 10000", "orders"), 4, 12).alias("return_rate"))


def sales_dashboard(flat: DataFrame) -> DataFrame:
    """One mart at (year, month, category, segment, region)."""
    return (flat.groupBy(F.year("order_date").cast("long").alias("year"),
                         F.month("order_date").cast("long").alias("month"),
                         "category", "segment", "region")
            .agg(exact_sum(flat, "sales").alias("sales"), exact_sum(flat, "profit").alias("profit"),
                 F.sum("quantity").cast("long").alias("quantity"), F.count(F.lit(1)).alias("lines")))
