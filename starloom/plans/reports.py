"""H3: the report pack (D1-D11, E1) over any frame with the flat columns.

The same functions run on the raw flat table and on the flattened v1 / v2
models; results must agree.  Every aggregate is partial + final (map-side
combine), money stays decimal, and the rounded outputs are cast to
decimal(38, s) so that every consumer sees one type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum, half_up_div, money, percent_label, scaled_decimal, whole_units
from ..operators.keys import row_number_global


def total_sales(df: DataFrame) -> DataFrame:
    """round(sum(sales))."""
    return df.agg(money(F.round(F.sum("sales"), 0), 0).alias("total_sales"))


def total_profit(df: DataFrame) -> DataFrame:
    """round(sum(profit))."""
    return df.agg(money(F.round(F.sum("profit"), 0), 0).alias("total_profit"))


def profit_ratio(df: DataFrame) -> DataFrame:
    """sum(profit)/sum(sales)*100 rounded half-up to 3 digits, value and
    label.  Exact for any scale of the two columns: thousandths of a percent are
    round(P * 10^5 / S) over whole units of each column's own scale.  Empty
    input: NULL and '%'."""
    sums = df.agg(exact_sum(df, "profit").alias("p"), exact_sum(df, "sales").alias("s"))
    p, s = (sums.schema[c].dataType.scale for c in ("p", "s"))
    shift = 5 + s - p
    q = half_up_div(f"{whole_units('p', p)} * {10 ** max(0, shift)}", f"{whole_units('s', s)} * {10 ** max(0, -shift)}")
    value = scaled_decimal(q, 3, 12)
    return sums.select(percent_label(value, 3).alias("ratio"), value.alias("ratio_pct"))


def profit_per_order(df: DataFrame) -> DataFrame:
    """Profit per order, 2 digits, largest first."""
    return (df.groupBy("order_id").agg(money(F.round(F.sum("profit"), 2)).alias("profit"))
            .orderBy(F.col("profit").desc(), "order_id"))


def sales_per_customer(df: DataFrame) -> DataFrame:
    """Sum of sales per customer id."""
    return (df.groupBy("customer_id").agg(exact_sum(df, "sales").alias("total_sales"))
            .orderBy(F.col("total_sales").desc(), "customer_id"))


def avg_discount(df: DataFrame) -> DataFrame:
    """Mean discount per line rounded half-up to 2 digits, times 100.
    Exact on hundredths: q = round(sum(discount*100) / count)."""
    sums = df.agg((F.sum(F.col("discount") * 100)).alias("s"), F.count("discount").alias("n"))
    value = half_up_div("s", "n").cast("decimal(12,2)")
    return sums.select(percent_label(value, 2).alias("average_discount"),
                       value.alias("average_discount_pct"))


def _monthly(df: DataFrame, dim: str) -> DataFrame:
    return (df.groupBy(F.year("order_date").cast("long").alias("year"),
                       F.month("order_date").cast("long").alias("month"), dim)
            .agg(exact_sum(df, "sales").alias("total_sales"))
            .orderBy("year", "month", dim))


def monthly_sales_by_segment(df: DataFrame) -> DataFrame:
    """D7."""
    return _monthly(df, "segment")


def monthly_sales_by_category(df: DataFrame) -> DataFrame:
    """D8."""
    return _monthly(df, "category")


def sales_by_category(df: DataFrame) -> DataFrame:
    """D9."""
    return df.groupBy("category").agg(money(F.round(F.sum("sales"), 2)).alias("total_sales_over_time"))


def sales_profit_by_customer(df: DataFrame) -> DataFrame:
    """Two sums per customer, ordered by profit then sales (desc)."""
    return (df.groupBy("customer_id")
            .agg(exact_sum(df, "sales").alias("sales"), exact_sum(df, "profit").alias("profit"))
            .orderBy(F.col("profit").desc(), F.col("sales").desc(), "customer_id"))


def customer_ranking(df: DataFrame) -> DataFrame:
    """Rank customers by unrounded total sales (desc), ties by customer id.

    Numbered by ranges at every size: no task sees all customers."""
    per_customer = df.groupBy("customer_id").agg(F.sum("sales").alias("__sales"))
    ranked = row_number_global(per_customer, [F.col("__sales").desc_nulls_last(), F.col("customer_id").asc()], "rank")
    return ranked.select("rank", "customer_id", money(F.round("__sales", 2)).alias("sales"))


def sales_by_region(df: DataFrame) -> DataFrame:
    """Sales per region, ascending."""
    return (df.groupBy("region").agg(money(F.round(F.sum("sales"), 2)).alias("sales"))
            .orderBy("sales", "region"))


REPORTS = {
    "total_sales": total_sales,
    "total_profit": total_profit,
    "profit_ratio": profit_ratio,
    "profit_per_order": profit_per_order,
    "sales_per_customer": sales_per_customer,
    "avg_discount": avg_discount,
    "monthly_sales_by_segment": monthly_sales_by_segment,
    "monthly_sales_by_category": monthly_sales_by_category,
    "sales_by_category": sales_by_category,
    "sales_profit_by_customer": sales_profit_by_customer,
    "customer_ranking": customer_ranking,
    "sales_by_region": sales_by_region,
}

# columns each report reads: a model view joins only the dimensions behind them
REPORT_COLUMNS = {
    "total_sales": ["sales"],
    "total_profit": ["profit"],
    "profit_ratio": ["profit", "sales"],
    "profit_per_order": ["order_id", "profit"],
    "sales_per_customer": ["customer_id", "sales"],
    "avg_discount": ["discount"],
    "monthly_sales_by_segment": ["order_date", "segment", "sales"],
    "monthly_sales_by_category": ["order_date", "category", "sales"],
    "sales_by_category": ["category", "sales"],
    "sales_profit_by_customer": ["customer_id", "sales", "profit"],
    "customer_ranking": ["customer_id", "sales"],
    "sales_by_region": ["region", "sales"],
}
