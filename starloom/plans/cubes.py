"""Served sales marts (D1-D3, D5, D7-D11, D17, D19, E1): one written at the finest
grain, coarser ones rolled up from it, and a choice of the smallest that covers a
report.

A mart has dimensions and additive measures (sums of sales, profit and quantity,
number of lines; money keeps the scale of its column), so any report that reads
only covered dimensions and sums is the same function over a mart as over the
lines.  Dates are months (their first day): reports by year and month read no
finer date.  Rows of each mart are counted by its write, so choosing reads nothing.

Scale: the lines are read once, by one partial + final aggregate; a hot customer or
category is combined before the shuffle; every coarser mart reads the smallest
written mart that covers it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum
from ..operators.observed import Watched
from ..session import materialize
from .reports import REPORT_COLUMNS, REPORTS

MEASURES = ("sales", "profit", "quantity", "lines")
#: mart -> dimensions; the first is the finest and covers the others.
MARTS: Mapping[str, Sequence[str]] = {
    "sales_cube": ("order_date", "category", "segment", "region", "customer_id"),
    "sales_monthly": ("order_date", "category", "segment", "region"),
    "sales_customers": ("customer_id",),
    "sales_areas": ("category", "region"),
}


def _sums(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    return df.groupBy(*dimensions).agg(
        exact_sum(df, "sales").alias("sales"), exact_sum(df, "profit").alias("profit"),
        F.sum("quantity").cast("long").alias("quantity"), F.sum("lines").alias("lines"))


class SalesMarts:
    def __init__(self, lines: DataFrame, marts: Mapping[str, Sequence[str]] = MARTS):
        """``lines`` have the flat columns."""
        self.dimensions = dict(marts)
        self.tables: dict[str, DataFrame] = {}
        self.rows: dict[str, int] = {}
        months = lines.withColumn("order_date", F.trunc("order_date", "MM")).withColumn("lines", F.lit(1).cast("long"))
        for name, dimensions in self.dimensions.items():
            source = self.choose(dimensions)
            self._write(name, _sums(self.tables[source] if source else months, dimensions))

    def _write(self, name: str, df: DataFrame) -> None:
        watched = Watched([])
        self.tables[name] = materialize(df, name, watch=watched.watch)
        self.rows[name] = watched.rows

    def choose(self, columns: Sequence[str]) -> str | None:
        """The smallest written mart that has all these dimensions and measures."""
        fit = [n for n in self.tables if set(columns) <= {*self.dimensions[n], *MEASURES}]
        return min(fit, key=lambda n: (self.rows[n], n), default=None)

    def covers(self, report: str) -> bool:
        return self.choose(REPORT_COLUMNS[report]) is not None

    def answer(self, report: str) -> DataFrame:
        """A report of the pack from the smallest mart that covers it."""
        mart = self.choose(REPORT_COLUMNS[report])
        if mart is None:
            raise ValueError(f"no mart covers {report}: it reads {REPORT_COLUMNS[report]}")
        return REPORTS[report](self.tables[mart])

    def dashboard(self) -> DataFrame:
        """D19 from the smallest mart with its dimensions."""
        source = self.tables[self.choose(("order_date", "category", "segment", "region"))]
        return _sums(source, ("order_date", "category", "segment", "region")).select(
            F.year("order_date").cast("long").alias("year"), F.month("order_date").cast("long").alias("month"),
            "category", "segment", "region", *MEASURES)
