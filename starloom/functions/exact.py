"""Exact rounding helpers.

Means and ratios are rounded half away from zero on the exact rational value,
computed with integral ``div`` on decimal(38,0) operands.  This avoids the
double rounding of Spark's ``avg(decimal)`` (rounded to scale s+4 first) and
gives the same answer as any engine that rounds the true quotient, whatever
its own decimal or float rules are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def half_up_div(num: str, den: str) -> Column:
    """round_half_away_from_zero(num / den) as bigint; NULL when den <= 0 or NULL.

    ``num`` and ``den`` are SQL expressions over integral values; they are
    cast to decimal(38,0), so sums far beyond bigint are safe.  The quotient
    itself must fit in bigint (means and ratios here are small); ``div``
    would wrap silently, so a larger quotient raises an error instead.
    """
    n = f"CAST(({num}) AS DECIMAL(38,0))"
    d = f"CAST(({den}) AS DECIMAL(38,0))"
    return F.expr(
        f"CASE WHEN {d} > 0 THEN "
        f"CASE WHEN abs({n}) / {d} >= 4000000000000000000 "
        f"THEN raise_error('half_up_div: quotient does not fit in bigint') "
        f"WHEN {n} < 0 THEN -((2 * -{n} + {d}) div (2 * {d})) "
        f"ELSE (2 * {n} + {d}) div (2 * {d}) END END"
    )


def scaled_decimal(units: Column, scale: int, precision: int = 38) -> Column:
    """Turn an integral count of 10^-scale units into decimal(precision, scale)."""
    return (units.cast(f"decimal({precision},0)") / F.lit(10 ** scale).cast("decimal(38,0)")).cast(
        f"decimal({precision},{scale})")


def percent_label(value: Column, scale: int) -> Column:
    """'<value>%' from a decimal with a fixed scale; NULL value gives '%'."""
    text = value.cast(f"decimal(38,{scale})").cast("string")
    return F.concat_ws("", text, F.lit("%"))


def exact_sum(df: DataFrame, name: str, of: Column | None = None) -> Column:
    """The unrounded sum of a decimal column (or of ``of``, a choice of its
    values), in the column's own scale."""
    kind = df.schema[name].dataType
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    return F.sum(F.col(name) if of is None else of).cast(f"decimal(38,{scale})")


def whole_units(name: str, scale: int) -> str:
    """SQL for a decimal column of that scale as a whole number of 10^-scale
    units, exact over all 38 digits (a product would have to shrink its scale)."""
    text = f"cast(cast({name} as decimal(38,{scale})) as string)"
    return f"cast(replace({text}, '.', '') as decimal(38,0))"


def money(col: Column | str, scale: int = 2) -> Column:
    """A money amount in the report precision: decimal(38, scale)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(f"decimal(38,{scale})")
