"""Repairs and conformance (B1, B2, B5, A3 dedup)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from .joins import lookup_join


def repair_postal_code(df: DataFrame, state_value: str, new_value: int = 0,
                       state_col: str = "state", postal_col: str = "postal_code") -> DataFrame:
    """B1: every row of ``state_value`` gets ``postal_col = new_value``.

    An unconditional overwrite for that state (not only where NULL), applied as a
    projection: no table is mutated.
    """
    repaired = F.when(F.col(state_col) == state_value, F.lit(new_value).cast("int")).otherwise(F.col(postal_col))
    return df.withColumn(postal_col, repaired)


def dedup_returns(returns: DataFrame, key: str = "order_id", flag: str = "returned") -> DataFrame:
    """One row per order.  ``max(flag)`` keeps the join to orders from
    fanning out even if an order carries two flag values (decision 4).
    Partial aggregation collapses repeated ids before the shuffle."""
    return returns.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(flag).alias(flag)).select(flag, key)


def with_return_flag(df: DataFrame, returns_dedup: DataFrame, key: str = "order_id",
                     flag: str = "returned", default: str = "No", lines: bool = False) -> DataFrame:
    """B2: left join to deduplicated returns, unmatched orders get ``default``.

    ``lines=True`` when ``df`` holds order lines (a hot order possible): the
    returns are then joined as a written lookup so AQE can split the hot key."""
    r = returns_dedup.select(F.col(key), F.col(flag).alias("__flag"))
    joined = lookup_join(df, r, [key], "left", "returns") if lines else df.join(r, key, "left")
    return joined.withColumn(flag, F.coalesce(F.col("__flag"), F.lit(default))).drop("__flag")


def fit_violation(col: str, declared: str) -> Column:
    """True when a non-NULL value does not fit the declared type.

    varchar(n): longer than n characters; numeric(p,s): not representable (too
    many integer digits); int: not a 32-bit integer; date: not a date.
    """
    c = F.col(col)
    d = declared.lower()
    if d.startswith("varchar("):
        n = int(d[len("varchar("):-1])
        return F.length(c) > n
    if d.startswith("numeric("):
        p, s = (int(x) for x in d[len("numeric("):-1].split(","))
        return c.isNotNull() & F.expr(f"try_cast(`{col}` as decimal({p},{s}))").isNull()
    if d == "int":
        return c.isNotNull() & F.expr(f"try_cast(`{col}` as int)").isNull()
    if d == "date":
        return c.isNotNull() & F.expr(f"try_cast(`{col}` as date)").isNull()
    raise ValueError(f"unknown declared type {declared!r}")


def conform_orders(df: DataFrame) -> DataFrame:
    """Flat orders in the engine types plus ``violations``: the
    comma-separated names of the columns that break the declared model (NOT
    NULL or width) or whose value the engine type can't hold as it is ('' when
    none).  A value out of the type's range becomes NULL and is listed; nothing
    fails and no row is dropped.  The audits J3/J4 count the declared rules."""
    engine = {f.name: F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})") for f in schemas.ORDERS_SCHEMA.fields}
    raw = dict(df.dtypes)
    checks = []
    for name, declared, nullable in schemas.ORDER_COLUMNS:
        bad = fit_violation(name, declared)
        if not nullable:
            bad = bad | F.col(name).isNull()
        if raw[name] != schemas.ORDERS_SCHEMA[name].dataType.simpleString():
            bad = bad | (F.col(name).isNotNull() & F.coalesce(engine[name] != F.col(name), F.lit(True)))
        checks.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)))
    return df.select(*[c.alias(n) for n, c in engine.items()], F.concat_ws(",", *checks).alias("violations"))
