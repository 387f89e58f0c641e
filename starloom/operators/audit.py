"""Constraint audits (J1-J7): what the source database enforced, re-aimed as
data jobs.  Each audit returns one row per rule; nothing fails the build.

Every rule is a single aggregation (or an anti join) over the audited table;
rules are combined with ``unionByName`` so one action evaluates them all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize_all
from .clean import fit_violation
from .joins import lookup_join

RULE_COLUMNS = ["rule", "table_name", "column_name", "checked_rows", "violations"]


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _total(counts: Column | str) -> Column:
    return F.coalesce(F.sum(counts), F.lit(0))


def _rule(df: DataFrame, rule: str, table: str, column: str, checked, violations) -> DataFrame:
    return df.agg(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                  checked.cast("long").alias("checked_rows"), violations.cast("long").alias("violations"))


def primary_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows whose key is NULL or repeats (rows minus distinct non-NULL keys)."""
    parts = []
    for name, key in keys.items():
        if not key:
            continue
        df = tables[name]
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        not_null = F.lit(True)
        for k in key:
            not_null = not_null & F.col(k).isNotNull()
        parts.append(per_key.agg(
            F.lit("primary_key").alias("rule"), F.lit(name).alias("table_name"),
            F.lit(",".join(key)).alias("column_name"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("checked_rows"),
            F.coalesce(F.sum(F.when(not_null, F.col("n") - 1).otherwise(F.col("n"))), F.lit(0))
            .cast("long").alias("violations")))
    return _union(parts)


def orphans(tables: Mapping[str, DataFrame],
            fks: Sequence[tuple[str, Sequence[str], str, Sequence[str]]]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent.

    The child's rows are counted per foreign key before anything moves, so a hot
    key is combined in the tasks that read it and a key's columns are shuffled
    once a task.  The counts are left-joined to the distinct, tagged parent keys
    (a written lookup): one pass gives the checked rows and the orphans, and the
    join cannot fan out."""
    lookups = materialize_all({
        f"parent_keys_{i}": tables[parent].select(*[F.col(pc).alias(cc) for pc, cc in zip(pcols, cols)])
        .distinct().withColumn("__hit", F.lit(True))
        for i, (child, cols, parent, pcols) in enumerate(fks)})
    parts = []
    for i, (child, cols, parent, pcols) in enumerate(fks):
        c = tables[child].select(*cols)
        for col in cols:
            c = c.where(F.col(col).isNotNull())
        per_key = c.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
        j = lookup_join(per_key, lookups[f"parent_keys_{i}"], cols, "left", written=True)
        parts.append(_rule(j, "foreign_key", child, f"{','.join(cols)}->{parent}", _total("__n"),
                           _total(F.when(F.col("__hit").isNull(), F.col("__n")))))
    return _union(parts)


def declared_columns(df: DataFrame, table: str, columns: Sequence[tuple[str, str, bool]],
                     not_null: bool = True, type_fit: bool = True) -> DataFrame:
    """J3/J4 in one pass: NOT NULL and width/precision fit per declared column."""
    aggs, meta = [], []
    for name, declared, nullable in columns:
        if not_null and not nullable:
            meta.append(("not_null", name))
            aggs.append(F.count_if(F.col(name).isNull()))
        if type_fit:
            meta.append((f"type_fit:{declared}", name))
            aggs.append(F.count_if(F.coalesce(fit_violation(name, declared), F.lit(False))))
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[a.alias(f"__v{i}") for i, a in enumerate(aggs)])
    stack = ", ".join(f"'{r}', '{c}', __v{i}" for i, (r, c) in enumerate(meta))
    return row.select(
        F.expr(f"stack({len(meta)}, {stack}) AS (rule, column_name, violations)"), "__rows"
    ).select(F.col("rule"), F.lit(table).alias("table_name"), "column_name",
             F.col("__rows").cast("long").alias("checked_rows"), F.col("violations").cast("long"))


def declared_tables(tables: Mapping[str, tuple[DataFrame, Sequence[tuple[str, str, bool]]]],
                    not_null: bool = True, type_fit: bool = True) -> DataFrame:
    """J3/J4 for several tables (name -> (table, declared columns)), one scan each."""
    return _union([declared_columns(df, name, columns, not_null, type_fit) for name, (df, columns) in tables.items()])


def functional_dependency(df: DataFrame, key: str, attributes: Sequence[str], table: str) -> DataFrame:
    """Keys with more than one distinct non-NULL value of an attribute.

    min <> max per key replaces COUNT(DISTINCT): a plain partial/final
    aggregate, so a hot key is combined before the shuffle."""
    per_key = df.groupBy(key).agg(*[
        (F.min(a) != F.max(a)).alias(a) for a in attributes])
    aggs = [F.count(F.lit(1)).alias("__keys")] + [F.count_if(F.col(a)).alias(f"__v{i}")
                                                  for i, a in enumerate(attributes)]
    row = per_key.agg(*aggs)
    stack = ", ".join(f"'{a}', __v{i}" for i, a in enumerate(attributes))
    return row.select(F.expr(f"stack({len(attributes)}, {stack}) AS (column_name, violations)"), "__keys").select(
        F.lit("functional_dependency").alias("rule"), F.lit(table).alias("table_name"), "column_name",
        F.col("__keys").cast("long").alias("checked_rows"), F.col("violations").cast("long"))


def join_loss(lines: DataFrame, rules: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Per lookup join (name -> (lookup, its key columns -> columns of the
    lines)), the lines that find no match (lost) and the lines that find more
    than one (multiplied).  Each lookup is reduced to one count per key and
    written; the lines are counted per key too, in a scan of its columns only.  So the
    joins never fan out, a hot key is combined in the tasks that read it, and no
    line is shuffled with columns of another rule.  NULL keys never match, as in
    the model joins."""
    counts = materialize_all({
        name: lookup.groupBy(*[F.col(k).alias(c) for k, c in keys.items()]).agg(F.count(F.lit(1)).alias(f"__m{i}"))
        for i, (name, (lookup, keys)) in enumerate(rules.items())})
    n, parts = F.col("__n"), []
    for i, (name, (_, keys)) in enumerate(rules.items()):
        on, m = list(keys.values()), F.col(f"__m{i}")
        per_key = lines.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
        joined = lookup_join(per_key, counts[name], on, "left", written=True)
        parts.append(joined.agg(
            F.lit(name).alias("join_name"), _total(n).alias("checked_rows"), _total(F.when(m.isNull(), n)).alias("lost"),
            _total(F.when(m > 1, n)).alias("multiplied"), _total(m * n).alias("joined_rows")))
    return _union(parts)


def model_redundancy(models: Mapping[str, tuple[str, DataFrame]], ids_per_row: int = 3) -> DataFrame:
    """Order-level ids each model stores (ship, deliver, customer ids):
    one set per line in the v1 fact, one per order in the v2 header."""
    parts = []
    for model, (table, df) in models.items():
        per_order = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_order.agg(F.lit(model).alias("model"), F.lit(table).alias("table_name"),
                                   F.sum("n").cast("long").alias("row_count"),
                                   (F.sum("n") * ids_per_row).cast("long").alias("order_level_ids"),
                                   F.count(F.lit(1)).alias("distinct_orders")))
    return _union(parts)
