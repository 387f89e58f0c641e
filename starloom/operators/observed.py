"""Declared rules counted while a table is written.

``DataFrame.observe`` collects the counts in the very pass that writes the rows,
so NOT NULL and width audits of a written table cost no scan of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import fit_violation

RULES_SCHEMA = "rule string, table_name string, column_name string, checked_rows long, violations long"
Declared = Sequence[tuple[str, str, bool]]
_WHOLE = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"  # holds for every text that can be cast to int


def broken_rules(columns: Declared) -> list[tuple[str, str, Column]]:
    """(rule, column, breach) of every NOT NULL and type rule."""
    rules = [("not_null", name, F.col(name).isNull()) for name, _, nullable in columns if not nullable]
    return rules + [(f"type_fit:{declared}", name, F.coalesce(fit_violation(name, declared), F.lit(False)))
                    for name, declared, _ in columns]


def _breach(df: DataFrame, rule: str, name: str, declared: str, breach: Column) -> Column | None:
    """The cheapest form of a breach for the type that the column has; None if no
    value of that type can break the rule, so nothing is counted."""
    field_ = df.schema[name]
    kind = field_.dataType
    if rule == "not_null":
        return breach if field_.nullable else None
    if declared == kind.simpleString():
        return None
    if declared.startswith("varchar(") and isinstance(kind, T.StringType):
        most = int(declared[len("varchar("):-1])
        return (F.octet_length(name) > most) & breach  # bytes are counted already, characters aren't
    if declared == "int" and isinstance(kind, T.StringType):
        return ~F.col(name).rlike(_WHOLE) | breach  # a failing cast throws inside: slower than all other rules together
    if declared.startswith("numeric(") and isinstance(kind, T.DecimalType):
        p, s = (int(x) for x in declared[len("numeric("):-1].split(","))
        if kind.scale <= s:  # nothing is rounded: only whole digits can be too many
            return None if kind.precision - kind.scale <= p - s else F.abs(F.col(name)) >= F.lit(Decimal(10) ** (p - s))
    return breach


@dataclass
class Watched:
    """Counts of one write.  ``watch`` goes to the write; ``rows`` and
    ``violations`` hold once it has ended."""

    columns: Declared
    extra: dict[str, Column] = field(default_factory=dict)
    keep: Sequence[str] | None = None

    def __post_init__(self) -> None:
        self._rules = broken_rules(self.columns)
        self._observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        declared = {name: kind for name, kind, _ in self.columns}
        counts = [F.count_if(found).alias(f"v{i}") for i, (rule, name, breach) in enumerate(self._rules)
                  if (found := _breach(df, rule, name, declared[name], breach)) is not None]
        seen = df.observe(self._observation, F.count(F.lit(1)).alias("rows"), *counts,
                          *(of.alias(name) for name, of in self.extra.items()))
        return seen.select(*self.keep) if self.keep is not None else seen

    def metric(self, name: str) -> int:
        return self._observation.get.get(name) or 0  # no row was written: nothing was counted

    @property
    def rows(self) -> int:
        return self.metric("rows")

    def rules(self, table: str) -> list[tuple[str, str, str, int, int]]:
        """Rows of the audits for this table: rule, table, column, checked rows, violations."""
        return [(rule, table, column, self.rows, self.metric(f"v{i}")) for i, (rule, column, _) in enumerate(self._rules)]


def rule_rows(spark: SparkSession, tables: dict[str, Watched], wanted: Callable[[str], bool]) -> DataFrame:
    """The audits of written tables as a frame: one row per wanted rule."""
    rows = [r for name, watched in tables.items() for r in watched.rules(name) if wanted(r[0])]
    return spark.createDataFrame(rows, RULES_SCHEMA)
