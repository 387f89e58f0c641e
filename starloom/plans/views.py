"""SQL access: the extract and both models as session temp views.

Users who query the tables with SQL keep doing so through ``spark.sql``:
``orders``, ``people``, ``returns`` and every model table (v1 star, v2
header/detail) are registered under their model names.  Catalyst plans the
SQL exactly as the DataFrame code (same pruning, pushdown and joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .star import StarV1, StarV2


def register_views(spark: SparkSession, orders: DataFrame, people: DataFrame, returns: DataFrame,
                   v1: StarV1 | None = None, v2: StarV2 | None = None) -> list[str]:
    """Register the inputs and the given models as temp views; returns the names."""
    views = {"orders": orders, "people": people, "returns": returns}
    if v1 is not None:
        views.update(v1.tables())
    if v2 is not None:
        views.update(v2.tables())
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
