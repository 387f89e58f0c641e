"""A5: full refresh of the stored models, seen whole or not at all.

A refresh writes every table of both models into a new generation's folder and
only then appends the generation's manifest, one small file that a single
Spark write commits.  Readers take the tables of the newest manifest.  So a
refresh that fails between two tables leaves the generation before it in place,
readers that have begun keep their files, and rerunning is safe.

The manifest holds each table's place, layout, rows and broken rules (counted by
the writes themselves), and the fingerprint of the input files, so a refresh
over unchanged input can be skipped and one that breaks declared rules refused.

``tables`` registers a generation with the session's catalog under the declared
names: text columns as VARCHAR(n), NOT NULL where declared, other columns in the
engine's types with the declared one as comment, and the buckets of the orders.
Spark doesn't check such declarations of a file table when it is read; the
counts in the manifest say how far they hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import MODEL_V1, MODEL_V2
from .star import DECLARED, StarV1, StarV2, build_all

MANIFEST_SCHEMA = ("generation long, table_name string, place string, buckets int, bucket_by string, row_count long, "
                   "not_null_violations long, type_fit_violations long, source string, run string")
_WRITTEN_AS = {name: written for written, names in DECLARED.items() for name in names}


class RefusedRefresh(Exception):
    """The new generation breaks declared rules and isn't published."""


class ModelStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- generations -----------------------------------------------------------
    def manifest(self) -> DataFrame:
        """One row per table of every published generation.  Of two refreshes that
        ran at once and took the same number, the later name counts."""
        try:
            rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        first = F.max("run").over(Window.partitionBy("generation"))
        return rows.withColumn("_first", first).where("run = _first").drop("_first")

    def generation(self) -> int | None:
        """Number of the newest published generation."""
        return self.manifest().agg(F.max("generation")).first()[0]

    def refresh(self, flat: DataFrame, people: DataFrame, returns: DataFrame, repair_state: str,
                source: str | None = None, enforce: bool = False, by_order: bool = False) -> int:
        """Write both models and publish them; the generation's number.

        ``source``: a fingerprint of the inputs; if it is that of the newest
        generation, that one stays and nothing is written.  ``enforce``: rows
        that break a declared rule refuse the refresh.  ``by_order``: see ``StarV1``."""
        last = self.generation()
        if source is not None and last is not None and self._rows(last)[0].source == source:
            return last
        number, run = (last or 0) + 1, uuid.uuid4().hex
        folder = f"{self.path}/data/{number:08d}-{run}"
        v1 = StarV1(flat, people, returns, repair_state, folder=folder, by_order=by_order)
        v2 = StarV2.alongside(v1)
        build_all(v1, v2)
        rows = []
        for name in {**v1.tables(), **v2.tables()}:
            model = v1 if name in MODEL_V1 else v2
            watched, written = model.watched[name], _WRITTEN_AS[name]
            broken = {rule: sum(v for r, _, _, _, v in watched.rules(name) if r.startswith(rule)) for rule in ("not_null", "type_fit")}
            keys = model.layout(written)
            rows.append((number, name, f"{folder}/{written}", model.buckets if keys else 0, ",".join(keys), watched.rows,
                         broken["not_null"], broken["type_fit"], source, run))
        if enforce and any(r[6] or r[7] for r in rows):
            raise RefusedRefresh(", ".join(f"{r[1]}: {r[6]} nulls, {r[7]} misfits" for r in rows if r[6] or r[7]))
        self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return number

    def _rows(self, number: int) -> list:
        return self.manifest().where(F.col("generation") == number).orderBy("table_name").collect()

    # -- reading ---------------------------------------------------------------
    def tables(self, number: int | None = None) -> dict[str, DataFrame]:
        """The tables of a generation (default: the newest), as typed catalog tables."""
        number = number or self.generation()
        if number is None:
            return {}
        return {row.table_name: self.spark.table(self._register(row)) for row in self._rows(number)}

    def _register(self, row) -> str:
        name = f"{row.table_name}__{row.run}"
        if not self.spark.catalog.tableExists(name):
            declared = {**MODEL_V1, **MODEL_V2}[row.table_name]["columns"]
            engine = dict(self.spark.read.parquet(row.place).dtypes)
            columns = ", ".join(_column(c, kind, nullable, engine[c]) for c, kind, nullable in declared)
            buckets = f" CLUSTERED BY ({row.bucket_by}) SORTED BY ({row.bucket_by}) INTO {row.buckets} BUCKETS" if row.buckets else ""
            place = row.place.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{buckets} LOCATION '{place}'")
        return name

    def counts(self) -> DataFrame:
        """One row per table of the newest generation: its rows as read back, as
        the write counted them, and the declared rules that rows break."""
        number = self.generation()
        read = _union([df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
                       for name, df in self.tables(number).items()])
        kept = self.manifest().where(F.col("generation") == number).select(
            "table_name", F.col("row_count").alias("written_rows"), "not_null_violations", "type_fit_violations")
        return read.join(kept, "table_name")

    # -- upkeep ------------------------------------------------------------------
    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the folders of all but the newest ``keep`` generations and of
        refreshes that were never published.  Not while a refresh runs."""
        kept = {r.place.rpartition("/")[0].rpartition("/")[2] for r in self.manifest().select("generation", "place").distinct()
                .orderBy(F.col("generation").desc()).collect()
                if r.generation > (self.generation() or 0) - keep}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for status in (fs.listStatus(root) if fs.exists(root) else []):
            if status.getPath().getName() not in kept:
                fs.delete(status.getPath(), True)
                gone.append(status.getPath().getName())
        return gone


def _column(name: str, declared: str, nullable: bool, engine: str) -> str:
    kind = declared if declared.startswith("varchar") and engine == "string" else engine
    return f"`{name}` {kind}{'' if nullable else ' NOT NULL'} COMMENT '{declared}'"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
