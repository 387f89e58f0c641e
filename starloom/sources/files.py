"""Readers for the raw extracts (A1-A4).

Every reader takes an explicit schema: no inference pass over the data.  Parquet
is the default; CSV is accepted for the sheets as delivered, in two ways: the
``read_*`` functions fail on the first line that doesn't fit, and ``load_sheet``
keeps every good line and quarantines the others.

A sheet without quoted line breaks is split among tasks by byte ranges; only
where a field may hold a line break (``multi_line``; listings by default) must a
file be read by one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import materialize


def _csv(spark: SparkSession, schema: T.StructType, mode: str, multi_line: bool, header: bool):
    return (spark.read.schema(schema).option("header", header).option("multiLine", multi_line)
            .option("escape", '"').option("mode", mode))


def _read(spark: SparkSession, path: str, schema, fmt: str, multi_line: bool = False) -> DataFrame:
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    if fmt == "csv":
        return _csv(spark, schema, "FAILFAST", multi_line, True).csv(path)
    raise ValueError(f"unsupported format {fmt!r}")


def read_orders(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    """A1: the flat order-line extract, one row per order line."""
    return _read(spark, path, schemas.ORDERS_SCHEMA, fmt, multi_line)


def read_people(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A2: region to manager lookup."""
    return _read(spark, path, schemas.PEOPLE_SCHEMA, fmt)


def read_returns(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A3 (raw): returned-order flags, duplicates included."""
    return _read(spark, path, schemas.RETURNS_SCHEMA, fmt)


def read_listings(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True) -> DataFrame:
    """A4: rental listings; their texts may hold line breaks."""
    return _read(spark, path, schemas.LISTINGS_SCHEMA, fmt, multi_line)


def read_reviews(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    """A4: rental reviews, one row per review."""
    return _read(spark, path, schemas.REVIEWS_SCHEMA, fmt, multi_line)


# --- tolerant loading -------------------------------------------------------------
_BAD, _FILE, _REASON = "_corrupt_record", "_file", "_reason"


@dataclass(frozen=True)
class Loaded:
    """``rows`` in the sheet's schema; ``rejects``: reason, file and line (the text
    as it stands, or the row as JSON where a value is only missing)."""

    rows: DataFrame
    rejects: DataFrame


def load_sheet(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, header: bool = True) -> Loaded:
    """Every line of a CSV sheet, good ones as rows, the others as rejects:
    ``malformed`` (a value that isn't of its type, too few or too many fields) and
    ``missing <columns>`` (no value where the schema needs one).

    The sheet is parsed once, into a written table of both kinds, since a parse
    that is pruned to some columns would not see what is wrong in the others."""
    names = {f.name.lower() for f in schema.fields}
    clash = names & {_BAD, _FILE, _REASON}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are the loader's own")
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + [T.StructField(_BAD, T.StringType(), True)])
    lines = _csv(spark, loose, "PERMISSIVE", multi_line, header).option("columnNameOfCorruptRecord", _BAD).csv(path)
    missing = F.concat_ws(",", *(F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable))
    reason = F.when(F.col(_BAD).isNotNull(), F.lit("malformed")).when(missing != "", F.concat(F.lit("missing "), missing))
    parsed = materialize(lines.select("*", F.col("_metadata.file_path").alias(_FILE)).withColumn(_REASON, reason), "sheet")
    bad = parsed.where(F.col(_REASON).isNotNull())
    as_json = F.to_json(F.struct(*(F.col(f.name) for f in schema.fields)))
    return Loaded(parsed.where(F.col(_REASON).isNull()).select(*(f.name for f in schema.fields)),
                  bad.select(F.col(_REASON).alias("reason"), F.col(_FILE).alias("file"), F.coalesce(_BAD, as_json).alias("line")))
