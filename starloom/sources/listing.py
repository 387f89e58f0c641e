"""Identity of the files behind a table.

A snapshot of derived tables is right as long as its inputs are the same files.
The listing is a Spark job over the files' names, lengths and modification times
(their content isn't read), reduced to one row, so it holds for folders of any
number of files on any file system that Spark reaches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, length, modificationTime of every file below the paths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select("path", "length", "modificationTime")


def listing_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Changes whenever a file is added, removed or rewritten.  Independent of the
    order of the listing: two seeded sums over all files, their number and bytes."""
    row = file_listing(spark, paths).agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)),
        *(F.coalesce(F.sum(F.xxhash64(F.lit(seed), "path", "length", "modificationTime").cast("decimal(38,0)")), F.lit(0))
          for seed in (1, 2))).first()
    return "-".join(str(v) for v in row)
