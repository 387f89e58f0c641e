"""Shared pieces of the training-data operators.

Intermediate tables go through :func:`starloom.session.materialize`, that is to
Parquet below the folder named by ``spark.checkpoint.dir``; nothing here relies
on cached blocks, so a lost executor costs only its running tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize  # noqa: F401  (re-exported for the operators)

#: Arrow batch bounds for every Python operator here.  A batch is the unit of
#: memory in a Python worker: the first bound that is reached closes it.
BATCH_ROWS = 1000
BATCH_BYTES = "4m"

#: Lower-case A-Z and turn every byte that isn't part of a word into a blank.
#: Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: digits, a-z and
#: all non-ASCII code points, whose UTF-8 bytes are all >= 0x80.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))

#: The six characters that count as white space in the contracts.
SPACES = " \t\n\x0b\x0c\r"


def words(text: str | None) -> list[bytes]:
    """Words of one text as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: str = BATCH_BYTES) -> None:
    """Bound the Arrow batches that Python workers get, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def id_crc32(doc_id: Column) -> Column:
    """crc32 of the id written as text; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have (its own columns may clash)."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    return "`" + re.sub("`", "``", name) + "`"
