"""Session construction and reliable materialisation.

Lineage is cut by writing Parquet under the shared folder named by
``spark.checkpoint.dir``.  The folder is read from the session; only a local
master (tests, bench) gets a private scratch folder when none is set.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
_CKPT_KEY = "spark.checkpoint.dir"
CODEC = "zstd"  # of everything written here: ids and keys as text take a third less than with snappy


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "starloom", driver_memory: str = "8g") -> SparkSession:
    """Session with the settings every job here assumes (AQE on, UTC, no UI)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates.

    Order of precedence: the SparkContext's checkpoint dir, then the session
    setting ``spark.checkpoint.dir``.  Only a local master may fall back to a
    private scratch folder; a cluster without the setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get(_CKPT_KEY, None)
    if not configured and sc is not None:
        configured = sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/object store) reachable by every executor")
        configured = _LOCAL_SCRATCH.setdefault("dir", tempfile.mkdtemp(prefix="starloom-ckpt-"))
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_LOCAL_SCRATCH: dict[str, str] = {}


def materialize(df: DataFrame, tag: str, folder: str | None = None, partition_by: Sequence[str] = (),
                bucket_by: Sequence[str] = (), watch: Callable[[DataFrame], DataFrame] | None = None,
                path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Used where several consumers read one expensive intermediate (the repaired
    staging table of a star build) and where two passes must see identical
    rows (dense keys).  Parquet keeps column pruning for the consumers, and the
    files outlive any executor.

    ``folder``: a folder of the caller's instead (the table's own is ``tag`` in it); ``path``: the table's own folder.
    ``partition_by``: one subfolder per value, pruned by a filter on the column.
    ``bucket_by``: hashed into ``spark.sql.shuffle.partitions`` buckets, one sorted
    file each, so joins on these columns need no exchange; the table is then known
    to the session's catalog, which keeps the layout.  Rows that come hashed so
    already aren't moved again.
    ``watch`` is applied last, in the stage that writes: metrics observed there
    count every row once, however often an earlier stage is run again.
    """
    spark = df.sparkSession
    path = path or os.path.join(folder, tag) if path or folder else os.path.join(checkpoint_dir(spark), "starloom", f"{tag}-{uuid.uuid4().hex}")
    if bucket_by:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(buckets, *bucket_by)
        name = f"starloom_{uuid.uuid4().hex}_{tag}"
        writer = (watch(df) if watch else df).write.mode("overwrite").option("path", path).option("compression", CODEC)
        with _bucket_by_bucket(spark):
            writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by).saveAsTable(name, format="parquet",
                                                                                partitionBy=list(partition_by) or None)
        _BUCKETED.setdefault(id(spark), []).append(name)
        return spark.table(name)
    (watch(df) if watch else df).write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=CODEC)
    return spark.read.parquet(path)


_AUTO_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
_HOLDS: dict[int, list] = {}  # session -> number of writes that hold the setting, value before the first
_HOLDS_LOCK = threading.Lock()


@contextmanager
def _bucket_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Bucketed tables are read bucket by bucket meanwhile, also where no join or
    grouping asks for it: rows made of a table in its own buckets then make one
    file a bucket.  Writes may overlap; the last one puts the setting back."""
    with _HOLDS_LOCK:
        hold = _HOLDS.setdefault(id(spark), [0, spark.conf.get(_AUTO_SCAN)])
        hold[0] += 1
        spark.conf.set(_AUTO_SCAN, "false")
    try:
        yield
    finally:
        with _HOLDS_LOCK:
            hold[0] -= 1
            if not hold[0]:
                spark.conf.set(_AUTO_SCAN, _HOLDS.pop(id(spark))[1])


# Catalog names of bucketed intermediates by session; ``release`` drops them.
_BUCKETED: dict[int, list[str]] = {}


def concurrently(jobs: Sequence[Callable[[], T]], max_workers: int = 8) -> list[T]:
    """Results of independent pieces of driver work that submit Spark jobs."""
    with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(jobs)))) as pool:
        return list(pool.map(lambda job: job(), jobs))


def materialize_all(frames: dict[str, DataFrame], max_workers: int = 8) -> dict[str, DataFrame]:
    """``materialize`` several independent frames as concurrent Spark jobs
    (submitted from driver threads; the cluster schedules their tasks)."""
    written = concurrently([lambda k=k, v=v: materialize(v, k) for k, v in frames.items()], max_workers)
    return dict(zip(frames, written))


def shared(spark: SparkSession, key: tuple, build: Callable[[], T]) -> T:
    """What ``build()`` gives, built once per session and key (a model that many
    queries read); ``release`` forgets it together with its files."""
    at = (id(spark), *key)
    if at not in _SHARED:
        _SHARED[at] = (spark, build())
    return _SHARED[at][1]


# The session is kept beside the value, so its id can't come to name another one.
_SHARED: dict[tuple, tuple] = {}


def release(spark: SparkSession) -> None:
    """Remove this application's materialised intermediates once nothing reads
    them any more (end of a batch run), on any file system that Spark reaches.
    Only the application's own subfolder of the checkpoint folder is touched."""
    _SHARED.clear()
    for name in _BUCKETED.pop(id(spark), []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        sc = spark.sparkContext
        per_app = sc.getCheckpointDir()  # Spark's per-application subfolder
    except Exception:  # noqa: BLE001 - no SparkContext: the folder may be shared, keep it
        return
    if not per_app:
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(os.path.join(per_app, "starloom"))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
