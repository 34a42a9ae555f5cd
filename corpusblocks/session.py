"""Shared storage for intermediate tables, and joins against small lookup tables."""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only when it is known to hold at most this many
# rows; beyond that the join shuffles with salted keys.
BROADCAST_ROWS = 1_000_000
SALTS = 16

# Whether shuffle files go when the job that wrote them has ended (from Spark 4.1), not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written = threading.local()


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors: ``spark.checkpoint.dir``, else the warehouse.

    A warehouse on a local disk serves a local master only.
    """
    conf = spark.sparkContext.getConf()
    configured = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = warehouse.startswith("file:") or "://" not in warehouse
    if local and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return warehouse.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/corpusblocks-{spark.sparkContext.applicationId}"


def _tables() -> list[str]:
    """Paths that `materialize` has written in this thread and that are still there."""
    if not hasattr(_written, "paths"):
        _written.paths = []
    return _written.paths


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tidy(make: Callable) -> Callable:
    """Of the tables that ``make`` materializes only those stay that the DataFrames it returns, one or a tuple, read."""

    @wraps(make)
    def run(*args, **kwargs):
        tables = _tables()
        start = len(tables)
        made = make(*args, **kwargs)
        frames = made if isinstance(made, tuple) else (made,)
        files = [file for frame in frames for file in frame.inputFiles()]
        # The name of a table's folder is its own, whatever the scheme of the path.
        read = {path for path in tables[start:] if any(f"{_folder(path)}/" in file for file in files)}
        for path in tables[start:]:
            if path not in read:
                _delete(frames[0].sparkSession, path.rsplit("/", 1)[0])
        tables[start:] = [path for path in tables[start:] if path in read]
        return made

    return run


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` has written; nothing can read it any more."""
    files, tables = table.inputFiles(), _tables()
    for path in [path for path in tables if any(f"{_folder(path)}/" in file for file in files)]:
        _delete(table.sparkSession, path.rsplit("/", 1)[0])
        tables.remove(path)


def _folder(path: str) -> str:
    """The folder of a scratch table, a random number."""
    return path.rsplit("/", 2)[1]


def release(spark: SparkSession, kept: bool = False) -> None:
    """Delete what this application has written to the scratch folder; results read from it end, too.

    With ``kept``, also what ``kept_path`` holds.
    """
    for folder in [_application_folder(spark), *([f"{_application_folder(spark)}-kept"] if kept else [])]:
        _delete(spark, folder)
    _tables().clear()


def kept_path(spark: SparkSession, source: DataFrame, name: str) -> str:
    """A path for what is made of the files of ``source`` once and used by many jobs of this application.

    Files that are written again lie under another path: names and times of the files are part of it.
    """
    files = source.select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    key = hashlib.md5(repr(sorted(map(tuple, files))).encode()).hexdigest()
    return f"{_application_folder(spark)}-kept/{key}/{name}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root, in a folder of the running application.

    Tables stay until ``release`` or the end of a ``tidy`` function, since results read them lazily.
    """
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}/{name}"


def task_count(spark: SparkSession) -> int:
    """Number of tasks that keeps the whole cluster busy."""
    cores = spark.sparkContext.defaultParallelism
    if spark.sparkContext.master.startswith("local"):
        return cores
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), cores)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Distribute by ``keys`` a table that is stored in fewer pieces than there are cores.

    Tables of many files pass through untouched: no shuffle is added at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def materialize(df: DataFrame, name: str, by: list[str] | tuple = ()) -> DataFrame:
    """Write ``df`` once to shared storage, in folders ``by`` some columns, and read it back.

    Unlike a cache the result survives the loss of executors, and unlike
    ``checkpoint`` it is computed once and stays columnar, so later readers
    prune columns and push filters down.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    cleanup = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, cleanup)
    _tables().append(path)
    return spark.read.schema(df.schema).parquet(path)


def holds_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; stops counting beyond the bound."""
    return df.limit(rows + 1).count() <= rows


def join_lookup(
    left: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Join a large table with a lookup table that has one row per key.

    A lookup within ``max_rows`` (checked, unless the caller vouches for it with
    ``bounded``) is broadcast. A larger one is joined by a shuffle in which every
    key is spread over ``SALTS`` tasks, so a key holding a large share of
    ``left`` does not end in one task. Equal rows share a salt: aggregate copies
    before joining. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if bounded or holds_at_most(lookup, max_rows):
        return left.join(F.broadcast(lookup), on, how)
    # The salt has to depend on the row alone, so that a task that is run again
    # sends its rows to the same place.
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    salted = left.withColumn("_salt", F.pmod(row_hash, F.lit(SALTS)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, on + ["_salt"], how).drop("_salt")
