"""Packed blocks on disk: Parquet folders of many shards, sorted by shard inside their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusblocks.operators.packing import SHARDS_PER_FILE

BLOCKS_SCHEMA = T.StructType([
    T.StructField("shard_id", T.LongType()),
    T.StructField("block_id", T.LongType()),
    T.StructField("local_index", T.LongType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType())),
    T.StructField("split", T.StringType()),
    T.StructField("shard_group", T.LongType()),
])
# Shards in one folder; a file holds ``packing.SHARDS_PER_FILE`` of them.
SHARDS_PER_FOLDER = 1024


def shard_group(shard_id: Column) -> Column:
    """The folder of a shard."""
    return F.call_function("div", shard_id, F.lit(SHARDS_PER_FOLDER))


def shard_name(split, shard_id):
    """``train_00000``: name of a shard in manifests."""
    digits = shard_id.cast("string")
    return F.concat_ws("_", split, F.lpad(digits, F.greatest(F.length(digits), F.lit(5)), F.lit("0")))


def write_shards(blocks: DataFrame, path: str, keep_others: bool = False) -> None:
    """Write blocks by split and folder of shards, rows sorted by shard and ``block_id``.

    The path is replaced, so no shard of an earlier run survives; with ``keep_others``
    only the folders present in ``blocks`` are. Packed blocks are already distributed
    by runs of shards (``shard_run``), so the write adds a sort but no shuffle. Sorted
    shards give every row group a narrow range of them, which readers skip by.
    """
    if "shard_run" not in blocks.columns:
        run = F.call_function("div", F.col("shard_id"), F.lit(SHARDS_PER_FILE))
        blocks = blocks.withColumn("shard_run", run).repartition("split", "shard_run")
    grouped = blocks.withColumn("shard_group", shard_group(F.col("shard_id")))
    (
        grouped.sortWithinPartitions("split", "shard_group", "shard_id", "block_id")
        .select(*[f.name for f in BLOCKS_SCHEMA])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if keep_others else "static")
        .partitionBy("split", "shard_group").parquet(path)
    )


def read_shards(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Blocks of a packed folder, or of one split (other splits are not listed or read).

    A split without any block is refused.
    """
    blocks = spark.read.schema(BLOCKS_SCHEMA).parquet(path)
    if split is not None:
        blocks = blocks.where(F.col("split") == split)
        if blocks.isEmpty():
            raise FileNotFoundError(f"no shards of split {split!r} under {path}")
    return blocks


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Write a manifest as JSON lines, one per shard or split."""
    manifest.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A shard manifest read back: ``(split, shard_id, shard, blocks, seq_len)``."""
    return spark.read.schema(
        "split string, shard_id long, shard string, blocks long, seq_len int"
    ).json(path)
