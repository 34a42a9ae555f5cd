"""Seeded shuffling and batching of blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusblocks.functions.seeded import sort_key
from corpusblocks.operators.prefix import Order, dense_levels, exclusive_prefix, hashed_levels
from corpusblocks.session import join_lookup

# Default token budget of a batch and default seed.
TARGET_BATCH_TOKENS = 8192
SEED = 42


def batch_size(seq_len: int, target_tokens: int = TARGET_BATCH_TOKENS, size: int | None = None) -> int:
    """Blocks per batch: ``size`` when given and not 0, else what fits the token budget."""
    return size or max(1, target_tokens // seq_len)


def batch_size_of(seq_len: Column, target_tokens: int = TARGET_BATCH_TOKENS) -> Column:
    """Blocks per batch that fit the token budget, for a column of block lengths."""
    return F.greatest(F.lit(1), F.call_function("div", F.lit(target_tokens), seq_len)).cast("bigint")


def shuffled_positions(blocks: DataFrame, seed: int = SEED, epoch: int = 0, shuffle: bool = True) -> DataFrame:
    """``(split, block_id, position)``: place of every block in the order of an epoch.

    The order sorts by a hash of seed, epoch and block, so it is the same on any
    cluster and differs between epochs. Only block ids are read and shuffled.
    """
    keys = blocks.select("split", "block_id")
    if shuffle:
        keys = keys.withColumn("_key", sort_key(seed, F.lit(epoch), F.col("block_id")))
        levels = hashed_levels("_key", keys.count())
        order = Order(("split",), ("_key", "block_id"), levels)
    else:
        order = Order(("split",), ("block_id",), dense_levels(keys, "block_id"))
    placed = exclusive_prefix(keys, order, F.lit(1).cast("bigint"), "position")
    return placed.select("split", "block_id", "position")


def batch_plan(
    blocks: DataFrame,
    size: int,
    *,
    epoch: int = 0,
    seed: int = SEED,
    shuffle: bool = True,
    drop_last: bool = True,
    splits: Sequence[str] | None = None,
    max_batches: int | None = None,
) -> DataFrame:
    """``(split, epoch, batch_no, slot, block_id)`` for all splits at once.

    ``drop_last`` leaves out a batch that is not full; ``max_batches`` keeps the
    first batches of each split.
    """
    if splits is not None:
        blocks = blocks.where(F.col("split").isin(*splits))
    placed = shuffled_positions(blocks, seed, epoch, shuffle)
    plan = placed.select(
        "split", F.lit(epoch).alias("epoch"),
        F.call_function("div", F.col("position"), F.lit(size)).alias("batch_no"),
        (F.col("position") % size).cast("int").alias("slot"),
        "block_id",
    )
    if drop_last:
        # One number per split, a handful.
        totals = blocks.groupBy("split").agg(F.count("*").alias("n")).collect()
        full = F.lit(0)
        for r in totals:
            full = F.when(F.col("split") == r["split"], r["n"] // size).otherwise(full)
        plan = plan.where(F.col("batch_no") < full)
    if max_batches is not None:
        plan = plan.where(F.col("batch_no") < max_batches)
    return plan


def first_blocks(blocks: DataFrame, size: int, max_batches: int | None) -> DataFrame:
    """Blocks of the first ``max_batches`` batches in stored order; all of them for ``None``.

    Stored block ids count from 0 in each split, so this is a filter the scan can
    use to skip row groups.
    """
    return blocks if max_batches is None else blocks.where(F.col("block_id") < size * max_batches)


def batches(plan: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(split, epoch, batch_no, rows)``: token arrays of each batch in slot order.

    A group holds at most one batch, so its size is set by the token budget.
    """
    # A plan that is small enough goes to the blocks, so their tokens are shuffled once, by batch.
    joined = join_lookup(blocks.select("split", "block_id", "tokens"), plan, ["split", "block_id"])
    gathered = joined.groupBy("split", "epoch", "batch_no").agg(
        F.sort_array(F.collect_list(F.struct("slot", "tokens"))).alias("rows")
    )
    return gathered.select("split", "epoch", "batch_no", F.col("rows.tokens").alias("rows"))
