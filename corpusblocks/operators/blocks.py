"""Manifests, validation and lookup of packed blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusblocks.functions import ids as idf
from corpusblocks.operators.prefix import Order, dense_levels, exclusive_prefix
from corpusblocks.session import materialize
from corpusblocks.sources.shards import shard_group, shard_name

# Folders of shards that a fetch names one by one; the filter becomes one range beyond.
NAMED_FOLDERS = 256


def shard_manifest(blocks: DataFrame, seq_len: int | None = None) -> DataFrame:
    """One row per shard: ``(split, shard_id, shard, blocks, seq_len)``.

    With ``seq_len`` given, as the packer knows it, no token is read.
    """
    length = F.max(F.size("tokens")) if seq_len is None else F.lit(seq_len)
    per_shard = blocks.groupBy("split", "shard_id").agg(
        F.count("*").alias("blocks"), length.alias("seq_len")
    )
    return per_shard.select(
        "split", "shard_id", shard_name(F.col("split"), F.col("shard_id")).alias("shard"),
        "blocks", "seq_len",
    )


def split_manifest(blocks: DataFrame, seq_len: int | None = None) -> DataFrame:
    """One row per split: ``(split, blocks, seq_len, shards)``.

    Shard names stay rows of ``shard_manifest``: a list of them would grow with
    the corpus inside one cell.
    """
    return shard_manifest(blocks, seq_len).groupBy("split").agg(
        F.sum("blocks").alias("blocks"),
        F.max("seq_len").alias("seq_len"),
        F.count("*").alias("shards"),
    )


def token_manifest(blocks: DataFrame) -> DataFrame:
    """The split manifest with the largest id and the width it needs, from one scan of the tokens."""
    per_shard = blocks.groupBy("split", "shard_id").agg(
        F.count("*").alias("blocks"), F.max(F.size("tokens")).alias("seq_len"),
        F.max(F.array_max("tokens")).alias("max_token_id"),
    )
    per_split = per_shard.groupBy("split").agg(
        F.sum("blocks").alias("blocks"), F.max("seq_len").alias("seq_len"), F.count("*").alias("shards"),
        F.max("max_token_id").alias("max_token_id"),
    )
    return per_split.withColumn("id_width", idf.id_width(F.col("max_token_id")))


def shard_checks(blocks: DataFrame) -> DataFrame:
    """Per split: number of block lengths, id range, and whether the split is consistent."""
    per_split = blocks.groupBy("split").agg(
        F.min(F.size("tokens")).alias("min_seq_len"),
        F.max(F.size("tokens")).alias("max_seq_len"),
        F.min(F.array_min("tokens")).alias("min_token_id"),
        F.max(F.array_max("tokens")).alias("max_token_id"),
    )
    consistent = (F.col("min_seq_len") == F.col("max_seq_len")) & (F.col("min_token_id") >= 0)
    return per_split.withColumn("consistent", F.coalesce(consistent, F.lit(False)))


def require_consistent(blocks: DataFrame) -> None:
    """Raise when a split mixes block lengths or holds negative or NULL ids."""
    bad = shard_checks(blocks).where(~F.col("consistent")).collect()  # at most one row per split
    if bad:
        raise ValueError(f"inconsistent blocks: {[row.asDict() for row in bad]}")


def shard_offsets(blocks: DataFrame) -> DataFrame:
    """``(split, shard_id, blocks, start, end)``: block range of every shard."""
    counts = blocks.groupBy("split", "shard_id").agg(F.count("*").alias("blocks"))
    order = Order(("split",), ("shard_id",), dense_levels(counts, "shard_id"))
    starts = exclusive_prefix(counts, order, F.col("blocks"), "start")
    return starts.withColumn("end", F.col("start") + F.col("blocks"))


def locate(requests: DataFrame, offsets: DataFrame, index: str = "block_index", cell: int = 8192) -> DataFrame:
    """Add ``shard_id`` and ``local_index`` to global block indices; NULL out of range.

    A range join written as an equi join: the index axis is cut into cells, a
    shard is listed in every cell it touches, and a request looks into its own
    cell only. ``requests`` needs ``split`` and the index column.
    """
    of_cell = lambda c: F.call_function("div", c, F.lit(cell))
    covers = F.sequence(of_cell(F.col("start")), of_cell(F.col("end") - 1))
    cells = offsets.where(F.col("blocks") > 0).select(
        F.col("split").alias("_split"), "shard_id", "start", "end", F.explode(covers).alias("_cell")
    )
    asked = requests.withColumn("_at", of_cell(F.col(index)))
    hit = (
        (F.col("split") == F.col("_split")) & (F.col("_at") == F.col("_cell"))
        & (F.col(index) >= F.col("start")) & (F.col(index) < F.col("end"))
    )
    found = asked.join(cells, hit, "left")
    return found.select(
        *requests.columns, "shard_id", (F.col(index) - F.col("start")).alias("local_index")
    )


def require_located(located: DataFrame, index: str = "block_index") -> None:
    """Raise when a requested block index is out of range."""
    miss = located.where(F.col("shard_id").isNull()).select("split", index).take(1)
    if miss:
        raise IndexError(f"block index out of range: {miss[0].asDict()}")


def asked_shards(requests: DataFrame, folders: int = NAMED_FOLDERS) -> tuple[Column, Column] | None:
    """Conditions on ``(shard_group, shard_id)`` that hold for every shard of ``requests``; None without any.

    Up to ``folders`` folders are named, each with its range of shards. Which form is taken changes
    what is scanned, not what is found.
    """
    found = requests.where("shard_id is not null").groupBy(shard_group(F.col("shard_id")).alias("folder"))
    ranges = materialize(found.agg(F.min("shard_id").alias("low"), F.max("shard_id").alias("high")), "asked")
    rows = ranges.orderBy("folder").limit(folders + 1).collect()
    if not rows:
        return None
    if len(rows) > folders:
        first, last, low, high = ranges.agg(F.min("folder"), F.max("folder"), F.min("low"), F.max("high")).first()
        return F.col("shard_group").between(first, last), F.col("shard_id").between(low, high)
    shards = F.lit(False)
    for r in rows:
        shards |= F.col("shard_id").between(r["low"], r["high"])
    return F.col("shard_group").isin([r["folder"] for r in rows]), shards


def fetch(requests: DataFrame, blocks: DataFrame, index: str = "block_index") -> DataFrame:
    """Tokens of requested blocks, one row per request that is in range.

    Requests that went through ``locate`` are joined by shard and position. Of stored
    blocks only the folders that are asked for are scanned, and in them the row groups
    of the range of shards asked of each (``asked_shards``).
    """
    if {"shard_id", "local_index"} <= set(requests.columns):
        keys = ["split", "shard_id", "local_index"]
        asked = asked_shards(requests)
        if asked is None:
            return requests.join(blocks.select(*keys, "tokens").limit(0), keys)
        folders, near = asked
        if "shard_group" in blocks.columns:
            near &= folders
        return requests.join(blocks.where(near).select(*keys, "tokens"), keys)
    wanted = requests.withColumn("block_id", F.col(index))
    return wanted.join(blocks.select("split", "block_id", "tokens"), ["split", "block_id"]).drop("block_id")


def training_pairs(blocks: DataFrame) -> DataFrame:
    """``(split, block_id, inputs, targets)``; blocks shorter than two are left out."""
    return blocks.where(F.size("tokens") >= 2).select(
        "split", "block_id",
        idf.inputs(F.col("tokens")).alias("inputs"),
        idf.targets(F.col("tokens")).alias("targets"),
    )


def next_token_rows(blocks: DataFrame, keep: Sequence[str] = ("split", "block_id")) -> DataFrame:
    """Long form: ``(…, input_id, target_id)``, one row per predicted token."""
    pairs = F.arrays_zip(idf.inputs(F.col("tokens")), idf.targets(F.col("tokens")))
    rows = blocks.where(F.size("tokens") >= 2).select(*keep, F.inline(pairs))
    return rows.toDF(*keep, "input_id", "target_id")
