"""Packing a token stream into fixed-length blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusblocks.functions.ids import id_width, wrap
from corpusblocks.functions.vectors import with_let
from corpusblocks.operators.prefix import Order, exclusive_prefix

# Default block length and number of blocks in a shard.
SEQ_LEN = 256
BLOCKS_PER_SHARD = 8192
# Shards that share a file: about 128 MB of ids at the defaults.
SHARDS_PER_FILE = 32
RUNS_PER_CORE = 4


def _div(value: Column, by: int) -> Column:
    # Integer division of non-negative integers, exact for all of BIGINT.
    return F.call_function("div", value, F.lit(by))


def wrap_examples(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """Put begin and end markers around every example."""
    return encoded.withColumn(ids, wrap(F.col(ids)))


def token_offsets(examples: DataFrame, order: Order, ids: str = "ids") -> DataFrame:
    """Add ``first_token``: position of an example's first id in the stream of its split."""
    return exclusive_prefix(examples, order, F.size(ids).cast("bigint"), "first_token")


def pack_blocks(
    examples: DataFrame,
    order: Order,
    seq_len: int = SEQ_LEN,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    ids: str = "ids",
) -> DataFrame:
    """Concatenate the examples of each split and cut the stream into blocks.

    Gives ``(split, shard_run, block_id, shard_id, local_index, tokens)``; blocks run across
    example boundaries and the unfilled tail of a split is dropped. Greedy
    filling of a buffer equals cutting at multiples of ``seq_len``, so once the
    offset of an example is known, its pieces are known without looking at its
    neighbours. What an example gives a shard is one piece, however short the blocks are, and
    is cut into blocks where the shard is gathered. Pieces are shuffled by ``shard_run``, the shards that share a
    file: the same exchange serves the gathering of shards and a later write. A corpus
    with few shards has shorter runs, so that every core gathers.

    ``examples`` is read three times (lengths twice, payload once); materialize it first when
    it is expensive to compute.
    """
    (split,) = order.group
    tokens = examples.agg(F.sum(F.size(ids).cast("bigint"))).first()[0] or 0
    shards = tokens // (seq_len * blocks_per_shard)
    per_run = min(SHARDS_PER_FILE, max(1, shards // (RUNS_PER_CORE * examples.sparkSession.sparkContext.defaultParallelism)))
    placed = token_offsets(examples.where(F.size(ids) > 0), order, ids)
    first, size = F.col("first_token"), F.size(ids)
    of_shard = seq_len * blocks_per_shard
    cuts = F.sequence(_div(first, of_shard), _div(first + size - 1, of_shard))
    pieces = F.transform(cuts, lambda s: F.struct(
        s.alias("shard_id"),
        F.greatest(first, s * of_shard).alias("at"),
        F.slice(
            F.col(ids),
            (F.greatest(first, s * of_shard) - first + 1).cast("int"),
            (F.least(first + size, (s + 1) * of_shard) - F.greatest(first, s * of_shard)).cast("int"),
        ).alias("ids"),
    ))

    def filled(tokens: Column) -> Column:
        """The full blocks of a shard; a lambda variable is not flattened again for every block."""
        full = _div(F.size(tokens), seq_len)
        block = lambda i: F.struct(
            (F.col("shard_id") * blocks_per_shard + i).alias("block_id"), i.alias("local_index"),
            F.slice(tokens, (i * seq_len + 1).cast("int"), F.lit(seq_len)).alias("tokens"),
        )
        return F.when(full > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), full - 1), block))

    shards_of = (
        placed.select(split, F.inline(pieces))
        .withColumn("shard_run", _div(F.col("shard_id"), per_run))
        .repartition(split, "shard_run")
        .groupBy(split, "shard_run", "shard_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("pieces"))
    )
    blocks = shards_of.select(split, "shard_run", "shard_id", F.inline(with_let(F.flatten("pieces.ids"), filled)))
    return blocks.select(F.col(split).alias("split"), "shard_run", "block_id", "shard_id", "local_index", "tokens")


def packing_totals(examples: DataFrame, seq_len: int = SEQ_LEN, split: str = "split", ids: str = "ids") -> DataFrame:
    """Examples, tokens, full blocks and dropped tokens per split.

    Needs the lengths only, so no token leaves its task.
    """
    sizes = examples.groupBy(split).agg(
        F.count("*").alias("examples"),
        F.sum(F.size(ids).cast("bigint")).alias("tokens"),
    )
    return sizes.select(
        split, "examples", "tokens",
        _div(F.col("tokens"), seq_len).alias("blocks"),
        (F.col("tokens") % seq_len).alias("dropped_tokens"),
    )


def width_report(blocks: DataFrame) -> DataFrame:
    """Largest id and the unsigned width it needs, per split."""
    return (
        blocks.groupBy("split").agg(F.max(F.array_max("tokens")).alias("max_token_id"))
        .withColumn("id_width", id_width(F.col("max_token_id")))
    )
