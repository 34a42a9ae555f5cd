"""Next-token counts as a model, and loss and perplexity under it.

The model is a table of neighbour counts. Everything that meets the token stream
aggregates first: a group is a (context, target) pair, so what is shuffled or
joined is bounded by the vocabulary squared per split or by the distinct pairs of
a document, never by the number of tokens.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusblocks.functions import vectors as vec
from corpusblocks.operators.blocks import next_token_rows
from corpusblocks.session import BROADCAST_ROWS, holds_at_most, join_lookup


def neighbour_counts(blocks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(…by, input_id, target_id, n)`` over adjacent tokens inside blocks."""
    pairs = next_token_rows(blocks, keep=by)
    return pairs.groupBy(*by, "input_id", "target_id").agg(F.count("*").alias("n"))


def target_model(counts: DataFrame, size: int) -> DataFrame:
    """``(target_id, p1)``: add-one probability of a token without context."""
    seen = counts.groupBy("target_id").agg(F.sum("n").alias("c"))
    every = counts.sparkSession.range(size).select(F.col("id").cast("int").alias("target_id"))
    # One row per token id on both sides.
    joined = every.join(seen, "target_id", "left").select("target_id", F.coalesce("c", F.lit(0)).alias("c"))
    total = F.sum("c").over(W.partitionBy())
    return joined.select("target_id", ((F.col("c") + 1).cast("double") / (total + size)).alias("p1"))


def context_totals(counts: DataFrame) -> DataFrame:
    """``(input_id, c)``: how often a token occurs as context."""
    return counts.groupBy("input_id").agg(F.sum("n").alias("c"))


def _smoothed(n: Column, c: Column, p1: Column, k: float) -> Column:
    return (F.coalesce(n, F.lit(0)) + k * p1) / (F.coalesce(c, F.lit(0)) + k)


def next_token_model(counts: DataFrame, size: int, k: float = 1.0) -> DataFrame:
    """``(input_id, target_id, n, p)`` for all observed pairs."""
    few = size <= BROADCAST_ROWS
    joined = join_lookup(counts, context_totals(counts), ["input_id"], bounded=few)
    joined = join_lookup(joined, target_model(counts, size), ["target_id"], bounded=few)
    return joined.select(
        "input_id", "target_id", "n", _smoothed(F.col("n"), F.col("c"), F.col("p1"), k).alias("p")
    )


def scored_pairs(pairs: DataFrame, counts: DataFrame, size: int, k: float = 1.0) -> DataFrame:
    """Add ``nll`` to ``(…, input_id, target_id, n)`` rows, seen in training or not.

    Tables of one row per token are broadcast while the vocabulary is small
    enough; the table of pairs while their number is.
    """
    few = size <= BROADCAST_ROWS
    model = counts.select("input_id", "target_id", F.col("n").alias("_n"))
    joined = join_lookup(pairs, model, ["input_id", "target_id"], "left", bounded=_few_pairs(counts, size))
    joined = join_lookup(joined, context_totals(counts), ["input_id"], "left", bounded=few)
    joined = join_lookup(joined, target_model(counts, size), ["target_id"], "inner", bounded=few)
    p = _smoothed(F.col("_n"), F.col("c"), F.col("p1"), k)
    return joined.select(*pairs.columns, (-F.log(p)).alias("nll"))


def _few_pairs(counts: DataFrame, size: int) -> bool:
    return size * size <= BROADCAST_ROWS or holds_at_most(counts, BROADCAST_ROWS)


def loss_columns(nll: Column, weight: Column) -> list[Column]:
    """``loss, perplexity, tokens`` aggregates; NaN, NaN, 0 over no tokens."""
    tokens = F.coalesce(F.sum(weight), F.lit(0)).cast("bigint")
    mean = F.coalesce(F.sum(nll * weight) / F.sum(weight), F.lit(float("nan")))
    return [mean.alias("loss"), F.exp(mean).alias("perplexity"), tokens.alias("tokens")]


def evaluate(
    blocks: DataFrame,
    counts: DataFrame,
    size: int,
    k: float = 1.0,
    by: Sequence[str] = ("split",),
    few_groups: bool = True,
) -> DataFrame:
    """Token-weighted mean loss and perplexity per group (of all tokens when ``by`` is empty).

    With few groups, pairs are counted per group first and only the counts are
    scored. With many groups, such as documents, that count would shuffle nearly
    every token; there each token is scored where it is, as long as the model can
    be broadcast, and only the sums per group are shuffled.
    """
    if few_groups or not _few_pairs(counts, size):
        pairs = neighbour_counts(blocks, by)
    else:
        pairs = next_token_rows(blocks, keep=by).withColumn("n", F.lit(1))
    return scored_pairs(pairs, counts, size, k).groupBy(*by).agg(
        *loss_columns(F.col("nll"), F.col("n"))
    )


def vector_loss(scores: DataFrame, logits: str = "logits", target: str = "target_id", by: Sequence[str] = ()) -> DataFrame:
    """The same metrics for given score vectors with a target id each."""
    nll = vec.negative_log_likelihood(F.col(logits), F.col(target))
    return scores.select(*by, nll.alias("nll")).groupBy(*by).agg(*loss_columns(F.col("nll"), F.lit(1)))


@dataclass(frozen=True)
class ContextModel:
    """Counts by context, as sparse as they are, and what all contexts share.

    ``table`` has ``(input_id, c, by_target)`` for contexts that were seen; ``p1`` is one
    probability per token id. The vector of a context is made in the row that needs it.
    """

    table: DataFrame
    p1: tuple[float, ...]
    k: float

    def logits(self, c: Column, by_target: Column) -> Column:
        """Log-probabilities over the vocabulary; null counts are an unseen context."""
        p1 = F.split(F.lit(",".join(map(repr, self.p1))), ",").cast("array<double>")
        return F.transform(p1, lambda p, i: F.log(_smoothed(F.try_element_at(by_target, i), c, p, self.k)))


def context_model(counts: DataFrame, size: int, k: float = 1.0) -> ContextModel:
    # As many numbers as there are token ids; they become an array constant.
    listed = [r["p1"] for r in target_model(counts, size).orderBy("target_id").collect()]
    seen = counts.groupBy("input_id").agg(
        F.sum("n").alias("c"),
        F.map_from_entries(F.collect_list(F.struct("target_id", "n"))).alias("by_target"),
    )
    return ContextModel(seen, tuple(listed), k)
