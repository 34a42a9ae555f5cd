"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a seeded shuffle, and queues them a second time in
the same order. A queued document's virtual finish time is the source's words up to and
including it divided by the source's target, so every source reaches its target at
time 1. All queues are merged by finish time, and the merged order is cut where its
words exceed the total budget.

Running sums go over trees of buckets (``operators.prefix``): no window sees a whole
source, and equal rows may stand in any order without a change of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusblocks.functions.seeded import sort_key
from corpusblocks.llm.common import packed, table, whole_text
from corpusblocks.operators.prefix import Order, dense_levels, exclusive_prefix, hashed_levels
from corpusblocks.session import join_lookup, materialize, tidy

WEIGHTS = (3, 1, 2)
#: Share of all words that the mix holds, and how often a document may be taken.
SHARE = 1.5
PASSES = 2
SEED = 9


def word_count(column: str = "text") -> Column:
    """Number of runs of anything but space and U+0009 to U+000D; null: 0."""
    return F.regexp_count(whole_text(column), F.lit("[^ \\t-\\r]+")).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES
) -> DataFrame:
    """Targets of sources from a table ``(source, size)``: ``source, source_size, target``.

    Sources in code-point order, null last, take the weights in turn. Targets split the
    budget by weight but stop at ``passes`` times the source; what is cut off is shared
    again. That is filling to one level: with sources ordered by where they stop, the
    level is the budget less what stopped sources hold, over the weights still open.
    Windows here see one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int") + 1)
    ranked = totals.withColumn("_weight", weight).withColumn("_stop", F.col("source_size") * passes / F.col("_weight"))
    order = W.orderBy("_stop", F.col("source").asc_nulls_last())
    ahead, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (
        share * F.sum("source_size").over(everything)
        - passes * F.coalesce(F.sum("source_size").over(ahead), F.lit(0))
    ) / F.sum("_weight").over(rest)
    levels = ranked.withColumn("_level", level).withColumn("_open", F.col("_stop") >= F.col("_level"))
    filled = levels.withColumn("_fill", F.min(F.when(F.col("_open"), F.struct("_stop", "_level"))).over(everything))
    target = F.least(
        F.col("source_size") * F.lit(float(passes)),
        F.coalesce(F.col("_fill._level") * F.col("_weight"), F.col("source_size") * F.lit(float(passes))),
    )
    return filled.select("source", "source_size", target.alias("target"))


@tidy
def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    seed: int = SEED,
    key: str = "doc_id",
) -> DataFrame:
    """Add to ``docs(key, source, size, ...)`` what the mix takes of each document.

    New columns: ``source_size``, ``target``, ``finish`` (virtual finish times of the
    passes, an array), ``copies`` (how many of them lie before the cut) and ``taken``.
    A document without words is never counted as taken. An empty table gives no rows.
    """
    targets = source_targets(docs.select("source", "size"), weights, share, passes)
    named = targets.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))).drop("source")
    queued = docs.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
    queued = queued.withColumn("_shuffle", sort_key(seed, F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    queued = join_lookup(queued, named, ["_source"])
    rows = queued.count()
    order = Order(("_source",), ("_shuffle", key, "size"), hashed_levels("_shuffle", rows))
    queued = exclusive_prefix(queued, order, F.col("size"), "_before")
    times = [
        (F.col("source_size") * i + F.col("_before") + F.col("size")) / F.col("target") for i in range(passes)
    ]
    queued = materialize(
        queued.withColumn("finish", F.when(F.col("target") > 0, F.array(*times))), "queued"
    )
    cut = _cut(queued, share, rows * passes)
    before = F.size(F.filter("finish", lambda t: t < cut)) if cut is not None else F.size("finish")
    copies = F.when((F.col("size") > 0) & F.col("finish").isNotNull(), before).otherwise(0)
    taken = queued.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return taken.drop("_source", "_shuffle", "_before")


def _cut(queued: DataFrame, share: float, entries: int) -> float | None:
    """The first finish time at which the merged queues exceed the budget; None: they never do."""
    queue = queued.where("size > 0").select("size", F.explode("finish").alias("finish"))
    budget = queued.agg(F.sum("size")).first()[0]
    if not budget:
        return None
    queue = queue.withColumn("_place", F.floor(F.col("finish") * entries).cast("long"))
    order = Order((), ("finish", "size"), dense_levels(queue, "_place"))
    merged = exclusive_prefix(queue, order, F.col("size"), "_before")
    return merged.where(F.col("_before") + F.col("size") > share * budget).agg(F.min("finish")).first()[0]


@tidy
def mixed_documents(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, seed: int = SEED
) -> DataFrame:
    """The documents of the mix in the order of their finish times, repeated as often as they are taken.

    Only keys and sizes are queued; the texts are joined with what is taken and sorted
    once. Documents without words are not part of a mix.
    """
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))
    keyed = packed(
        docs, _key=F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)), _tie=F.xxhash64("text"), _from=source,
        source=F.col("source"), size=word_count(),
    )
    # Rows equal in all this are queued as one.
    narrow = keyed.groupBy("_key", "_tie", "_from", "source").agg(F.sum("size").alias("size"))
    taken = mix(materialize(narrow, "sizes"), weights, share, passes, seed, "_key").where("copies > 0")
    taken = taken.select("_key", "_tie", "_from", F.slice("finish", 1, F.col("copies")).alias("_finish"))
    rows = keyed.drop("source", "size").join(materialize(taken, "taken").hint("shuffle_hash"), ["_key", "_tie", "_from"])
    rows = rows.withColumn("_finish", F.explode("_finish"))
    return rows.orderBy("_finish", "_key", "_tie").select("_row.*")


@tidy
def op9_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size"))
    mixed = mix(materialize(docs, "sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))
