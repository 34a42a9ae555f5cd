"""Connected components: union-find on distributed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusblocks.session import BROADCAST_ROWS, holds_at_most, join_lookup, materialize, tidy


@tidy
def connected_components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    With ``known``, the components of other links, those of both: only links between
    components that are not one yet are worked on.
    """
    if known is None:
        return _components(links)
    names = known.select(F.col("node").alias("a"), F.col("component").alias("_a"))
    first = join_lookup(links.where("a <> b").select("a", "b"), names, ["a"], "left")
    both = join_lookup(first, names.toDF("b", "_b"), ["b"], "left")
    outer = both.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b").distinct()
    outer = materialize(outer, "outer")
    if outer.isEmpty():
        return known
    roots = _components(outer)
    renamed = join_lookup(known, roots.toDF("component", "_root"), ["component"], "left")
    renamed = renamed.select("node", F.coalesce("_root", "component").alias("component"))
    added = roots.join(known.select("node"), "node", "left_anti")
    return materialize(renamed.unionByName(added.select("node", "component")), "components")


def _components(links: DataFrame) -> DataFrame:
    """Every node points to a parent. A round hangs the parent of a node, and the node
    itself, below the smallest grandparent among its neighbours, and then halves all
    paths; the number of rounds grows with the logarithm of the longest chain. A round
    shuffles nodes and links only, aggregates before shuffling, and ends in a written
    table, so a lost executor costs one round at most.
    """
    both = links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = materialize(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    forest = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("parent"))
    forest = materialize(forest, "forest")
    few = holds_at_most(forest, BROADCAST_ROWS)
    while True:
        forest = _round(both, forest, few)
        if forest.where("parent <> _old").isEmpty():
            return forest.select("node", F.col("parent").alias("component"))


@tidy
def _round(both: DataFrame, forest: DataFrame, few: bool) -> DataFrame:
    """``(node, parent, _old)`` of the next forest, with the parent until now; ``few`` nodes are broadcast."""
    forest = forest.select("node", "parent")
    pointers = forest.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
    stepped = materialize(join_lookup(forest, pointers, ["parent"], bounded=few), "stepped")
    grand = stepped.select(F.col("node").alias("v"), "grand")
    least = join_lookup(both, grand, ["v"], bounded=few).groupBy(F.col("u").alias("node")).agg(F.min("grand").alias("_least"))
    hooked = join_lookup(stepped, least, ["node"], bounded=few)
    # What a node offers itself, and what it offers its parent.
    own = hooked.select("node", F.least("parent", "grand", "_least").alias("parent"), F.col("parent").alias("_old"))
    lifted = hooked.groupBy(F.col("parent").alias("node")).agg(F.min("_least").alias("parent"))
    following = own.unionByName(lifted.withColumn("_old", F.lit(None).cast("long")))
    # A node has one parent until now.
    return materialize(following.groupBy("node").agg(F.min("parent").alias("parent"), F.max("_old").alias("_old")), "forest")
