"""Approximate nearest neighbours by robust-pruned directed graphs.

Distinct vectors are dealt into shards of about ``SHARD`` by a hash. In a shard a graph is
grown: for every vector a greedy beam search on the graph so far proposes neighbours, and
pruning keeps the nearest one and drops all that are, by the factor ``ALPHA``, closer to a
kept one than to the vector, so what stays points in diverse directions. Edges are also
set backwards, pruned again where a vector has too many. A query walks every shard's
graph by beam search, and what the beams end with is ranked by the exact measure.

The measure is the largest inner product. One more coordinate gives all vectors of a
shard the same length, and for those the nearest one has the largest inner product.

Equal vectors are one point of the graph that stands for all their rows; of these at most
one more than a query returns can matter, those with the smallest ids. Rows whose id or
vector is null, whose vector is zero or holds a null or non-finite component, or has
another length than most, take no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusblocks.llm.common import table
from corpusblocks.session import join_lookup, materialize

NEAREST = 20
EVERY = 20
SHARD = 8_192
#: Out-degree, beam while building, factor of the pruning, beam of a query.
DEGREE = 40
BUILD_BEAM = 64
ALPHA = 1.2
QUERY_BEAM = 128
#: Vectors inserted at once, queries searched at once, nodes expanded at once.
BATCH = 512
QUERY_BLOCK = 4_096
EXPAND = 4
SEED = 10


def _beam(points: np.ndarray, graph: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int):
    """The ``width`` nearest nodes that a beam search reaches, with squared distances; -1 pads."""
    count, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((count, len(points) + 1), bool)
    seen[:, -1] = True  # the padding node
    ids = np.full((count, width), -1, np.int32)
    far = np.full((count, width), np.inf, np.float32)
    done = np.ones((count, width), bool)
    found = np.broadcast_to(entries[None, :], (count, len(entries))).astype(np.int32)
    norms = (points * points).sum(1)
    own = (queries * queries).sum(1)[:, None]
    while True:
        # New nodes, each once per query.
        found = np.sort(found, 1)
        fresh = ~seen[rows, found]
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        seen[rows, found] = True
        inner = np.einsum("qnd,qd->qn", points[found], queries, optimize=False)
        gaps = np.where(fresh, norms[found] + own - 2 * inner, np.inf).astype(np.float32)
        all_ids = np.concatenate([ids, np.where(fresh, found, -1)], 1)
        all_far = np.concatenate([far, gaps], 1)
        all_done = np.concatenate([done, ~fresh], 1)
        best = np.argpartition(all_far, width - 1, 1)[:, :width]
        ids, far, done = (np.take_along_axis(x, best, 1) for x in (all_ids, all_far, all_done))
        open_far = np.where(done, np.inf, far)
        take = np.argpartition(open_far, min(EXPAND, width) - 1, 1)[:, :EXPAND]
        usable = np.isfinite(np.take_along_axis(open_far, take, 1))
        active = usable.any(1)
        if not active.any():
            order = np.argsort(far, 1, kind="stable")
            return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
        np.put_along_axis(done, take, True, 1)
        nodes = np.where(usable, np.take_along_axis(ids, take, 1), -1)
        found = graph[nodes].reshape(count, -1)  # row -1 of the graph is padding, too


def _prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning of candidate lists (-1 pads), for many nodes at once."""
    candidates = np.where(candidates == nodes[:, None], -1, candidates)
    vectors = points[candidates]
    gaps = ((vectors - points[nodes][:, None, :]) ** 2).sum(2)
    gaps[candidates < 0] = np.inf
    order = np.argsort(gaps, 1, kind="stable")
    candidates, gaps = np.take_along_axis(candidates, order, 1), np.take_along_axis(gaps, order, 1)
    repeated = np.zeros(candidates.shape, bool)
    by_id = np.argsort(candidates, 1, kind="stable")
    sorted_ids = np.take_along_axis(candidates, by_id, 1)
    np.put_along_axis(repeated, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
    vectors = points[candidates]
    norms = (vectors * vectors).sum(2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (vectors @ vectors.transpose(0, 2, 1))
    alive = np.isfinite(gaps) & ~repeated
    kept = np.full((len(nodes), degree), -1, np.int32)
    rows = np.arange(len(nodes))
    for slot in range(degree):
        some = alive.any(1)
        if not some.any():
            break
        pick = alive.argmax(1)  # the nearest that is left
        kept[some, slot] = candidates[rows[some], pick[some]]
        alive &= ~(alpha * alpha * between[rows, pick] <= gaps)
        alive[rows, pick] = False
    return kept


def build(vectors: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Graph ``[node, slot] -> node`` (-1 pads; one padding row at the end) and entry nodes."""
    count = len(vectors)
    points = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), np.float32)])
    random = np.random.default_rng(seed)
    graph = np.full((count + 1, DEGREE), -1, np.int32)
    first = min(count, BATCH)
    order = random.permutation(count).astype(np.int32)
    middle = vectors.mean(0)
    entries = np.unique(np.append(order[:8], np.argmin(((vectors - middle) ** 2).sum(1)))).astype(np.int32)
    # The first vectors start from random edges; all others find a graph.
    if count > 1:
        graph[order[:first], : min(8, first)] = order[random.integers(0, first, (first, min(8, first)))]
        graph[order[:first]] = np.where(graph[order[:first]] == order[:first, None], -1, graph[order[:first]])
    for begin in range(0, count, BATCH):
        nodes = order[begin : begin + BATCH]
        near, _ = _beam(points[:-1], graph, points[nodes], entries, BUILD_BEAM)
        kept = _prune(points, nodes, np.concatenate([near, graph[nodes]], 1), DEGREE, ALPHA)
        graph[nodes] = kept
        _backwards(points, graph, nodes, kept)
    return graph, entries


def _backwards(points: np.ndarray, graph: np.ndarray, nodes: np.ndarray, kept: np.ndarray) -> None:
    source = np.repeat(nodes, kept.shape[1])[kept.ravel() >= 0]
    target = kept.ravel()[kept.ravel() >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    starts = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if len(target) else np.zeros(0, int)
    place = np.arange(len(target)) - np.repeat(starts, np.diff(np.append(starts, len(target))))
    # In rounds, so that a node many others point to is pruned as its list fills.
    for low in range(0, int(place.max(initial=-1)) + 1, DEGREE):
        now = (place >= low) & (place < low + DEGREE)
        touched, row = np.unique(target[now], return_inverse=True)
        coming = np.full((len(touched), DEGREE), -1, np.int32)
        coming[row, place[now] - low] = source[now]
        for k in range(0, len(touched), BATCH):
            some = touched[k : k + BATCH]
            lists = np.concatenate([graph[some], coming[k : k + BATCH]], 1)
            graph[some] = _prune(points, some, lists, DEGREE, ALPHA)


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with the coordinate that makes their lengths equal."""
    squares = (vectors.astype(np.float64) ** 2).sum(1)
    rest = np.sqrt(np.maximum(0.0, squares.max(initial=0.0) - squares))
    scale = np.sqrt(squares.max(initial=1.0)) or 1.0
    return (np.concatenate([vectors, rest[:, None]], 1) / scale).astype(np.float32)


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("group", ignore_index=True)
    graph, entries = build(_lifted(np.stack(rows["vector"].to_numpy())))
    entry = np.zeros(len(rows), bool)
    entry[entries] = True
    return rows.assign(node=np.arange(len(rows), dtype=np.int32), edges=list(graph[:-1]), entry=entry)


def _search_shard(nearest: int, beam: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "group": [], "score": []}).astype(
            {"query_id": "int64", "group": "int64", "score": "float64"}
        )
        if index.empty or queries.empty:
            return empty
        index = index.sort_values("node", ignore_index=True)
        vectors = np.stack(index["vector"].to_numpy())
        graph = np.concatenate([np.stack(index["edges"].to_numpy()), np.full((1, DEGREE), -1)]).astype(np.int32)
        points, entries = _lifted(vectors), np.flatnonzero(index["entry"].to_numpy())
        groups, parts = index["group"].to_numpy(), []
        for k in range(0, len(queries), BATCH):
            block = queries.iloc[k : k + BATCH]
            asked = np.stack(block["vector"].to_numpy())
            lengths = np.sqrt((asked**2).sum(1, keepdims=True))
            lifted = np.concatenate([asked / lengths, np.zeros((len(asked), 1))], 1).astype(np.float32)
            found, _ = _beam(points, graph, lifted, entries, max(beam, nearest + 1))
            exact = np.einsum("qnd,qd->qn", vectors[found], asked)
            exact[found < 0] = -np.inf
            best = np.argsort(-exact, 1, kind="stable")[:, : nearest + 1]
            score = np.take_along_axis(exact, best, 1)
            ids = groups[np.take_along_axis(found, best, 1)]
            good = np.isfinite(score)
            parts.append(pd.DataFrame({
                "query_id": np.repeat(block["query_id"].to_numpy(), good.sum(1)), "group": ids[good], "score": score[good],
            }))
        return pd.concat(parts, ignore_index=True) if parts else empty

    return run


def usable(df: DataFrame, key: str, column: str) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part, vectors in double precision."""
    vector = F.transform(column, lambda x: x.cast("double") + F.lit(0.0))
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = df.select(F.col(key).cast("long").alias("vec_id"), vector.alias("vector"), finite.alias("_finite"))
    rows = rows.where(
        "vec_id is not null and vector is not null and _finite"
    ).where(F.exists("vector", lambda x: x != 0)).drop("_finite")
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (sizes["n"] if sizes else 0))


def nearest_neighbours(
    df: DataFrame, key: str = "vec_id", column: str = "embedding", every: int = EVERY, nearest: int = NEAREST,
    shard: int = SHARD, beam: int = QUERY_BEAM,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for every row whose id ``every`` divides, against all other rows."""
    rows = materialize(usable(df, key, column).withColumn("group", F.xxhash64("vector")), "vectors")
    order = W.partitionBy("group").orderBy("vec_id")
    members = rows.select("group", "vec_id").withColumn("_n", F.row_number().over(order))
    members = materialize(members.where(F.col("_n") <= nearest + 1).select("group", "vec_id", "_n"), "members")
    firsts = members.where("_n = 1").select("group", "vec_id")
    points = rows.join(firsts, ["group", "vec_id"]).dropDuplicates(["group"]).select("group", "vector")
    points = materialize(points, "points")
    shards = max(1, -(-points.count() // shard))
    index = points.withColumn("shard", F.pmod(F.xxhash64("group", F.lit(SEED)), F.lit(shards)).cast("int"))
    fields = "group long, vector array<double>, shard int, node int, edges array<int>, entry boolean"
    index = materialize(
        index.groupBy("shard").applyInPandas(_build_shard, fields), "index"
    )
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    queries = queries.dropDuplicates(["query_id"])
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    asked = queries.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (
        spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(_search_shard(nearest, beam), "query_id long, group long, score double")
    )
    found = materialize(found, "found")
    # Of all shards' groups only the best can hold a query's nearest rows.
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "group")
    close = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= nearest + 1).drop("_n")
    named = join_lookup(close, members.groupBy("group").agg(F.collect_list("vec_id").alias("_ids")), ["group"])
    each = named.select("query_id", F.explode("_ids").alias("vec_id"), "score").where("vec_id <> query_id").distinct()
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op10_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth embedding."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
