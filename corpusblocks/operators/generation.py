"""Continuing a table of prompts, all prompts at once, one token per round."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusblocks.functions import vectors as vec
from corpusblocks.functions.ids import EOS_ID, last_ids
from corpusblocks.functions.seeded import uniform
from corpusblocks.operators.likelihood import ContextModel
from corpusblocks.session import join_lookup, materialize

# Pairs of a model whose sparse contexts may be broadcast.
BROADCAST_PAIRS = 2_000_000
ROUNDS_PER_CUT = 4
# Token ids of a vocabulary whose best successors travel as a constant.
CONSTANT_IDS = 200_000
# Scores that a task holds at once.
SCORES_AT_ONCE = 1 << 20


def _continue(prompts: DataFrame, table: DataFrame, fits: bool, rounds: int, choose) -> DataFrame:
    """Append ``choose(step)`` to every prompt until it is the end marker.

    ``table`` has at most one row per token id, keyed ``_last``; ``fits`` says that it may be broadcast.
    Finished prompts leave the rounds at every cut of the lineage.
    """
    state = prompts.select(
        "*",
        F.element_at("ids", -1).alias("_last"),
        F.array().cast("array<int>").alias("generated"),
        F.lit(False).alias("_done"),
    )
    columns, finished = state.columns, []
    for step in range(rounds):
        # Not broadcast, a table joins by salted keys: many prompts share a last token.
        # An inner join would add a null test on the last token below every earlier
        # round, and with it a second evaluation of each choice.
        joined = join_lookup(state, table, ["_last"], "left", bounded=fits, max_rows=0)
        joined = joined.withColumn("_next", F.when(~F.col("_done"), choose(step)))
        ended = F.col("_done") | (F.col("_next") == EOS_ID)
        state = joined.withColumn("_ended", ended).select(
            *[c for c in columns if c not in ("_last", "generated", "_done")],
            F.when(F.col("_ended"), F.col("_last")).otherwise(F.col("_next")).alias("_last"),
            F.when(F.col("_ended"), F.col("generated"))
            .otherwise(F.concat("generated", F.array("_next"))).alias("generated"),
            F.col("_ended").alias("_done"),
        )
        if (step + 1) % ROUNDS_PER_CUT == 0 and step + 1 < rounds:
            state = materialize(state, "prompts")
            finished.append(state.where("_done"))
            state = state.where("not _done")
            if state.isEmpty():
                break
    for rows in finished:
        state = state.unionByName(rows)
    return state.drop("_last", "_done")


def _followed(prompts: DataFrame, following: list[int], rounds: int) -> DataFrame:
    """Add ``generated`` in one pass: a walk in the row along ``following``, a constant indexed by token."""
    constant = f"cast(split('{','.join(map(str, following))}', ',') AS array<int>)"
    walk = f"""aggregate(sequence(1, {rounds}),
      struct(element_at(ids, -1) AS last, cast(array() AS array<int>) AS made, false AS done),
      (s, i) -> CASE WHEN s.done OR get({constant}, s.last) = {EOS_ID} THEN struct(s.last AS last, s.made AS made, true AS done)
        ELSE struct(get({constant}, s.last) AS last, concat(s.made, array(get({constant}, s.last))) AS made, false AS done) END,
      s -> s.made)"""
    made = F.expr(walk) if rounds > 0 else F.array().cast("array<int>")
    return prompts.withColumn("generated", made)


def _sums(values: np.ndarray) -> np.ndarray:
    """Running sums of every row, added from the left as a fold does."""
    return np.cumsum(values, axis=1)


def _filtered(probs: np.ndarray, k: int, p: float) -> np.ndarray:
    """``vectors.filtered`` for every row of ``probs``."""
    rows, size = probs.shape
    if 0 < k < size:
        least = np.partition(probs, size - k, axis=1)[:, size - k, None]
        same = probs == least
        room = k - np.count_nonzero(probs > least, axis=1)[:, None]
        ids = np.nonzero((probs > least) | (same & (np.cumsum(same, axis=1) <= room)))[1].reshape(rows, k)
    else:
        ids = np.broadcast_to(np.arange(size), (rows, size))
    values = np.take_along_axis(probs, ids, 1)
    if p < 1:
        order = np.argsort(-values, axis=1, kind="stable")  # ties by ascending id
        ranked = np.take_along_axis(values, order, 1)
        taken = np.concatenate([np.ones((rows, 1), bool), _sums(ranked)[:, :-1] < p], axis=1)
        np.put_along_axis(values, order, np.where(taken, ranked, 0.0), 1)
    total = _sums(values)[:, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        values = np.where(total > 0, values / total, 0.0)
    kept = np.zeros(probs.shape)
    np.put_along_axis(kept, ids, values, 1)
    return np.where(total > 0, kept, 1.0 / size)


def _drawn(probs: np.ndarray, u: np.ndarray) -> np.ndarray:
    """``vectors.draw`` for every row of ``probs``."""
    beyond = _sums(probs) > u[:, None]
    last = probs.shape[1] - 1 - np.argmax(probs[:, ::-1] > 0, axis=1)
    return np.where(beyond.any(axis=1), np.argmax(beyond, axis=1), last)


def _sampler(model: ContextModel, table: DataFrame, *, t: float, k: int, p: float, penalty: float) -> Callable:
    """Arrow function from last ids and draws of all steps to the generated ids.

    The counts of ``table``, one row per context, travel to the tasks once; a row of scores is
    made as ``ContextModel.logits`` and ``vectors.sampling_distribution`` make it.
    """
    pairs = table.select("_last", "c", F.map_keys("by_target").alias("targets"), F.map_values("by_target").alias("n")).toArrow()
    last, c, targets, n = (pairs.column(i).combine_chunks() for i in range(4))
    counts = table.sparkSession.sparkContext.broadcast((
        {v: i for i, v in enumerate(last.to_pylist())}, c.to_numpy(zero_copy_only=False), targets.offsets.to_numpy(),
        targets.values.to_numpy(), n.values.to_numpy(), np.array(model.p1),
    ))

    smooth, size = model.k, len(model.p1)

    def scores(context: int) -> np.ndarray:
        places, c, offsets, targets, n, p1 = counts.value
        at, seen = places.get(context), np.zeros(size)
        if at is None:
            return np.log((seen + smooth * p1) / smooth)
        part = slice(offsets[at], offsets[at + 1])
        inside = targets[part] < size
        seen[targets[part][inside]] = n[part][inside]
        return np.log((seen + smooth * p1) / (c[at] + smooth))

    def walk(last: list, draws: np.ndarray) -> list[list[int]]:
        made: list[list[int]] = [[] for _ in last]
        open_ = np.arange(len(last))
        for step in range(draws.shape[1]):
            contexts, of = np.unique(np.array([-1 if last[i] is None else last[i] for i in open_]), return_inverse=True)
            logits = np.stack([scores(context) for context in contexts.tolist()])
            logits = (logits / max(1e-6, t) if t > 0 else logits)[of]
            if penalty > 1:
                for row, i in enumerate(open_.tolist()):
                    ids = list(set(made[i]))
                    logits[row, ids] /= penalty
            weights = np.exp(logits - logits.max(axis=1, keepdims=True))
            chosen = _drawn(_filtered(weights / _sums(weights)[:, -1:], k, p), draws[open_, step])
            for i, token in zip(open_.tolist(), chosen.tolist()):
                if token != EOS_ID:
                    made[i].append(token)
                    last[i] = token
            open_ = open_[chosen != EOS_ID]
            if not len(open_):
                break
        return made

    @F.arrow_udf("array<int>")
    def sample(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        rows = max(1, SCORES_AT_ONCE // size)
        for last, draws in batches:
            made: list[list[int]] = []
            for at in range(0, len(last), rows):
                part = draws.slice(at, rows)
                made += walk(last.slice(at, rows).to_pylist(), part.flatten().to_numpy().reshape(len(part), -1))
            yield pa.array(made, pa.list_(pa.int32()))

    return sample


def continue_greedy(prompts: DataFrame, model: ContextModel, max_new_tokens: int) -> DataFrame:
    """Add ``generated``: the most probable token each time, ended before the end marker.

    ``prompts`` has ``ids``. The best token depends on the context alone, so it is looked
    up, not computed per prompt; contexts never seen share one.
    """
    best = vec.argmax(model.logits(F.col("c"), F.col("by_target")))
    table = materialize(model.table.select(F.col("input_id").alias("_last"), best.alias("_best")), "best_tokens")
    other = max(range(len(model.p1)), key=lambda i: (model.p1[i], -i)) if model.p1 else None
    if 0 < len(model.p1) <= CONSTANT_IDS:
        # One row per context, no more than the vocabulary.
        best_of = {r["_last"]: r["_best"] for r in table.collect()}
        return _followed(prompts, [best_of.get(i, other) for i in range(len(model.p1))], max_new_tokens)
    choose = lambda step: F.coalesce("_best", F.lit(other))
    return _continue(prompts, table, len(model.p1) <= BROADCAST_PAIRS, max_new_tokens, choose)


def continue_sampled(
    prompts: DataFrame,
    model: ContextModel,
    max_new_tokens: int,
    key: list[str],
    *,
    t: float = 1.0,
    k: int = 0,
    p: float = 1.0,
    penalty: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """Add ``generated``: tokens drawn from the filtered distribution.

    ``key`` identifies a prompt; the draw hashes seed, step and key. What meets the prompts are
    the sparse counts of their contexts: while they are few all steps run in one pass of the
    tasks, otherwise they are joined step by step. Vectors live in the row only.
    """
    table = materialize(model.table.withColumnRenamed("input_id", "_last"), "contexts")
    pairs = table.agg(F.sum(F.size("by_target"))).first()[0] or 0
    if pairs <= BROADCAST_PAIRS and model.p1 and max_new_tokens > 0:
        draws = F.array(*[uniform(seed, F.lit(step), *[F.col(c) for c in key]) for step in range(max_new_tokens)])
        sample = _sampler(model, table, t=t, k=k, p=p, penalty=penalty)
        return prompts.withColumn("generated", sample(F.element_at("ids", -1), draws))
    logits = model.logits(F.col("c"), F.col("by_target"))

    def choose(step: int):
        u = uniform(seed, F.lit(step), *[F.col(c) for c in key])
        dist = vec.sampling_distribution(logits, F.col("generated"), t=t, k=k, p=p, penalty=penalty)
        return vec.with_let(dist, lambda d: vec.draw(d, u))

    return _continue(prompts, table, pairs <= BROADCAST_PAIRS, max_new_tokens, choose)


def prompt_context(prompts: DataFrame, seq_len: int) -> DataFrame:
    """Cut prompts to the ids a model can see."""
    return prompts.withColumn("ids", last_ids(F.col("ids"), seq_len))
