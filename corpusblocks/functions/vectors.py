"""Score vectors: log-softmax, sampling filters, draws.

A score vector is an array of doubles indexed by token id. All work stays inside
the row, so none of these expressions causes a shuffle. Filtered distributions
keep all positions; a removed token has probability 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def log_sum_exp(logits: Column) -> Column:
    top = F.array_max(logits)
    return top + F.log(F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - top)))


def log_softmax(logits: Column) -> Column:
    """Apply to a materialized column: the normaliser is computed once per row by ``with_let``."""
    return with_let(log_sum_exp(logits), lambda z: F.transform(logits, lambda x: x - z))


def with_let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda variable is bound to its value, whereas an expression repeated
    inside an array function is evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def negative_log_likelihood(logits: Column, target: Column) -> Column:
    """Cross-entropy of one target id under a score vector."""
    return log_sum_exp(logits) - F.get(logits, target)


def temperature(logits: Column, t: float) -> Column:
    """Divide by ``t``; ``t <= 0`` leaves scores as they are."""
    if t <= 0:
        return logits
    divisor = max(1e-6, t)
    return F.transform(logits, lambda x: x / divisor)


def repetition_penalty(logits: Column, generated: Column, penalty: float) -> Column:
    """Divide the scores of ids already generated, whatever their sign; off at ``penalty <= 1``."""
    if penalty <= 1:
        return logits
    return F.transform(
        logits, lambda x, i: F.when(F.array_contains(generated, i), x / penalty).otherwise(x)
    )


def softmax(logits: Column) -> Column:
    def normalised(weights: Column) -> Column:
        return with_let(_sum(weights), lambda s: F.transform(weights, lambda w: w / s))

    def exponentials(top: Column) -> Column:
        return F.transform(logits, lambda x: F.exp(x - top))

    return with_let(with_let(F.array_max(logits), exponentials), normalised)


def _ranking(probs: Column) -> Column:
    # Highest probability first, ties by ascending id.
    return F.sort_array(F.transform(probs, lambda p, i: F.struct((-p).alias("n"), i.alias("id"))))


def _keep_ranked(probs: Column, kept: Column) -> Column:
    """Zero every position that ranks below the last entry of ``kept``."""
    def mask(last: Column) -> Column:
        inside = lambda p, i: (-p < last["n"]) | ((-p == last["n"]) & (i <= last["id"]))
        return F.transform(probs, lambda p, i: F.when(inside(p, i), p).otherwise(F.lit(0.0)))

    return with_let(F.element_at(kept, -1), mask)


def top_k(probs: Column, k: int) -> Column:
    """Keep the ``k`` most probable tokens; off when ``k`` is not inside ``(0, V)``."""
    if k <= 0:
        return probs
    kept = F.slice(_ranking(probs), 1, k)
    return F.when(F.size(probs) <= k, probs).otherwise(_keep_ranked(probs, kept))


def top_p(probs: Column, p: float) -> Column:
    """Keep the shortest prefix of the ranking with mass ``>= p``, at least one token.

    The masses are taken as they come: after ``top_k`` they do not sum to 1. Off
    when ``p >= 1``.
    """
    if p >= 1:
        return probs

    def prefix(ranked: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("n"))

        def step(acc: Column, x: Column) -> Column:
            wanted = (acc["n"] == 0) | (acc["mass"] < p)
            taken = F.struct((acc["mass"] - x["n"]).alias("mass"), (acc["n"] + 1).alias("n"))
            return F.when(wanted, taken).otherwise(acc)

        return F.slice(ranked, F.lit(1), F.aggregate(ranked, start, step)["n"])

    return _keep_ranked(probs, with_let(_ranking(probs), prefix))


def renormalise(probs: Column) -> Column:
    """Divide by the sum; without any mass, uniform over all tokens."""
    def scaled(s: Column) -> Column:
        uniform = F.lit(1.0) / F.size(probs)
        return F.transform(probs, lambda p: F.when(s > 0, p / s).otherwise(uniform))

    return with_let(_sum(probs), scaled)


def filtered(probs: Column, k: int = 0, p: float = 1.0) -> Column:
    """Top-k, then top-p, then renormalised."""
    by_k = lambda v: top_k(v, k)
    by_p = lambda v: top_p(v, p)
    return with_let(with_let(with_let(probs, by_k), by_p), renormalise)


def sampling_distribution(
    logits: Column,
    generated: Column | None = None,
    *,
    t: float = 1.0,
    k: int = 0,
    p: float = 1.0,
    penalty: float = 1.0,
) -> Column:
    """Temperature, penalty, softmax and filters in the order decoding applies them."""
    scored = with_let(logits, lambda v: temperature(v, t))
    if generated is not None:
        scored = with_let(scored, lambda v: repetition_penalty(v, generated, penalty))
    return filtered(with_let(scored, softmax), k, p)


def draw(probs: Column, u: Column) -> Column:
    """Token at ``u`` of the cumulative distribution in id order.

    The first id whose running sum exceeds ``u``; the last id with any mass when
    rounding leaves the sum below ``u``.
    """
    start = F.struct(F.lit(0.0).alias("mass"), F.lit(-1).alias("id"), F.lit(False).alias("done"))

    def step(acc: Column, x: Column) -> Column:
        mass = acc["mass"] + x["p"]
        moved = F.struct(mass.alias("mass"), x["i"].alias("id"), (mass > u).alias("done"))
        return F.when(acc["done"] | (x["p"] <= 0), acc).otherwise(moved)

    indexed = F.transform(probs, lambda p, i: F.struct(p.alias("p"), i.alias("i")))
    return F.aggregate(indexed, start, step)["id"]


def argmax(scores: Column) -> Column:
    """Smallest id with the highest score."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
