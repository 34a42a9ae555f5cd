"""Analytics over training logs: ``(run_id, step, …metrics)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusblocks.operators.prefix import Order, dense_levels, exclusive_prefix
from corpusblocks.session import join_lookup, materialize


def evaluation_rows(log: DataFrame, every: int) -> DataFrame:
    """Rows at multiples of ``every`` and at the first step."""
    return log.where((F.col("step") % every == 0) | (F.col("step") == 1))


def save_rows(log: DataFrame, every: int) -> DataFrame:
    """Rows at multiples of ``every`` and at the last step of each run."""
    # Written first, so that checking its size does not scan the log again.
    last = materialize(log.groupBy("run_id").agg(F.max("step").alias("_last")), "last_steps")
    joined = join_lookup(log, last, ["run_id"])
    due = (F.col("step") % every == 0) | (F.col("step") == F.col("_last"))
    return joined.where(due).select(*log.columns)


def improvements(log: DataFrame, metric: str = "perplexity") -> DataFrame:
    """Rows that are strictly better than every earlier step of their run, with ``previous_best``.

    NaN never improves; an equal value does not either. A run may hold most of
    the log, so the running minimum goes by step buckets.
    """
    clean = log.where(~F.isnan(metric) & F.col(metric).isNotNull())
    order = Order(("run_id",), ("step", metric), dense_levels(clean, "step"))  # a repeated step: smaller first
    seen = exclusive_prefix(clean, order, F.col(metric), "previous_best", agg="min")
    better = F.col("previous_best").isNull() | (F.col(metric) < F.col("previous_best"))
    return seen.where(better)


def _one_per_run(rows: DataFrame) -> DataFrame:
    """One of the rows that are left of each run; of several the one with the smallest hash, whatever their order."""
    hashed = rows.withColumn("_hash", F.xxhash64(*rows.columns))
    least = hashed.groupBy("run_id").agg(F.min("_hash").alias("_least"))
    kept = join_lookup(hashed, least, ["run_id"]).where(F.col("_hash") == F.col("_least"))
    return kept.select(*rows.columns).distinct()


def _where_equal(log: DataFrame, column: str, wanted: Column) -> DataFrame:
    """The rows of each run in which ``column`` has the run's ``wanted`` value.

    Only plain numbers are aggregated, so no task sorts its log.
    """
    values = materialize(log.groupBy("run_id").agg(wanted.alias("_value")), "wanted")
    return join_lookup(log, values, ["run_id"]).where(F.col(column) == F.col("_value")).drop("_value")


def best_rows(log: DataFrame, metric: str = "perplexity") -> DataFrame:
    """The row of the smallest metric per run; the earliest step among equals."""
    clean = log.where(~F.isnan(metric) & F.col(metric).isNotNull())
    best = _where_equal(clean, metric, F.min(metric))
    return _one_per_run(_where_equal(best, "step", F.min("step")))


def last_rows(log: DataFrame) -> DataFrame:
    """The row of the highest step per run."""
    return _one_per_run(_where_equal(log, "step", F.max("step")))


def checkpoint_records(
    log: DataFrame, eval_every: int, save_every: int, metric: str = "perplexity",
    config: Column | str | None = None, learning_rate: float | None = None,
) -> DataFrame:
    """The records a run leaves behind: ``(kind, …log columns, config, learning_rate)``, kind best, last or summary.

    Best is chosen among evaluated steps, last among saved steps; the summary holds the
    final step. All carry the model configuration (JSON, one text or an expression over the
    log's columns), last the learning rate as well.
    """
    best = best_rows(evaluation_rows(log, eval_every), metric).withColumn("kind", F.lit("best"))
    last = last_rows(save_rows(log, save_every)).withColumn("kind", F.lit("last"))
    steps = log.groupBy("run_id").agg(F.max("step").alias("step")).withColumn("kind", F.lit("summary"))
    records = best.unionByName(last).unionByName(steps, allowMissingColumns=True)
    rate = F.when(F.col("kind") == "last", F.lit(learning_rate).cast("double"))
    config = config if isinstance(config, Column) else F.lit(config)
    return records.select("kind", *log.columns, config.cast("string").alias("config"), rate.alias("learning_rate"))
