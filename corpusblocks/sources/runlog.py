"""Training logs and configurations on disk."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNLOG_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("run_id", T.LongType()),
    T.StructField("step", T.LongType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("perplexity", T.DoubleType()),
    T.StructField("tokens", T.LongType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("config", T.StringType()),
])

# Model configuration fields and their defaults.
CONFIG_DEFAULTS = {
    "vocab_size": 1024,
    "seq_len": 256,
    "d_model": 128,
    "n_layers": 7,
    "n_heads": 4,
    "dropout": 0.0,
}


def append_runlog(rows: DataFrame, path: str) -> None:
    """Append records; fields a record does not have are NULL.

    ``kind`` tells measurements from best, last and summary records; ``config``
    is the model configuration as JSON.
    """
    have = set(rows.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RUNLOG_SCHEMA
    ]
    rows.select(*columns).write.mode("append").parquet(path)


def read_runlog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNLOG_SCHEMA).parquet(path)


# Fixed value: what a record nests. ``val`` stands in best records, ``learning_rate`` in last ones.
RECORD_SCHEMA = (
    "kind string, run_id bigint, step bigint, val struct<loss: double, perplexity: double, tokens: bigint>, "
    "config struct<vocab_size: bigint, seq_len: bigint, d_model: bigint, n_layers: bigint, n_heads: bigint, dropout: double>, "
    "learning_rate double"
)


def write_records(records: DataFrame, path: str) -> None:
    """Write checkpoint records as JSON documents, a folder per kind.

    The evaluation of a best record is nested under ``val``, the configuration, completed by
    the defaults, under ``config``.
    """
    have = set(records.columns)
    value = F.struct(*[
        (F.col(n) if n in have else F.lit(None)).cast(t).alias(n)
        for n, t in (("loss", "double"), ("perplexity", "double"), ("tokens", "bigint"))
    ])
    records.select(
        "kind", "run_id", "step", F.when(F.col("kind") == "best", value).alias("val"),
        F.struct(*with_defaults(F.col("config"), CONFIG_DEFAULTS)).alias("config"), "learning_rate",
    ).write.mode("overwrite").partitionBy("kind").json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoint records with ``val`` and ``config`` nested."""
    return spark.read.schema(RECORD_SCHEMA).json(path)


def _sql_type(value) -> str:
    return {int: "bigint", float: "double", str: "string", bool: "boolean"}[type(value)]


def with_defaults(json: Column, defaults: Mapping[str, object]) -> list[Column]:
    """One column per field of a JSON object, with its default where it is absent.

    Text that is not a JSON object gives the defaults throughout.
    """
    schema = ", ".join(f"`{name}` {_sql_type(value)}" for name, value in defaults.items())
    parsed = F.from_json(json, schema)
    return [F.coalesce(parsed[name], F.lit(value)).alias(name) for name, value in defaults.items()]


def read_checkpoint_configs(spark: SparkSession, path: str) -> DataFrame:
    """``config`` objects of checkpoint records (one JSON document per file), defaults filled in."""
    raw = spark.read.text(path, wholetext=True)
    config = F.get_json_object("value", "$.config")
    return raw.select(*with_defaults(config, CONFIG_DEFAULTS))
