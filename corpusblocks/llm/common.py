"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_held: list = []


def held(load: Callable, *key):
    """``load(*key)``, kept until another model is asked for.

    Python workers serve one stage after another: only the model in use stays in memory.
    """
    if not _held or _held[0] != (load, key):
        _held.clear()
        _held.extend([(load, key), load(*key)])
    return _held[1]


#: Rows of a batch whose results are held at once.
SLICE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark from wherever the folder is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold_of(key: str, folds: int) -> Column:
    """``crc32(key as text) mod folds``; a null key counts as fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def add_columns(
    df: DataFrame, inputs: list[str], fields: str, compute: Callable[[pa.Table], dict[str, list]]
) -> DataFrame:
    """Append ``fields`` (a DDL string), computed by ``compute`` from batches of ``inputs``.

    Only the inputs travel to Python, and results go back ``SLICE`` rows at a time.
    New columns replace old ones of the same name.
    """
    wanted = _schema(fields)

    def run(batches: Iterator[pa.Array | tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            arrays = list(batch) if isinstance(batch, tuple) else [batch]
            rows = pa.table(arrays, names=inputs)
            for at in range(0, max(1, rows.num_rows), SLICE):
                out = compute(rows.slice(at, SLICE).combine_chunks())
                columns = [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], _ARROW[t]) for n, t in wanted]
                yield pa.StructArray.from_arrays(columns, names=[n for n, _ in wanted])

    udf = F.arrow_udf(run, fields, F.ArrowUDFType.SCALAR_ITER)
    own = "_added"
    while own in df.columns:
        own += "_"
    added = df.select("*", udf(*[F.col(c) for c in inputs]).alias(own))
    names = [n for n, _ in wanted]
    kept = [F.col(c) for c in df.columns if c not in names]
    return added.select(*kept, *[F.col(f"{own}.{n}").alias(n) for n in names])


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """The rows of ``df`` in one column ``_row`` beside the named ones, so that no names clash."""
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"), *[e.alias(n) for n, e in named.items()])


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
}


def _schema(fields: str) -> list[tuple[str, str]]:
    return [tuple(f.strip().split(" ", 1)) for f in fields.split(",")]

