"""Document tables as corpora: deterministic splits and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.functions import text as tx
from corpusblocks.functions.seeded import bucket
from corpusblocks.operators.prefix import Order, dense_levels
from corpusblocks.session import spread

SPLIT_BUCKETS = 10_000
# Lines of one document per finest bucket of the line order, and documents per next one, as powers of two.
LINE_BITS = 12
DOC_BITS = 6


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` of a corpus stored as Parquet; other columns are not read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spread(docs, "doc_id")


def split_of(key: Column, seed: int = 42, train: float = 0.98, val: float = 0.01) -> Column:
    """Split of a row by a hash of its key: about ``train`` / ``val`` / the rest."""
    b = bucket(seed, key, buckets=SPLIT_BUCKETS)
    return (
        F.when(b < round(train * SPLIT_BUCKETS), "train")
        .when(b < round((train + val) * SPLIT_BUCKETS), "val")
        .otherwise("test")
    )


def assign_splits(docs: DataFrame, key: str = "doc_id", **ratios) -> DataFrame:
    """Add ``split``."""
    return docs.withColumn("split", split_of(F.col(key), **ratios))


def document_lines(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: all columns but ``text``, then ``line_no, line``."""
    keep = [c for c in docs.columns if c != "text"]
    return (
        docs.select(*keep, F.posexplode(tx.lines(F.col("text"))).alias("line_no", "line"))
        .withColumn("line", tx.strip(F.col("line")))
        .where(F.col("line") != "")
    )


def document_order(docs: DataFrame) -> Order:
    """Order of the lines of a document table inside each split.

    The finest bucket holds ``2**LINE_BITS`` lines of one document, so a document of any
    length is split; documents are bucketed above.
    """
    lines = F.struct("doc_id", F.shiftright("line_no", LINE_BITS).alias("part"))
    return Order(
        group=("split",), sort=("line_no",),
        levels=(lines, *dense_levels(docs, "doc_id", first_bits=DOC_BITS)),
    )
