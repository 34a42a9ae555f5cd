"""Plain text corpora: one example per line, one file (or folder of part files) per split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.functions import text as tx
from corpusblocks.operators.prefix import Order, dense_levels

# The splits looked for in a folder.
SPLITS = ("train", "val", "test")
# Bytes of file spanned by the second level of the line order, and by one part file, as powers of two.
BLOCK_BITS = 38
FILE_BITS = 42


def _path(spark: SparkSession, path: str):
    """A Hadoop path with its file system, so that any storage Spark reads is asked."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def split_paths(spark: SparkSession, path: str, splits: Sequence[str] = SPLITS) -> list[str]:
    """What to read: the path itself if it is a file, else its ``<split>.txt`` that exist.

    The file system says what a path is, never its name. An absent path is refused.
    """
    found, files = _path(spark, path)
    if not files.exists(found):
        raise FileNotFoundError(path)
    if not files.getFileStatus(found).isDirectory():
        return [path]
    wanted = [f"{path.rstrip('/')}/{s.strip()}.txt" for s in splits if s.strip()]
    return [p for p in wanted if files.exists(_path(spark, p)[0])]


def read_text_corpus(spark: SparkSession, path: str, splits: Sequence[str] = SPLITS) -> DataFrame:
    """``(split, block_start, line_no, line)`` of a text file or a folder of split files.

    A folder is searched for ``<split>.txt``, a file or a folder of numbered part
    files; splits without one give no rows. The stem of a single file names its split.
    Lines end at LF, CR or CRLF, are stripped, and blank ones are dropped. ``line_no``
    grows with the position inside a file block; it is an order key, not a count.
    """
    paths = split_paths(spark, path, splits)
    if not paths:
        return spark.createDataFrame([], "split string, block_start long, line_no long, line string")
    # The split is named by the file, or by the folder that holds the part files.
    place = F.col("_metadata.file_path")
    parts = r"/([^/]+)\.txt/[^/]*$"
    folder = F.regexp_extract(place, parts, 1)
    stem = F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1)
    number = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    file_no = F.when(folder != "", F.coalesce(F.try_to_number(number, F.lit("9" * 9)).cast("long"), F.lit(0))).otherwise(0)
    rows = spark.read.text(paths).select(
        F.when(folder != "", folder).otherwise(stem).alias("split"),
        (F.shiftleft(file_no.cast("long"), FILE_BITS) + F.col("_metadata.file_block_start")).alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        tx.strip(F.col("value")).alias("line"),
    )
    return rows.where(F.col("line") != "")


def write_text_corpus(lines: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write ``lines(split, line, …)`` as ``<split>.txt`` folders of part files, in the order given."""
    for split in [r[0] for r in lines.select("split").distinct().collect()]:  # a handful of names
        rows = lines.where(F.col("split") == split).orderBy(*order).select("line")
        rows.write.mode("overwrite").text(f"{path}/{split}.txt")


def text_order(lines: DataFrame) -> Order:
    """Order of the lines of a text corpus: file blocks, then lines inside a block."""
    return Order(
        group=("split",), sort=("line_no",),
        levels=(F.col("block_start"), *dense_levels(lines, "block_start", first_bits=BLOCK_BITS)),
    )
