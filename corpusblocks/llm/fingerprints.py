"""Document fingerprints by a homomorphic multiset hash.

Every paragraph (what stands between line ends) is hashed to a wide vector, and the
fingerprint of a text is the sum of its paragraphs' vectors, each lane modulo a power of
two. So it does not depend on the order of paragraphs, and inserting or deleting one adds
or subtracts its vector: nothing else has to be read again.

A vector has two parts. ``EXACT`` lanes modulo 2^16 come from a cryptographic digest of
the paragraph and tell multisets of paragraphs apart. ``SKETCH`` lanes modulo 2^16 count,
with a sign, the byte windows of the paragraph that a rule on their content selects;
their inner products estimate how many windows two texts share, which the exact part
cannot say. Both parts of a text with one paragraph replaced differ by that paragraph only.

Null is the empty text, which has one empty paragraph.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusblocks.llm.common import table, whole_text
from corpusblocks.session import join_lookup, materialize

EXACT = 32
SKETCH = 256
LANES = EXACT + SKETCH
#: Bytes of a window, and one window in how many is selected.
WINDOW = 16
ONE_IN = 4
#: Key values of one bucket of neighbouring documents.
BUCKET = 512

# Odd multipliers that mix the two halves of a window.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def _windows(raw: bytes) -> np.ndarray:
    """Hashes of all selected windows that lie inside one paragraph."""
    if len(raw) < WINDOW:
        return np.zeros(0, np.uint64)
    half = WINDOW // 2
    data = np.frombuffer(raw, np.uint8)
    words = np.ndarray((len(raw) - half + 1,), "<u8", raw, 0, (1,))  # eight bytes from every place
    first, second = words[: len(raw) - WINDOW + 1], words[half:]
    hashes = (first * _MIX[0]) ^ (second * _MIX[1])
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX[2]
    hashes ^= hashes >> np.uint64(32)
    ends = np.concatenate([[0], np.cumsum(data == 10)])
    inside = ends[WINDOW:] == ends[:-WINDOW]
    return hashes[inside & (hashes & np.uint64(ONE_IN - 1) == 0)]


def _digests(paragraphs: list[bytes]) -> np.ndarray:
    joined = b"".join([blake2b(p, digest_size=2 * EXACT).digest() for p in paragraphs])
    return np.frombuffer(joined, "<u2").reshape(-1, EXACT)


def fingerprint(text: str) -> np.ndarray:
    """The vector of a text: ``EXACT`` and ``SKETCH`` lanes of 16 bits."""
    raw = text.encode("utf-8", "surrogatepass")
    paragraphs = raw.split(b"\n")
    hashes = _windows(raw)
    short = [p for p in paragraphs if 0 < len(p) < WINDOW]
    if short:  # paragraphs without any window count as one
        hashes = np.concatenate([hashes, np.frombuffer(b"".join(blake2b(p, digest_size=8).digest() for p in short), "<u8")])
    lanes = (hashes >> np.uint64(8)) % np.uint64(SKETCH)
    signs = np.where(hashes >> np.uint64(63), 1.0, -1.0)
    sketch = np.bincount(lanes.astype(np.int64), signs, SKETCH).astype(np.int64)
    exact = _digests(paragraphs).sum(0, dtype=np.int64)
    return np.concatenate([exact, sketch]).astype(np.uint16)


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprint after inserting (1) or deleting (-1) the paragraphs of ``b``."""
    return (a.astype(np.int64) + sign * b.astype(np.int64)).astype(np.uint16)


def to_text(vector: np.ndarray) -> str:
    return base64.b64encode(vector.astype("<u2").tobytes()).decode("ascii")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of the sketches, 0 to 1; equal fingerprints have 1."""
    if np.array_equal(a, b):
        return 1.0
    x, y = (v[EXACT:].astype(np.int16).astype(np.float64) for v in (a, b))
    norm = float(np.sqrt((x @ x) * (y @ y)))
    return min(1.0, max(0.0, float(x @ y) / norm)) if norm else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last third of code points replaced by as many of the next text's first."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a bucket in order, the first document of the next bucket last."""
    waiting = None

    def row(key, text, vector, other, other_vector):
        changed = edited(text, other)
        changed_vector = fingerprint(changed)
        return (
            key, len(text), sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), to_text(vector),
            to_text(changed_vector), likeness(vector, changed_vector), likeness(vector, other_vector),
        )

    for batch in batches:
        rows = []
        for bucket, guest, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            vector = fingerprint(text)
            if waiting is not None and waiting[0] == bucket:
                rows.append(row(*waiting[1:], text, vector))
            waiting = None if guest else (bucket, key, text, vector)
        if rows:
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _FIELDS.split(", ")])


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows ``(bucket, guest, doc_id, text)`` that hold every document followed by its next one.

    The order is descending ``doc_id``, null last, equal keys by a hash of their text, and
    it closes into a ring. A bucket is a range of ``BUCKET`` keys; its last row is a guest, the
    first row of the bucket that follows, so only one text in a bucket is sent twice and no
    task sees more than a bucket at once. Which bucket follows is found among bucket numbers
    alone, in ranges of 4,096 of them.
    """
    spot = F.coalesce(F.floor(F.col("doc_id") / BUCKET).cast("long"), F.lit(-(2**62)))
    rows = docs.select(
        "doc_id", whole_text().alias("text"), spot.alias("_bucket"),
        F.xxhash64(whole_text()).alias("_tie"), F.coalesce("doc_id", F.lit(-(2**63))).alias("_key"),
    )
    # The first row of every bucket: greatest key, then smallest tie; hash aggregates of plain numbers.
    first = rows.groupBy("_bucket").agg(F.max("_key").alias("_key"))
    heads = rows.select("_bucket", "_key", "_tie").join(first, ["_bucket", "_key"]).groupBy("_bucket", "_key").agg(
        F.min("_tie").alias("_tie")
    )
    heads = materialize(heads.withColumn("_range", F.shiftright("_bucket", 12)), "heads")
    ranges = heads.groupBy("_range").agg(F.max("_bucket").alias("_top"))
    above = W.orderBy("_range")  # one row for 2 million keys
    ranges = ranges.withColumn("_above", F.coalesce(F.lead("_range").over(above), F.min("_range").over(W.partitionBy())))
    # The bucket that comes before a bucket in descending order is the next higher one; the top bucket's is the lowest.
    lowest = heads.groupBy("_range").agg(F.min("_bucket").alias("_bottom"))
    ranges = ranges.join(lowest.withColumnRenamed("_range", "_above"), "_above").select("_range", "_bottom")
    before = heads.join(ranges, "_range").withColumn(
        "_before", F.coalesce(F.lead("_bucket").over(W.partitionBy("_range").orderBy("_bucket")), F.col("_bottom"))
    )
    before = materialize(before.select("_bucket", "_key", "_tie", "_before"), "before")
    guests = join_lookup(rows, before, ["_bucket", "_key", "_tie"])  # one row in BUCKET
    guests = guests.dropDuplicates(["_bucket"]).withColumn("_bucket", F.col("_before"))
    every = rows.withColumn("_guest", F.lit(False)).unionByName(guests.drop("_before").withColumn("_guest", F.lit(True)))
    return (
        every.repartition("_bucket").sortWithinPartitions("_bucket", "_guest", F.col("_key").desc(), "_tie")
        .select("_bucket", "_guest", "doc_id", "text")
    )


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document of ``docs(doc_id, text)``, of its edited text, and their likeness."""
    return neighbours(docs).mapInArrow(_compare, _FIELDS)


def add_fingerprints(df: DataFrame, column: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each whole text."""
    from corpusblocks.llm.common import add_columns

    def compute(batch: pa.Table) -> dict[str, list]:
        return {out: [to_text(fingerprint(t.as_py() or "")) for t in batch.column(0)]}

    return add_columns(df, [column], f"{out} string", compute)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents against their edited texts and next documents."""
    return compare_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))
