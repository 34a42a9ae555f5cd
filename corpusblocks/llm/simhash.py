"""Near-duplicate documents by SimHash, linked through BK-trees.

A document's fingerprint has a bit set where more than half of the hashes of its word
shingles have it. Fingerprints that differ in few bits are linked, and linked documents
form components.

Distinct fingerprints are dealt into shards: cut into one block more than bits may
differ, two linked fingerprints agree in one block at least, so a shard is a block and
its value. A shard with more than ``SHARD`` fingerprints is dealt again by the blocks of
its remaining bits, until it is small. In a shard a BK-tree is grown whose children hang
at their Hamming distance to the parent; a look-up follows only edges whose distance is
within the radius of the distance to the node. Trees are used where their shard is,
since all its fingerprints are there, rather than sent to every executor: a broadcast of
all trees would grow with the corpus. A shard hands on the links of a spanning forest
only, so a group of copies costs as many links as it has members.

Texts that are null, empty or without words have fingerprint zero and are linked like
any other. Equal fingerprints are one node. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import add_columns, packed, table, whole_text
from corpusblocks.llm.graph import connected_components
from corpusblocks.session import join_lookup, materialize, tidy

WORDS = 3
RADIUS = 3
SEED = 42
BITS = 64
SHARD = 256
#: Hashes whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash of a text, unsigned."""
    from xxhash import xxh64_intdigest

    found = text.encode("utf-8").lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = (ends - np.diff(ends, prepend=0))[: max(1, len(found) - words + 1)].tolist()
    stops = (ends - 1)[min(words, len(found)) - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(starts), BLOCK):
        pieces = zip(starts[k : k + BLOCK], stops[k : k + BLOCK])
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in pieces], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def add_fingerprints(
    df: DataFrame, column: str = "text", out: str = "fingerprint", words: int = WORDS, seed: int = SEED
) -> DataFrame:
    """Add the fingerprint as a signed 64-bit integer."""

    def compute(batch: pa.Table) -> dict[str, pa.Array]:
        prints = [fingerprint(t.as_py() or "", words, seed) for t in batch.column(0)]
        return {out: pa.array(np.array(prints, "<u8").view("<i8"))}

    return add_columns(df, [column], f"{out} long", compute)


class BKTree:
    """Integers by Hamming distance, with a union-find over those that are linked."""

    def __init__(self, radius: int):
        self.radius = radius
        self.keys: list[int] = []
        self.children: list[dict[int, int]] = []
        self.roots: list[int] = []

    def _root(self, node: int) -> int:
        roots = self.roots
        while roots[node] != node:
            roots[node] = roots[roots[node]]
            node = roots[node]
        return node

    def add(self, key: int) -> list[int]:
        """Insert a key; the keys of the groups that it links, one of each."""
        keys, children, radius = self.keys, self.children, self.radius
        new = len(keys)
        keys.append(key)
        children.append({})
        self.roots.append(new)
        if new == 0:
            return []
        node = 0
        while True:
            distance = (keys[node] ^ key).bit_count()
            below = children[node].get(distance)
            if below is None:
                break
            node = below
        linked, stack = [], [0]
        while stack:
            at = stack.pop()
            between = (keys[at] ^ key).bit_count()
            if between <= radius:
                root = self._root(at)
                if root != self._root(new):
                    self.roots[self._root(new)] = root
                    linked.append(keys[at])
            edges = children[at]
            if len(edges) < 2 * radius + 1:
                stack.extend(child for d, child in edges.items() if -radius <= d - between <= radius)
            else:
                near = map(edges.get, range(between - radius, between + radius + 1))
                stack.extend(child for child in near if child is not None)
        children[node][distance] = new
        return linked


def _tree_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree = None, BKTree(radius)
        for batch in batches:
            a, b = [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != shard:
                    shard, tree = key, BKTree(radius)
                unsigned = value & (1 << BITS) - 1
                for other in tree.add(unsigned):
                    a.append(value)
                    b.append(other - (1 << BITS) if other >> BITS - 1 else other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links ``(a, b)`` between distinct ``prints(fingerprint)`` that span their groups.

    Two fingerprints within ``radius`` bits of each other are connected by them.
    """
    blocks = radius + 1
    current = prints.select("fingerprint", F.lit(0).cast("long").alias("_shard"), F.col("fingerprint").alias("_rest"))
    width, found = BITS, []
    while True:
        size = width // blocks
        sizes = [size] * (blocks - 1) + [width - size * (blocks - 1)]
        parts, low = [], 0
        for i, n in enumerate(sizes):
            ones = F.lit((1 << n) - 1).cast("long")
            value = F.shiftrightunsigned("_rest", low).bitwiseAND(ones)
            under = F.col("_rest").bitwiseAND(F.lit((1 << low) - 1).cast("long"))
            over = F.shiftrightunsigned("_rest", low + n) if low + n < width else F.lit(0).cast("long")
            # Shards are named by a hash of their blocks: two of one name are merely searched together.
            name = F.xxhash64("_shard", F.lit(width), F.lit(i), value)
            parts.append(F.struct(name.alias("_shard"), under.bitwiseOR(F.shiftleft(over, low)).alias("_rest")))
            low += n
        dealt = current.select("fingerprint", F.explode(F.array(*parts)).alias("_part"))
        dealt = materialize(dealt.select("fingerprint", "_part.*"), "dealt")
        counts = dealt.groupBy("_shard").agg(F.count("*").alias("_n")).where("_n > 1")
        counts = materialize(counts, "counts")
        last = width - max(sizes) < 2 * blocks
        small = counts if last else counts.where(F.col("_n") <= shard)
        members = join_lookup(dealt.select("_shard", "fingerprint"), small.select("_shard"), ["_shard"])
        found.append(
            members.repartition("_shard").sortWithinPartitions("_shard", "fingerprint")
            .mapInArrow(_tree_links(radius), "a long, b long")
        )
        large = counts.where(F.col("_n") > shard)
        if last or large.isEmpty():
            break
        current = join_lookup(dealt, large.select("_shard"), ["_shard"])
        width -= min(sizes)
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


@tidy
def components(
    df: DataFrame, key: str = "doc_id", column: str = "text", words: int = WORDS, radius: int = RADIUS,
    shard: int = SHARD,
) -> DataFrame:
    """``(key, fingerprint, component_id)`` per document; the component is named by its smallest key."""
    prints = add_fingerprints(df.select(key, column), column, words=words).select(key, "fingerprint")
    prints = materialize(prints, "fingerprints")
    return grouped(prints, key, radius, shard).select(key, "fingerprint", "component_id")


@tidy
def grouped(prints: DataFrame, key: str, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Add ``component_id``, the smallest key of the component, to ``prints(key, fingerprint, ...)``."""
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min(key).alias("_least")), "distinct")
    links = materialize(fingerprint_links(distinct.select("fingerprint"), radius, shard), "links")
    groups = connected_components(links).select(F.col("node").alias("fingerprint"), "component")
    named = distinct.join(groups, "fingerprint", "left").withColumn(
        "_group", F.coalesce("component", "fingerprint")
    )
    named = materialize(named.select("fingerprint", "_group", "_least"), "named")
    least = named.groupBy("_group").agg(F.min("_least").alias("component_id"))
    lookup = named.join(least, "_group").select("fingerprint", "component_id")
    return join_lookup(prints, lookup, ["fingerprint"])


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = components(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


@tidy
def one_per_group(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The rows of ``df`` that stay when every component keeps one document.

    That is the one with the smallest key; of rows with equal keys the one whose text has
    the smallest hash, once. A component in which no key is known keeps its smallest hash.
    """
    last = 2**63 - 1
    keyed = packed(
        df, _key=F.coalesce(F.col(key), F.lit(last)), _tie=F.xxhash64(whole_text(column)), _text=F.col(column)
    )
    narrow = add_fingerprints(keyed.select("_key", "_tie", "_text"), "_text").select("_key", "_tie", "fingerprint")
    narrow = materialize(narrow, "fingerprints")
    groups = grouped(narrow, "_key")
    leaders = groups.where(F.col("_key") == F.col("component_id")).groupBy("component_id").agg(F.min("_tie").alias("_tie"))
    leaders = materialize(leaders.withColumnRenamed("component_id", "_key"), "leaders")
    # The leaders are hashed, the texts pass by; equal rows lie side by side after the join.
    kept = keyed.join(leaders.hint("shuffle_hash"), ["_key", "_tie"]).dropDuplicates(["_key", "_tie"])
    return kept.select("_row.*")
