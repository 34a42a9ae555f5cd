"""Cross-tokenizer alignment with inverted pair bitmaps.

Every text is cut by two tokenizers, A and B. Where a token of each ends at the same byte,
the two are linked and a group of tokens ends. The corpus-wide count of a pair of ids is
the number of links that hold it.

Documents are numbered in blocks of ``BLOCK``. An inverted index holds for every pair and
block the documents that link the pair, as compressed bitmaps: one of all documents, and
one plane for every binary digit of the links beyond a document's first. A plane is a list
of places while that is short and a bitmap beyond. Postings of the parts of a block are OR-merged where the block
is read; planes of different blocks stand side by side, so no pair gathers in one place
however common it is. Population counts give a pair's documents and, weighed by digit, its
links.

Scores go back along the postings: each plane row is joined with the count of its pair,
the rows of a block are brought together, and every document adds up what its planes say.

A text has no tokens, and zeros, if it is null or empty or if the joined bytes of either
tokenizer differ from a space and the text. Rows are told apart by their place in a
block, not by key, so repeated rows and null keys are rows like others. Empty tables give
no rows.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import held, table
from corpusblocks.llm.token_counts import PLAIN
from corpusblocks.session import materialize

#: Documents of a block: bits of a bitmap.
BLOCK = 2048
#: Documents whose tokens are held at once; their planes are merged into those of the block.
PART = 256
#: A plane of this many documents or more is a bitmap, which then is no longer than the list.
DENSE = BLOCK // 16
#: Bytes of text of a part, and postings of a block, beyond which it is closed early.
PART_BYTES = 8 << 20
BLOCK_POSTINGS = 4 << 20
#: Ids of B below a pair's A id.
B_BITS = 20
#: The plane of all documents beside the planes of digits; it weighs one link.
DOCUMENTS = -1


def _byte_level() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


class _Side:
    """Byte strings of a vocabulary, for looking up many ids at once."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pa.array(pieces, pa.large_binary())
        self.lengths = np.array([len(p) for p in pieces], np.int64)

    def joined(self, ids: np.ndarray) -> memoryview:
        taken = self.pieces.take(pa.array(ids))
        first, last = (taken.offset, taken.offset + len(taken))
        offsets = np.frombuffer(taken.buffers()[1], np.int64)
        return memoryview(taken.buffers()[2] or b"").cast("B")[offsets[first]: offsets[last]]

    def equal(self, lists: list[list[int]], wanted: list[bytes]) -> list[bool]:
        """Whether the bytes of each list of ids are those wanted."""
        ids = _flat(lists)
        text = self.joined(ids)
        ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        at = ends[np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])].tolist()
        return [text[i:j] == w for i, j, w in zip(at, at[1:], wanted)]


class Aligner:
    """Both tokenizers, loaded from their files."""

    def __init__(self, a_path: str, ranks_path: str | None, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark holds the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.ranks = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = _byte_level()
        entries = (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        self.a_side = _Side([
            bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode("utf-8") for e in entries
        ])
        self.b_side = _Side([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
            for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]
        ])
        # Ids as text with what follows them: nothing, comma, bar or semicolon.
        size = max(len(self.a_side.lengths), len(self.b_side.lengths))
        self.size = size
        self.written = _Side([f"{i}{end}".encode() for end in ("", ",", "|", ";") for i in range(size)])

    def a_ids(self, text: str) -> list[int]:
        # Plain characters split the same way in both libraries; ranks encode several times faster.
        if self.ranks is not None and not PLAIN.search(text):
            return self.ranks.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def align(self, texts: list[str | None]) -> "Alignment":
        texts = [t or "" for t in texts]
        wanted = [(" " + t).encode("utf-8") if t else b"" for t in texts]
        a_ids = [self.a_ids(" " + t) if t else [] for t in texts]
        b_ids = [ids if t else [] for t, ids in zip(texts, self.b.encode(texts, num_threads=1))]
        same = [x and y for x, y in zip(self.a_side.equal(a_ids, wanted), self.b_side.equal(b_ids, wanted))]
        return Alignment(
            self, [x if s else [] for x, s in zip(a_ids, same)], [x if s else [] for x, s in zip(b_ids, same)]
        )


class Alignment:
    """Tokens of several texts one after the other, and their links.

    All texts of a batch have equal bytes on both sides, so their tokens can be laid on one line.
    """

    def __init__(self, aligner: Aligner, a_ids: list[list[int]], b_ids: list[list[int]]):
        self.n_a = np.array([len(x) for x in a_ids], np.int64)
        self.n_b = np.array([len(x) for x in b_ids], np.int64)
        self.a, self.b = _flat(a_ids), _flat(b_ids)
        a_ends = np.cumsum(aligner.a_side.lengths[self.a])
        b_ends = np.cumsum(aligner.b_side.lengths[self.b])
        # Places of the tokens that end a group, in A and in B; groups and links are the same in number.
        _, self.a_last, self.b_last = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        self.document = np.repeat(np.arange(len(a_ids)), self.n_a)[self.a_last]
        self.n_links = np.bincount(self.document, minlength=len(a_ids))
        self.aligner = aligner

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pair of every link, ``a << B_BITS | b``, and its document."""
        return self.a[self.a_last] << B_BITS | self.b[self.b_last], self.document

    def digests(self) -> list[str]:
        """Hash of the written groups per text, empty without tokens."""
        n_a, n_b = len(self.a), len(self.b)
        # Token i of A stands behind all B tokens of earlier groups, token j of B behind A's of its own group as well.
        group_a = np.searchsorted(self.a_last, np.arange(n_a))
        group_b = np.searchsorted(self.b_last, np.arange(n_b))
        b_before = np.concatenate([[0], self.b_last + 1])
        place_a = np.arange(n_a) + b_before[group_a]
        place_b = np.arange(n_b) + self.a_last[group_b] + 1
        size, codes = self.aligner.size, np.empty(n_a + n_b, np.int64)
        codes[place_a] = self.a + size
        codes[place_b] = self.b + size
        codes[place_a[self.a_last]] += size
        codes[place_b[self.b_last]] += 2 * size
        ends = np.cumsum(self.n_a + self.n_b)
        codes[ends[(self.n_a > 0)] - 1] -= 3 * size
        text = self.aligner.written.joined(codes)
        widths = np.concatenate([[0], np.cumsum(self.aligner.written.lengths[codes])])
        starts = np.concatenate([[0], ends])
        return [
            hashlib.sha256(text[widths[i]: widths[j]]).hexdigest() if j > i else ""
            for i, j in zip(starts[:-1].tolist(), starts[1:].tolist())
        ]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair, place in the block and number of links of every posting, from those of the block's parts.

    Parts hold different documents, so merging sets no bit twice.
    """
    keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return keys // BLOCK, keys % BLOCK, counts[order]


def planes(pair: np.ndarray, place: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
    """``(digit, pairs, planes, population)`` of postings sorted by pair and place.

    Digit ``DOCUMENTS`` is the bitmap of all documents that link the pair; the others
    are the binary digits of the links a document has beyond its first.
    """
    for digit in range(DOCUMENTS, int(count.max(initial=1) - 1).bit_length()):
        chosen = slice(None) if digit == DOCUMENTS else (count - 1) >> digit & 1 == 1
        pairs, first, sizes = np.unique(pair[chosen], return_index=True, return_counts=True)
        places = place[chosen].astype("<u2")
        dense = sizes >= DENSE
        listed = ~np.repeat(dense, sizes)
        offsets = np.concatenate([[0], np.cumsum(2 * sizes[~dense])]).astype(np.int32)
        lists = pa.BinaryArray.from_buffers(
            pa.binary(), int((~dense).sum()), [None, pa.py_buffer(offsets), pa.py_buffer(places[listed].tobytes())]
        )
        yield digit, pairs[~dense], lists, sizes[~dense]
        maps = []
        for start, size in zip(first[dense], sizes[dense]):
            bits = np.zeros(BLOCK, np.uint8)
            bits[places[start: start + size]] = 1
            maps.append(np.packbits(bits, bitorder="little").tobytes())
        yield digit, pairs[dense], pa.array(maps, pa.binary()), sizes[dense]


def members(planes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(row, place)`` of every bit set in an array of planes."""
    sizes = pc.binary_length(planes).to_numpy(zero_copy_only=False).astype(np.int64)
    rows, places = [], []
    for dense in (False, True):
        which = np.flatnonzero((sizes == BLOCK // 8) == dense)
        data = np.frombuffer(b"".join(planes.take(pa.array(which)).to_pylist()), np.uint8)
        if dense:
            row, place = np.nonzero(np.unpackbits(data.reshape(len(which), BLOCK // 8), axis=1, bitorder="little"))
            rows.append(which[row])
        else:
            place = data.view("<u2")
            rows.append(np.repeat(which, sizes[which] // 2))
        places.append(place.astype(np.int64))
    return np.concatenate(rows), np.concatenate(places)


_INDEX = (
    "block long, place int, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, "
    "pair long, digit int, plane binary, population long"
)


def inverted_index(
    docs: DataFrame, paths: tuple[str, str | None, str], block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """Two kinds of rows of ``docs(doc_id, text)``, written once.

    With ``place``: what is known of a document. With ``pair``: a plane of that pair in its block.
    A block of very long documents is closed at ``block_postings``, which bounds its memory.
    """
    schema = pa.schema([
        ("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pair", pa.int64()), ("digit", pa.int32()),
        ("plane", pa.binary()), ("population", pa.int64()),
    ])

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
        )

    def constant(value: int, n: int, kind: pa.DataType) -> pa.Array:
        return pa.array(np.full(n, value), kind)

    def posted(block: int, parts: list) -> Iterator[pa.RecordBatch]:
        if parts:
            for digit, pairs, found, population in planes(*merged(parts)):
                if len(pairs):
                    yield rows(
                        len(pairs), block=constant(block, len(pairs), pa.int64()), pair=pa.array(pairs, pa.int64()),
                        digit=constant(digit, len(pairs), pa.int32()), plane=found, population=pa.array(population, pa.int64()),
                    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(Aligner, *paths)
        block, filled, parts = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(sizes, PART_BYTES + (sizes[at - 1] if at else 0), "right"))
                n = max(1, min(PART, BLOCK - filled, fits - at))
                part = batch.slice(at, n)
                found = aligner.align(part.column(1).to_pylist())
                pair, document = found.links()
                parts.append(np.unique(pair * BLOCK + document + filled, return_counts=True))
                yield rows(
                    n, block=constant(block, n, pa.int64()), place=pa.array(np.arange(filled, filled + n), pa.int32()),
                    doc_id=part.column(0), n_a=pa.array(found.n_a), n_b=pa.array(found.n_b), n_links=pa.array(found.n_links),
                    groups_sha256=pa.array(found.digests(), pa.string()),
                )
                at, filled = at + n, filled + n
                if filled == BLOCK or sum(len(keys) for keys, _ in parts) > block_postings:
                    yield from posted(block, parts)
                    block, filled, parts = block + 1, 0, []
        yield from posted(block, parts)

    return materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _INDEX), "pair-index")


def pair_counts(index: DataFrame) -> DataFrame:
    """``(pair, a, b, links, documents)`` from the population counts of the planes."""
    weighed = F.expr("shiftleft(population, greatest(digit, 0))")
    counted = index.where("pair is not null").groupBy("pair").agg(
        F.sum(weighed).alias("links"), F.sum(F.when(F.col("digit") == DOCUMENTS, F.col("population"))).alias("documents")
    )
    return counted.select(
        "pair", F.shiftright("pair", B_BITS).alias("a"), (F.col("pair") % (1 << B_BITS)).alias("b"), "links", "documents"
    )


def aligned_documents(index: DataFrame) -> DataFrame:
    """Documents of the index with ``n_best`` and ``count_sum`` gathered from the postings."""
    counts = materialize(pair_counts(index), "pair-counts")
    # One row per id of B: bounded by its vocabulary.
    best = counts.groupBy("b").agg(F.max("links").alias("most"))
    scored = counts.join(F.broadcast(best), "b").select(
        "pair", "links", (F.col("links") == F.col("most")).alias("best")
    )
    postings = index.where("pair is not null").select("block", "pair", "digit", "plane")
    scored = postings.join(scored, "pair").select("block", "digit", "plane", "links", "best")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a block follow each other; two rows of sums are all that is held.
        block, sums = None, None

        def ended() -> Iterator[pa.RecordBatch]:
            if block is not None:
                place = np.flatnonzero(sums[1])
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(np.full(len(place), block), pa.int64()), "place": pa.array(place, pa.int32()),
                    "n_best": pa.array(sums[0][place]), "count_sum": pa.array(sums[1][place]),
                })

        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(blocks, prepend=blocks[0] - 1)) if len(blocks) else []
            for start, end in zip(starts, [*starts[1:], len(blocks)]):
                if blocks[start] != block:
                    yield from ended()
                    block, sums = int(blocks[start]), np.zeros((2, BLOCK), np.int64)
                part = batch.slice(start, end - start)
                row, place = members(part.column("plane"))
                digit = part.column("digit").to_numpy(zero_copy_only=False).astype(np.int64)
                weight = np.int64(1) << np.maximum(digit, 0)
                best = part.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
                links = part.column("links").to_numpy(zero_copy_only=False)
                np.add.at(sums[0], place, (weight * best)[row])
                np.add.at(sums[1], place, (weight * links)[row])
        yield from ended()

    by_block = scored.repartition("block").sortWithinPartitions("block")
    sums = by_block.mapInArrow(add_up, "block long, place int, n_best long, count_sum long")
    documents = index.where("place is not null").select(
        "block", "place", "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "groups_sha256"
    )
    return documents.join(sums, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the two given tokenizers over all documents."""
    import public_tokenizers

    paths = tuple(public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
    return aligned_documents(inverted_index(table(spark, sf_dir, "documents"), paths))
