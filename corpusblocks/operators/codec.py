"""Encoding text to ids and decoding ids to text."""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusblocks.functions.ids import FIRST_BYTE_ID, UNK_ID, without_markers
from corpusblocks.functions.text import WORD_MARK
from corpusblocks.functions.vectors import with_let
from corpusblocks.session import join_lookup

# A task remembers this many words, none longer than CACHED_LENGTH, before it
# starts over; bounds its memory on corpora whose words never repeat.
CACHE_WORDS = 500_000
CACHED_LENGTH = 64


@dataclass(frozen=True)
class Tokenizer:
    """Merge list and piece ids; both are as small as the vocabulary."""

    merges: tuple[tuple[str, str], ...]
    ids: dict[str, int]

    @staticmethod
    def of(merges: Iterable[tuple], vocab: DataFrame) -> "Tokenizer":
        # One row per vocabulary entry: bounded by the vocabulary size.
        rows = vocab.where(F.col("kind").isin("merge", "char")).select("piece", "token_id").collect()
        return Tokenizer(
            tuple((m[0], m[1]) for m in merges), {r["piece"]: r["token_id"] for r in rows}
        )

    def segmenter(self):
        return segmenter(self)


def segmenter(tokenizer: Tokenizer):
    """Function from a marked word to its ids, by replaying the merges in order."""
    ranks: dict[tuple[str, str], list[int]] = {}
    for rank, pair in enumerate(tokenizer.merges):
        ranks.setdefault(pair, []).append(rank)
    ids = tokenizer.ids

    def next_rank(pair: tuple[str, str], start: int) -> int | None:
        at = ranks.get(pair)
        if at is None:
            return None
        i = bisect_left(at, start)
        return at[i] if i < len(at) else None

    def replay_in_place(word: str) -> list[str]:
        # Every merge is one pass in C: quick on words of any length.
        s = "".join(f" {ch} " for ch in word)
        for left, right in tokenizer.merges:
            s = s.replace(f" {left}  {right} ", f" {left}{right} ")
        return s[1:-1].split("  ")

    def replay_by_rank(word: str) -> list[str]:
        # Only merges present in the word are looked at: quick on short words.
        symbols, start = list(word), 0
        while ranks and len(symbols) > 1:
            todo = [(r, p) for p in zip(symbols, symbols[1:]) if (r := next_rank(p, start)) is not None]
            if not todo:
                break
            rank, (left, right) = min(todo)
            merged, i = [], 0
            while i < len(symbols):
                if symbols[i] == left and symbols[i + 1:i + 2] == [right]:
                    merged.append(left + right)
                    i += 2
                else:
                    merged.append(symbols[i])
                    i += 1
            symbols, start = merged, rank + 1
        return symbols

    def segment(word: str) -> array:
        symbols = replay_by_rank(word) if len(word) <= CACHED_LENGTH else replay_in_place(word)
        try:
            return array("i", map(ids.__getitem__, symbols))
        except KeyError:
            out = array("i")
            for s in symbols:
                out.extend([ids[s]] if s in ids else (FIRST_BYTE_ID + b for b in s.encode("utf-8")))
            return out

    return segment


class _WordCache(dict):
    """Ids of words as bytes, segmented on first sight."""

    def __init__(self, segment):
        super().__init__()
        self.segment = segment

    def __missing__(self, word: str) -> bytes:
        found = self.segment(WORD_MARK + word).tobytes() if word else b""
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found


def encoder(tokenizer):
    """Arrow function on a text column: stripped line → ids, without markers.

    ``tokenizer`` offers ``segmenter()``, a function from a marked word to ids.

    Words repeat, so each task segments a word once and copies its ids from then
    on. That needs no shuffle of word occurrences, which a join against a table
    of encoded words would.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of = _WordCache(tokenizer.segmenter()).__getitem__
        for batch in batches:
            encoded = [b"".join(map(ids_of, (line or "").split(" "))) for line in batch.to_pylist()]
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = pa.py_buffer(b"".join(encoded))
            n = int(offsets[-1])
            yield pa.ListArray.from_arrays(
                pa.Int32Array.from_buffers(pa.int32(), len(offsets), [None, pa.py_buffer(offsets)]),
                pa.Int32Array.from_buffers(pa.int32(), n, [None, values]),
            )

    return encode


# Code points from here on stand for ids while characters are translated.
_FIRST_CODE = 0xF0000


def character_ids(line: Column, ids: dict[str, int]) -> Column:
    """Ids of a line under a vocabulary without merges, as an expression.

    Every word gets its mark, and all characters are translated at once into code points
    that stand for their ids; lines with characters outside the vocabulary go character by
    character, those becoming their bytes.
    """
    letters = "".join(ids)
    codes = "".join(chr(_FIRST_CODE + i) for i in ids.values())
    words = F.filter(F.split(F.coalesce(line, F.lit("")), " "), lambda w: w != "")
    marked = F.array_join(F.transform(words, lambda w: F.concat(F.lit(WORD_MARK), w)), "")

    def coded(text: Column) -> Column:
        return F.transform(F.split(F.translate(text, letters, codes), ""), lambda c: F.ascii(c) - _FIRST_CODE)

    def by_character(text: Column) -> Column:
        each = F.transform(F.split(text, ""), lambda c: F.when(
            F.instr(F.lit(letters), c) > 0, coded(c)
        ).otherwise(utf8_ids(c)))
        return F.flatten(each)

    return with_let(marked, lambda text: F.when(text == "", F.array().cast("array<int>")).when(
        F.translate(text, letters, "") == "", coded(text)
    ).otherwise(by_character(text)))


def line_ids(line: Column, tokenizer) -> Column:
    """Ids of a line, without markers.

    Without merges this is an expression. With merges, words are segmented where they first
    occur in a task and copied from there on, which only a function with a memory can do;
    segmenting every occurrence anew inside the row costs a multiple.
    """
    largest = len(getattr(tokenizer, "ids", ())) + FIRST_BYTE_ID + 256
    if isinstance(tokenizer, Tokenizer) and not tokenizer.merges and largest < 0x110000 - _FIRST_CODE:
        return character_ids(line, tokenizer.ids)
    return encoder(tokenizer)(line)


def encode_lines(lines: DataFrame, tokenizer: Tokenizer, line: str = "line", out: str = "ids") -> DataFrame:
    """Replace the text column of ``lines`` by its ids; a narrow operation."""
    return lines.withColumn(out, line_ids(F.col(line), tokenizer)).drop(line)


def utf8_ids(ch: Column) -> Column:
    """Byte-piece ids of a string: one per UTF-8 byte."""
    digits = F.hex(F.encode(ch, "UTF-8"))
    n = F.length(digits)
    return F.transform(
        F.sequence(F.lit(1), n - 1, F.lit(2)),
        lambda i: (F.conv(digits.substr(i, F.lit(2)), 16, 10) + FIRST_BYTE_ID).cast("int"),
    )


def piece_ids(pieces: DataFrame, vocab: DataFrame, piece: str = "piece", out: str = "token_id") -> DataFrame:
    """Look up the id of a piece; the unknown id when it is not in the vocabulary."""
    table = vocab.select(F.col("piece").alias(piece), F.col("token_id").alias("_id"))
    found = join_lookup(pieces, table, [piece], "left")
    return found.select(*pieces.columns, F.coalesce("_id", F.lit(UNK_ID)).alias(out))


def id_pieces(ids: DataFrame, vocab: DataFrame, token_id: str = "token_id", out: str = "piece") -> DataFrame:
    """Look up the piece of an id; NULL when the id is out of range."""
    table = vocab.select(F.col("token_id").alias(token_id), F.col("piece").alias(out))
    return join_lookup(ids, table, [token_id], "left")


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count("*").alias("vocab_size"))


def _piece_hex(vocab: DataFrame) -> DataFrame:
    # UTF-8 bytes of what a piece stands for, as hex: a byte piece is its own two
    # digits, the word mark is a space, unknown is the conventional " ⁇ ".
    text = F.when(F.col("token_id") == UNK_ID, F.lit(" ⁇ ")).otherwise(
        F.replace(F.col("piece"), F.lit(WORD_MARK), F.lit(" "))
    )
    hex_text = F.when(F.col("kind") == "byte", F.col("piece").substr(4, 2)).otherwise(
        F.hex(F.encode(text, "UTF-8"))
    )
    return vocab.select("token_id", hex_text.alias("bytes_hex"))


def decode_ids(rows: DataFrame, vocab: DataFrame, ids: str = "ids", out: str = "text") -> DataFrame:
    """Text of an id array per row, without markers and without the leading space.

    The pieces, as hex of their bytes, are read to the driver (one short string
    per vocabulary entry) and become an array constant indexed by id. Each row is
    then decoded in place: no explode, no shuffle. The bytes of all pieces are
    joined before they are read as UTF-8, so characters spread over byte pieces
    come out whole; invalid byte runs become replacement characters.
    """
    known = {r["token_id"]: r["bytes_hex"] for r in _piece_hex(vocab).collect()}
    listed = ",".join(known.get(i, "") for i in range(max(known) + 1))
    pieces = F.split(F.lit(listed), ",")
    hex_text = F.array_join(
        F.transform(without_markers(F.col(ids)), lambda i: F.get(pieces, i)), ""
    )
    text = F.make_valid_utf8(F.unhex(hex_text).cast("string"))
    return rows.withColumn(out, F.regexp_replace(text, r"\A ", ""))
