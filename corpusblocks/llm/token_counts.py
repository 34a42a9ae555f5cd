"""Token counts of whole documents by overlap resynchronisation.

A document longer than a chunk is encoded in overlapping chunks with offsets. Two
neighbouring chunks are spliced inside their overlap at a *stable* boundary: a place
before a white-space character that follows another character, where the
tokenizer's word pattern ends a word whatever stands around it, and where both
encodings have a token boundary. Tokens left of it are counted from the left chunk,
tokens right of it from the right chunk. Where an overlap holds no such place the
right chunk starts earlier, doubling the overlap, down to the document's start.

Texts that fit one chunk are encoded directly. Null counts as the empty text.

The counts are those of the tokenizer file (``.json``). Texts of plain characters, for
which word pattern and merges are the same, go through the ranks of the same
vocabulary, which encode several times faster; any other text, and any text that
holds one of the file's special strings, goes through the file itself.
"""

from __future__ import annotations

import base64
import os
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import add_columns, held, table, whole_text

#: Code points of one chunk, and of the first overlap tried.
CHUNK = 16_384
OVERLAP = 256


#: Characters that every Unicode version and both libraries' patterns classify alike.
PLAIN = re.compile(r"[^\t\n\r -~\u00a1-\u00ac\u00ae-\u024f\u2010-\u2027\u20ac]")


class Encoder:
    """Token counts and token starts of a text, as the tokenizer file gives them."""

    def __init__(self, path: str, ranks_path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark holds the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ranks = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in added) or r"(?!)")

    def plain(self, text: str) -> bool:
        return self.ranks is not None and not PLAIN.search(text) and not self.special.search(text)

    def count(self, text: str) -> int:
        if self.plain(text):
            return len(self.ranks.encode_ordinary(text))
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def starts(self, text: str) -> list[int]:
        """Where the tokens start, in code points."""
        if self.plain(text):
            ids = self.ranks.encode_ordinary(text)
            places = [0, *accumulate(map(len, self.ranks.decode_tokens_bytes(ids)[:-1]))]
            if text.isascii():
                return places
            opens = np.frombuffer(text.encode("utf-8"), np.uint8) & 0xC0 != 0x80  # first bytes of code points
            return (np.cumsum(opens) - 1)[places].tolist()
        return [start for start, _ in self.tokenizer.encode(text, add_special_tokens=False).offsets]


def load(path: str, ranks_path: str | None = None) -> Encoder:
    return held(Encoder, path, ranks_path)


def _stable(text: str, place: int) -> bool:
    return 0 < place < len(text) and text[place].isspace() and not text[place - 1].isspace()


def splice_count(encoder: Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of a text, from chunks that never exceed ``chunk`` plus the widened overlap."""
    if len(text) <= chunk:
        return encoder.count(text)
    total, end = 0, chunk
    starts = encoder.starts(text[:end])
    counted_to = 0  # tokens that start before this place are counted
    while end < len(text):
        width = overlap
        while True:
            right_begin = max(counted_to, end - width)
            right_end = min(len(text), right_begin + width + chunk)
            right = [right_begin + s for s in encoder.starts(text[right_begin:right_end])]
            place = _splice(text, starts, right, right_begin, end)
            if place is not None or right_begin == counted_to:
                break
            width *= 2
        if place is None:
            # Not even the whole uncounted part has a common boundary: the right chunk replaces the left one.
            starts, end = right, right_end
            continue
        total += bisect_left(starts, place) - bisect_left(starts, counted_to)
        starts, counted_to, end = right, place, right_end
    return total + len(starts) - bisect_left(starts, counted_to)


def _splice(text: str, left: list[int], right: list[int], begin: int, end: int) -> int | None:
    """The last stable place inside the overlap at which tokens of both encodings start."""
    own = set(right)
    for k in range(bisect_left(left, end) - 1, -1, -1):
        place = left[k]
        if place <= begin:
            return None
        if place in own and _stable(text, place):
            return place
    return None


def count_tokens(
    df: DataFrame,
    path: str,
    ranks_path: str | None = None,
    column: str = "text",
    out: str = "n_tokens",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Add the number of tokens of each whole text (null and empty: 0).

    ``ranks_path`` names the ranks of the vocabulary in ``path``, if there are any.
    """

    def compute(batch: pa.Table) -> dict[str, list]:
        encoder = load(path, ranks_path)
        return {out: [splice_count(encoder, t or "", chunk, overlap) for t in batch.column(0).to_pylist()]}

    return add_columns(df, [column], f"{out} long", compute)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the byte-level vocabulary, and whether they exceed 1,024."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    counted = count_tokens(docs, *files)
    return counted.select(
        "doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )
