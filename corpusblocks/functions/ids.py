"""Expressions over arrays of token ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ids of the reserved tokens and of the first byte piece.
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3
FIRST_BYTE_ID = 4
# Fixed value: the largest id a 16-bit unsigned integer can hold.
MAX_UINT16 = 65535


def wrap(ids: Column, bos: int = BOS_ID, eos: int = EOS_ID) -> Column:
    """Ids of one example between its begin and end markers."""
    return F.concat(F.array(F.lit(bos)), ids, F.array(F.lit(eos)))


def prompt_prefix(ids: Column, bos: int = BOS_ID) -> Column:
    """Ids of a prompt: begin marker, no end marker."""
    return F.concat(F.array(F.lit(bos)), ids)


def inputs(tokens: Column) -> Column:
    """All ids but the last; empty for blocks shorter than two."""
    return F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))


def targets(tokens: Column) -> Column:
    """All ids but the first; empty for blocks shorter than two."""
    return F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))


def last_ids(ids: Column, n: int) -> Column:
    """The last ``n`` ids, or all of them when there are fewer."""
    return F.slice(ids, F.greatest(F.size(ids) - n + 1, F.lit(1)), F.lit(n))


def without_markers(ids: Column, pad: int = PAD_ID, bos: int = BOS_ID, eos: int = EOS_ID) -> Column:
    """Drop pad, begin and end markers; unknown ids stay."""
    return F.filter(ids, lambda x: ~x.isin(pad, bos, eos))


def id_width(max_id: Column) -> Column:
    """Name of the narrowest unsigned type of 16 or 32 bits that holds ``max_id``."""
    return F.when(max_id <= MAX_UINT16, "uint16").otherwise("uint32")


def fingerprint(ids: Column) -> Column:
    """md5 of the comma-separated ids, to compare arrays across engines."""
    return F.md5(F.array_join(ids.cast("array<string>"), ","))
