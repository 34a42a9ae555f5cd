"""Line and word expressions over text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that count as white space when a line is stripped.
WHITESPACE = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
# Fixed value: the mark a subword piece carries in place of a leading space.
WORD_MARK = chr(0x2581)


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone only removes U+0020)."""
    return F.btrim(col, F.lit(WHITESPACE))


def lines(text: Column) -> Column:
    """Array of the lines of a text, ended by LF, CR or CRLF; neither stripped nor filtered."""
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.split(unix, "\n")


def words(line: Column) -> Column:
    """Array of the words of a line, unmarked; runs of spaces give empty strings."""
    return F.split(line, " ")


def characters(word: Column) -> Column:
    """Array of the code points of a string."""
    return F.split(word, "")
