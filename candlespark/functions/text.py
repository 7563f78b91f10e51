"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters to delete. Four single symbols and the alarm clock, then everything
# from U+24C2 upward.
SYMBOL_CLASS = r"[\x{200D}\x{231A}\x{23CF}\x{23E9}\x{23F0}\x{24C2}-\x{10FFFF}]+"
# White space that is stripped from the start of a line (all but the line feed).
LINE_START_SPACE = (
    r"(^|\n) [ \t\r\x0B\f\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*"
)
# White space between words.
WORD_BREAK = r"[ \t\n\r\f\x0B]+"


def clean_text(text: Column) -> Column:
    """Delete emoji and other symbols, collapse runs of spaces, strip lines that start with a space."""
    without_symbols = F.regexp_replace(text, SYMBOL_CLASS, "")
    single_spaced = F.regexp_replace(without_symbols, "  +", " ")
    return F.regexp_replace(single_spaced, LINE_START_SPACE, "$1")


def may_hold_symbols(text: Column) -> Column:
    """False only for text without any of the symbols: all ASCII, or nothing from U+200D upward."""
    return (F.octet_length(text) != F.length(text)) & text.rlike(r"[\x{200D}-\x{10FFFF}]")
