"""Tokenisation: split on Unicode white space (the White_Space property),
no case folding, no punctuation stripping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator class. Java's \s covers tab, LF, VT, FF, CR and
# space; \p{Z} adds the Unicode space, line and paragraph separators
# (U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000);
# \x{85} is NEL. Together they are Unicode White_Space.
TOKEN_SPLIT = r"[\s\p{Z}\x{85}]+"

# The same class in RE2 (DuckDB), whose \s lacks VT.
TOKEN_SPLIT_SQL = r"[\s\p{Z}\x{85}\x0b]+"


def tokens(text: Column) -> Column:
    """Array of tokens; may hold empty strings at the ends (filter them)."""
    return F.split(text, TOKEN_SPLIT)
