"""String building blocks. Blanks are one explicit class (Unicode white space), since engines differ in what \\s means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space, in a notation both Java and RE2 read.
WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
TOKENS_PER_CHAR = 0.6


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(col(c), f"^{WS}+|{WS}+$", "")


def squeeze(c: Column | str) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(col(c), f"{WS}+", " ")


def clean_text(c: Column | str) -> Column:
    """Blanks squeezed, named entities removed, ends stripped (in this order, so a removed entity may leave two blanks)."""
    return strip(F.regexp_replace(squeeze(c), "(?i)&[a-z]+;", ""))


def est_tokens(c: Column | str) -> Column:
    """Estimated tokens: 0.6 per code point, rounded down."""
    return F.floor(F.length(col(c)) * F.lit(TOKENS_PER_CHAR)).cast("int")


def group1(c: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where nothing matches."""
    return F.when(col(c).rlike(pattern), F.regexp_extract(col(c), pattern, group))


def not_empty(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))

