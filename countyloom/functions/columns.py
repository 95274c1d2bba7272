"""Column helpers that pin down text, cast and null behaviour in one place.

Every helper takes and returns a Column made of built-in functions, so it stays inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the number spellings accepted from text. Java's parser also takes suffixes ("5d") and
# hexadecimal floats, which are not numbers in the source files.
NUMBER_PATTERN = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?(?i:inf|infinity|nan)"
HEX_PATTERN = r"0[xX][0-9a-fA-F]+"
BINARY_PATTERN = r"0[bB][01]+"

# Fixed value: what is trimmed around codes: the space and the other Unicode space separators.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def trimmed(c: Column | str) -> Column:
    """Without space separators at either end; tabs and line breaks stay."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(SPACES))


def full_match(c: Column, pattern: str) -> Column:
    """True when the whole value matches. `\\z` is used because `$` also matches before a final newline."""
    return c.rlike(rf"\A(?:{pattern})\z")


def has_text(c: Column) -> Column:
    """Not null and not blank after trimming; never null itself."""
    return c.isNotNull() & (trimmed(c) != F.lit(""))


def no_text(c: Column) -> Column:
    """Exact complement of `has_text`."""
    return c.isNull() | (trimmed(c) == F.lit(""))


def text_or_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def missing_or_na(c: Column) -> Column:
    """Null, blank, or the letters NA in any case."""
    return c.isNull() | F.upper(trimmed(c)).isin("", "NA")


def trimmed_in(c: Column, *codes: str) -> Column:
    """Trimmed value is one of the codes; null input gives null."""
    return trimmed(c).isin(*codes)


def _spelling(c: Column, digit: str = "[0-9]") -> Column:
    """A number's text without spaces around it and without single underscores between its digits."""
    text = F.trim(c)
    return F.when(text.contains("_"), F.regexp_replace(text, f"(?<={digit})_(?={digit})", "")).otherwise(text)


# The spellings of most numbers, which one short pattern tells from all others.
USUAL_NUMBER = r"[0-9]+(?:\.[0-9]+)?"
USUAL_INT = "[0-9]{1,9}"


def to_double(c: Column) -> Column:
    """Text to DOUBLE; blanks and anything that is not a decimal number give null."""
    text = _spelling(c)
    return F.when(full_match(c, USUAL_NUMBER), c.try_cast("double")).when(full_match(text, NUMBER_PATTERN), text.try_cast("double"))


def to_int(c: Column) -> Column:
    """Text to INT, rounding fractions half away from zero; 0x and 0b start other bases. Out of range or no number: null."""
    text = _spelling(c, "[0-9a-fA-F]")
    digits = F.substring(text, 3, 64)
    return (
        F.when(full_match(c, USUAL_INT), c.try_cast("int"))
        .when(full_match(text, HEX_PATTERN), F.conv(digits, 16, 10).try_cast("int"))
        .when(full_match(text, BINARY_PATTERN), F.conv(digits, 2, 10).try_cast("int"))
        .otherwise(F.round(to_double(c)).try_cast("int"))
    )


def sum_where(weight: Column, predicate: Column) -> Column:
    """Sum of `weight` over rows where the predicate holds; 0 for a group without such rows."""
    return F.sum(F.when(predicate, weight).otherwise(F.lit(0)))


def count_where(predicate: Column) -> Column:
    """Rows where the predicate holds. Null over an empty global input, like SUM."""
    return sum_where(F.lit(1), predicate)


def distinct_where(c: Column, predicate: Column) -> Column:
    """Distinct values under a condition. The CASE form plans without the Expand a FILTER clause needs."""
    return F.count_distinct(F.when(predicate, c))


def shown(c: Column, decimals: int = 0) -> Column:
    """Number as text with thousands separators; null becomes an empty text. For display only."""
    return F.coalesce(F.format_number(c, decimals), F.lit(""))
