"""Text expressions used on records and copybook lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(text: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_trailing_whitespace(text: Column) -> Column:
    """Remove white space of every kind from the right end."""
    return F.rtrim(text, F.lit(WHITESPACE))


def slice_field(line: Column, start: int, length: int) -> Column:
    """Characters ``start .. start+length-1`` (1-based) without surrounding spaces."""
    return F.trim(F.substring(line, start, length))


def slice_field_rtrim(line: Column, start: int, length: int) -> Column:
    """Characters ``start .. start+length-1`` (1-based), leading blanks kept."""
    return strip_trailing_whitespace(F.substring(line, start, length))


def slice_array(line: Column, start: int, length: int, occurs: int) -> Column:
    """All occurrences of a repeated field as one array column."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(occurs - 1)),
        lambda i: F.trim(F.substring(line, F.lit(start) + i * F.lit(length), F.lit(length))),
    )


def normalise_spaces(text: Column) -> Column:
    """Trim and turn every run of spaces into a single one."""
    return F.regexp_replace(F.trim(text), " +", " ")


def is_blank(text: Column) -> Column:
    """True for NULL and for the empty string."""
    return text.isNull() | (text == F.lit(""))
