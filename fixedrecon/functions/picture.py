"""Expressions that take a copybook statement apart.

A statement reads ``<level> <name> <clauses>.``; everything here is a native
column expression, so a whole library of copybooks is parsed in one scan.

Patterns cost most of a parse, so a plain test goes before each that rules out
most texts, and what a pattern has found is not searched for again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The clause patterns of a data description entry.
FIELD_LINE = r"^\s*\d{2}\s+[\w-]+"
ENTRY = r"^\s*(\d{2})\s+([\w-]+)(.*)$"
BLANKS = " \t\n\x0b\f\r"  # what \s stands for
PICTURE = r"(?i)(?:^|\s)PIC(?:TURE)?\s+(?:IS\s+)?([\w().-]+)"
OCCURS = r"(?i)\bOCCURS\s+(\d+)\b"
REDEFINES = r"(?i)\bREDEFINES\s+([\w-]+)"
REPEAT = r"(?i)[XA9]\((\d{1,9})\)"
ONE_REPEAT = r"(?i)^[^()]*[XA9]\((\d{1,9})\)[^()]*$"
BAD_REPEAT = r"\((?!\d{1,9}\))"
SIMPLE_FIELD = r"(?i)(\w[\w-]*)\s+PIC\s+([X9])\((\d+)\)"


def cobol_name(name: Column) -> Column:
    """Upper-case a name and turn dashes into underscores."""
    return F.upper(F.translate(name, "-", "_"))


def is_field_line(statement: Column) -> Column:
    return statement.rlike(FIELD_LINE)


def _mentions(text: Column, word: str) -> Column:
    """Whether the word may stand in the text, in letters of either case."""
    return F.upper(text).contains(word)


def _extract(text: Column, word: str, pattern: str) -> Column:
    """First group of a pattern that holds the word, '' where nothing is found."""
    return F.when(~_mentions(text, word), "").otherwise(F.regexp_extract(text, pattern, 1))


def _whole_number(digits: Column) -> Column:
    """Number in a text of at most nine digits, NULL for ''."""
    return F.when(digits != "", digits.cast("int"))


def written_name(statement: Column) -> Column:
    """The name as written, '' where the statement is no entry."""
    return F.regexp_extract(statement, ENTRY, 2)


def level_before(statement: Column, written: Column) -> Column:
    """Level of a statement with this ``written_name``."""
    return F.when(written != "", F.substring(F.ltrim(statement, F.lit(BLANKS)), 1, 2).cast("int"))


def clauses_after(statement: Column, written: Column) -> Column:
    """What follows this ``written_name``, '' where the statement is no entry."""
    named = F.ltrim(F.substring(F.ltrim(statement, F.lit(BLANKS)), 3, 2147483647), F.lit(BLANKS))
    return F.when(written != "", F.substring(named, F.length(written) + 1, F.lit(2147483647))).otherwise("")


def entry_level(statement: Column) -> Column:
    return _whole_number(F.regexp_extract(statement, ENTRY, 1))


def entry_name(statement: Column) -> Column:
    return cobol_name(written_name(statement))


def entry_clauses(statement: Column) -> Column:
    """What follows the name."""
    return F.regexp_extract(statement, ENTRY, 3)


def picture_clause(clauses: Column) -> Column:
    """The picture text without its closing period, '' for a group."""
    found = _extract(clauses, "PIC", PICTURE)
    return F.when(found.endswith("."), F.left(found, F.length(found) - 1)).otherwise(found)


def has_bad_repeat(picture: Column) -> Column:
    """True where a repeat count is no number of usual size, as in ``X(ABC)``."""
    return picture.contains("(") & picture.rlike(BAD_REPEAT)


def _occurs_digits(clauses: Column) -> Column:
    return _extract(clauses, "OCCURS", OCCURS)


def occurs_count(clauses: Column) -> Column:
    """Repetitions, 1 when there is no OCCURS clause."""
    found = _occurs_digits(clauses).try_cast("int")
    return F.greatest(F.coalesce(found, F.lit(1)), F.lit(1))


def has_bad_occurs(clauses: Column) -> Column:
    """True where the repetitions outgrow an integer."""
    digits = _occurs_digits(clauses)
    return (digits != "") & digits.try_cast("int").isNull()


def redefines_target(clauses: Column) -> Column:
    """Name of the redefined field or NULL."""
    name = _extract(clauses, "REDEFINES", REDEFINES)
    return F.when(name != "", cobol_name(name))


def picture_width(part: Column) -> Column:
    """Positions taken by one picture part: repeat counts plus single symbols."""
    one = F.regexp_extract(part, ONE_REPEAT, 1)
    repeats = F.regexp_extract_all(part, F.lit(REPEAT), F.lit(1))
    repeated = F.aggregate(repeats, F.lit(0), lambda total, n: total + n.cast("int"))
    singles = F.length(F.translate(F.regexp_replace(part, REPEAT, ""), "()", ""))
    # one count in brackets, after the symbol it repeats
    alone = one.cast("int") + F.length(part) - F.length(one) - 3
    bracketed = F.when(one != "", alone).otherwise(repeated + singles)
    return F.when(part.contains("("), bracketed).otherwise(F.length(F.replace(part, F.lit(")"), F.lit(""))))


def picture_length(picture: Column) -> Column:
    """Positions of the whole picture; sign and implied point take none."""
    signed = _mentions(picture, "S") | _mentions(picture, "V")
    counted = F.when(signed, F.regexp_replace(picture, "(?i)^S?([^V]*)V?", "$1")).otherwise(picture)
    return picture_width(counted)


def picture_decimals(picture: Column) -> Column:
    """Positions after the implied point, 0 without one."""
    fraction = _extract(picture, "V", "(?i)^[^V]*V(.*)$")
    return F.when(fraction != "", picture_width(fraction)).otherwise(0)


def picture_type(picture: Column) -> Column:
    """DECIMAL with an implied point, INTEGER for digits, else STRING."""
    symbols = F.regexp_replace(picture, r"\(\d+\)", "")
    return (
        F.when(_mentions(picture, "V") & symbols.rlike("(?i)V"), "DECIMAL")
        .when(picture.contains("9") & symbols.contains("9"), "INTEGER")
        .otherwise("STRING")
    )
