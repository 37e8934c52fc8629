"""Copybook lines to data description entries, for many copybooks at once.

Input everywhere: ``copybook_id, line_no, raw``. Windows are partitioned by
copybook: a copybook describes one record type, so its size is bounded by the
record description and does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fixedrecon.functions import picture as P
from fixedrecon.functions.text import strip_whitespace

# Fixed values of the card format and of the entry levels.
SEQUENCE_AREA = r"^(?:\d{6}| {6})[ *+-]"
CONTINUED_CARD = r"^(?:\d{6}| {6})[+-]"
KEPT_LINE = r"^\s*[^\s*C]"  # neither blank nor a remark starting with * or C
NON_STORAGE_LEVELS = (66, 88)
UNKNOWN_COPYBOOK = "UNKNOWN_COPYBOOK"


def normalise_lines(lines: DataFrame) -> DataFrame:
    """Drop the sequence area, comments and blank lines.

    Adds ``text`` and ``is_continuation``."""
    raw = F.col("raw")
    numbered = raw.rlike(SEQUENCE_AREA)
    return (
        lines.withColumn("text", F.when(numbered, F.substring(raw, 7, 2147483647)).otherwise(raw))
        .withColumn(
            "is_continuation", raw.rlike(CONTINUED_CARD) | F.col("text").startswith("+")
        )
        .filter(F.col("text").rlike(KEPT_LINE))
        .select("copybook_id", "line_no", "text", "is_continuation")
    )


def merge_continuations(normalised: DataFrame) -> DataFrame:
    """Join continued lines to the line they continue: one row per statement."""
    order = W.partitionBy("copybook_id").orderBy("line_no")
    previous = F.lag("line_no").over(order)
    starts = (~F.col("is_continuation")) | previous.isNull()
    # the mark in the first column goes away, the rest is trimmed
    tail = strip_whitespace(F.substring("text", 2, 2147483647))
    part = F.when(F.col("starts"), F.rtrim("text")).otherwise(tail)
    return (
        normalised.withColumn("starts", starts)
        .withColumn("statement_no", F.sum(F.col("starts").cast("int")).over(order))
        .withColumn("part", part)
        .groupBy("copybook_id", "statement_no")
        .agg(
            F.min("line_no").alias("line_no"),
            F.sort_array(F.collect_list(F.struct("line_no", "part"))).alias("parts"),
        )
        .select(
            "copybook_id",
            "line_no",
            F.array_join(F.transform("parts", lambda p: p["part"]), " ").alias("statement"),
        )
    )


def statements(lines: DataFrame) -> DataFrame:
    """``copybook_id, line_no, statement`` of every kept line."""
    return merge_continuations(normalise_lines(lines))


def describe_entries(kept: DataFrame) -> DataFrame:
    """All attributes of each statement, with ``reject_reason`` where it is
    no usable entry. Row-wise only: no shuffle."""
    statement, written = F.col("statement"), F.col("written")
    clauses, picture = F.col("clauses"), F.col("pic_clause")
    return (
        kept.withColumn("written", P.written_name(statement))
        .withColumn("is_field", (written != "") | P.is_field_line(statement))
        .withColumn("level", P.level_before(statement, written))
        .withColumn("field_name", P.cobol_name(written))
        .withColumn("clauses", P.clauses_after(statement, written))
        .withColumn("pic_clause", P.picture_clause(clauses))
        .withColumn("bad_repeat", P.has_bad_repeat(picture))
        .withColumn("data_type", P.picture_type(picture))
        .withColumn("length", P.picture_length(picture))
        .withColumn("decimal_positions", P.picture_decimals(picture))
        .withColumn("occurs", P.occurs_count(clauses))
        .withColumn("redefines", P.redefines_target(clauses))
        .withColumn(
            "reject_reason",
            F.when(~F.col("is_field"), "no level number and name")
            .when(F.col("bad_repeat"), "repeat count is not a number")
            .when(P.has_bad_occurs(clauses), "OCCURS count is too large"),
        )
        .drop("written", "is_field", "bad_repeat", "clauses")
    )


def is_storage() -> Column:
    """Usable entries that take part in the layout."""
    return F.col("reject_reason").isNull() & ~F.col("level").isin(*NON_STORAGE_LEVELS)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Statements that are skipped, with the reason."""
    return (
        describe_entries(statements(lines))
        .filter(F.col("reject_reason").isNotNull())
        .select("copybook_id", "line_no", "statement", "reject_reason")
    )


def copybook_names(lines: DataFrame) -> DataFrame:
    """``copybook_id, copybook_name``: the first 01 entry."""
    ids = lines.groupBy("copybook_id").agg(F.lit(UNKNOWN_COPYBOOK).alias("fallback"))
    first = (
        describe_entries(statements(lines))
        .filter(F.col("level") == 1)
        .groupBy("copybook_id")
        .agg(F.min_by("field_name", "line_no").alias("name"))
    )
    return ids.join(first, "copybook_id", "left").select(
        "copybook_id", F.coalesce("name", "fallback").alias("copybook_name")
    )


LARGEST = 2**31 - 1  # the last position of a record


def _simple_entries(lines: DataFrame) -> DataFrame:
    """Entries of the short form with ``reject_reason`` where a length, or the end of the entry, is no position, and
    ``fits``: whether the whole copybook has no such entry."""
    text = strip_whitespace(F.col("raw"))
    digits = F.regexp_extract(text, P.SIMPLE_FIELD, 3)
    upto = W.partitionBy("copybook_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    # a length of more digits than a long has counts as one that is too large
    size = F.coalesce(digits.try_cast("long"), F.lit(LARGEST + 1))
    end = F.sum(F.least("size", F.lit(LARGEST + 1))).over(upto)
    reason = F.when(F.col("size") > LARGEST, "length is too large").when(F.col("end") > LARGEST, "ends beyond the last position")
    return (
        lines.filter(text.rlike(P.SIMPLE_FIELD))
        .withColumn("statement", text)
        .withColumn("size", size)
        .withColumn("end", end)
        .withColumn("reject_reason", reason)
        .withColumn("fits", F.max("end").over(W.partitionBy("copybook_id")) <= LARGEST)
    )


def simple_fields(lines: DataFrame) -> DataFrame:
    """Short form: only ``name PIC X(n)`` and ``name PIC 9(n)`` entries. A copybook whose entries do not all end at a
    position that an integer holds is left out as a whole; ``simple_rejects`` says why."""
    text = F.col("statement")
    return (
        _simple_entries(lines)
        .filter("fits")
        .select(
            "copybook_id",
            "line_no",
            F.translate(F.regexp_extract(text, P.SIMPLE_FIELD, 1), "-", "_").alias("field_name"),
            F.col("size").cast("int").alias("length"),
            F.when(F.upper(F.regexp_extract(text, P.SIMPLE_FIELD, 2)) == "X", "STRING")
            .otherwise("NUMERIC")
            .alias("data_type"),
        )
    )


def simple_rejects(lines: DataFrame) -> DataFrame:
    """``copybook_id, line_no, statement, reject_reason`` of the entries for which a copybook in the short form is
    left out: those whose length is no position, or the ones from where the record ends beyond the last."""
    found = _simple_entries(lines).filter(F.col("reject_reason").isNotNull())
    return found.select("copybook_id", "line_no", "statement", "reject_reason")


def simple_positions(fields: DataFrame) -> DataFrame:
    """Add 1-based inclusive ``start_pos`` and ``end_pos`` from running lengths."""
    upto = (
        W.partitionBy("copybook_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    )
    end = F.sum("length").over(upto)
    return fields.withColumn("end_pos", end.cast("int")).withColumn(
        "start_pos", (F.col("end_pos") - F.col("length") + 1).cast("int")
    )
