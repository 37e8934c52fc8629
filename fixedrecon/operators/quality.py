"""Structure and content checks. Every check is one pass with map-side
combining; none needs the records of a group in one place."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixedrecon.functions.text import is_blank, strip_whitespace
from fixedrecon.layout import Layout


def _melt(one_row: DataFrame, fields: Iterable[str], measures: Mapping[str, str], keep: Iterable[str] = ()) -> DataFrame:
    """One row per field from a one-row aggregate whose columns are named
    ``<measure>__<field>``."""
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("field_name"),
                *[F.col(f"{m}__{f}").alias(out) for m, out in measures.items()],
            )
            for f in fields
        ]
    )
    return one_row.select(*keep, F.inline(entries))


def wrong_length() -> Column:
    return ~F.col("length_match")


def length_counts(records: DataFrame) -> DataFrame:
    """Records and records of the wrong length."""
    return records.agg(
        F.count("*").alias("record_count"), F.count_if(wrong_length()).alias("length_mismatches")
    )


def wrong_length_rows(records: DataFrame) -> DataFrame:
    return records.filter(wrong_length())


def length_stats(records: DataFrame) -> DataFrame:
    """Smallest, largest and average record length."""
    return records.agg(
        F.min("record_length").alias("min_length"),
        F.max("record_length").alias("max_length"),
        F.round(F.avg("record_length"), 2).alias("avg_length"),
    )


def empty_records(records: DataFrame) -> DataFrame:
    return records.agg(F.count_if(F.col("record_length") == 0).alias("empty_records"))


def blank_keys(records: DataFrame, keys: Iterable[str]) -> DataFrame:
    """NULL or blank values per key field; keys the records lack are skipped."""
    present = [k for k in keys if k in records.columns]
    counted = records.agg(*[F.count_if(is_blank(F.col(k))).alias(f"blank__{k}") for k in present])
    return _melt(counted, present, {"blank": "blank_keys"})


def structure_measures(keys: Iterable[str]) -> list[Column]:
    """The aggregates the structure report is made of."""
    return [
        F.count("*").alias("record_count"),
        F.min("record_length").alias("min_length"),
        F.max("record_length").alias("max_length"),
        F.round(F.avg("record_length"), 2).alias("avg_length"),
        F.count_if(wrong_length()).alias("length_mismatches"),
        F.count_if(F.col("record_length") == 0).alias("empty_records"),
        *[F.count_if(is_blank(F.col(k))).alias(f"blank__{k}") for k in keys],
    ]


def _thousands(count: str) -> Column:
    return F.format_number(F.col(count), 0)


def issue_list(keys: Iterable[str]) -> Column:
    """Findings in words, in a fixed order, only where something was found."""
    found = [
        F.when(
            F.col("length_mismatches") > 0,
            F.concat(_thousands("length_mismatches"), F.lit(" records have incorrect length")),
        ),
        F.when(
            F.col("empty_records") > 0,
            F.concat(_thousands("empty_records"), F.lit(" completely empty records found")),
        ),
    ]
    found += [
        F.when(
            F.col(f"blank__{k}") > 0,
            F.concat(
                F.lit(f"Primary key field {k} has "), _thousands(f"blank__{k}"),
                F.lit(" null/empty values"),
            ),
        )
        for k in keys
    ]
    return F.array_compact(F.array(*found))


def structure_report(records: DataFrame, layout: Layout, keys: Iterable[str]) -> DataFrame:
    """One row: expected and actual lengths, counts and the issue list, all
    from a single aggregation without a shuffle of records."""
    present = [k for k in keys if k in records.columns]
    return (
        records.agg(*structure_measures(present))
        .withColumn("copybook_name", F.lit(layout.name))
        .withColumn("expected_length", F.lit(layout.record_length))
        .withColumn("issues", issue_list(present))
        .withColumn("validation_timestamp", F.current_timestamp())
        .select(
            "copybook_name", "expected_length", "validation_timestamp", "record_count",
            "min_length", "max_length", "avg_length", "length_mismatches", "empty_records",
            *[F.col(f"blank__{k}") for k in present], "issues",
        )
    )


def length_classes(records: DataFrame) -> DataFrame:
    """Records that are short, long or as expected."""
    difference = F.col("record_length") - F.col("expected_length")
    kind = F.when(difference < 0, "short").when(difference > 0, "long").otherwise("ok")
    return records.groupBy(kind.alias("length_class")).agg(F.count("*").alias("records"))


def mandatory_fields(records: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Blank values per mandatory field."""
    fields = list(fields)
    counted = records.agg(*[F.count_if(is_blank(F.col(f))).alias(f"blank__{f}") for f in fields])
    return _melt(counted, fields, {"blank": "blank_values"})


def _is_number(value: Column, digits: int, point: bool) -> Column:
    """An optional sign and at most ``digits`` digits, with a point where allowed."""
    one_point = r"(?=[^.]*\.?[^.]*$)" if point else ""
    digit = "[0-9.]" if point else "[0-9]"
    shape = value.rlike(rf"^[+-]?{one_point}{digit}*[0-9]{digit}*$")
    return shape & (F.length(F.regexp_replace(value, "[^0-9]", "")) <= digits)


def type_errors(records: DataFrame, layout: Layout) -> DataFrame:
    """INTEGER, NUMERIC and DECIMAL fields whose text is no number; blanks are fine.
    A number is an optional sign and digits, in DECIMAL fields with at most one
    point among them; it has as many digits as the field has positions at most."""
    fields = [
        f for f in layout.columns() if f.data_type in ("INTEGER", "DECIMAL", "NUMERIC") and f.name in records.columns
    ]
    bad = [
        F.count_if(
            ~is_blank(strip_whitespace(F.col(f.name)))
            & ~_is_number(strip_whitespace(F.col(f.name)), f.length, f.data_type == "DECIMAL")
        ).alias(f"bad__{f.name}")
        for f in fields
    ]
    return _melt(records.agg(*bad), [f.name for f in fields], {"bad": "invalid_values"})


def completeness(
    records: DataFrame, fields: Iterable[str], max_null_percentage: float = 5.0
) -> DataFrame:
    """Records, blank values, blank percentage per field, and whether that is
    above the limit."""
    fields = list(fields)
    counted = records.agg(
        F.count("*").alias("records"),
        *[F.count_if(is_blank(F.col(f))).alias(f"blank__{f}") for f in fields],
    )
    share = F.round(F.col("blank_values") * 100.0 / F.greatest(F.col("records"), F.lit(1)), 2)
    return (
        _melt(counted, fields, {"blank": "blank_values"}, keep=["records"])
        .withColumn("blank_percent", share)
        .withColumn("above_limit", F.col("blank_percent") > max_null_percentage)
    )


def date_time_errors(records: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """Values that do not parse with the field's format; blanks are fine."""
    bad = [
        F.count_if(
            ~is_blank(F.col(f)) & F.try_to_timestamp(F.col(f), F.lit(pattern)).isNull()
        ).alias(f"bad__{f}")
        for f, pattern in formats.items()
    ]
    return _melt(records.agg(*bad), list(formats), {"bad": "invalid_values"})


def field_lengths(records: DataFrame, fields: Iterable[str]) -> DataFrame:
    """How many values of each trimmed length every field has."""
    lengths = records.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("field_name"),
                        F.length(F.coalesce(F.col(f), F.lit(""))).alias("value_length"),
                    )
                    for f in fields
                ]
            )
        )
    )
    return lengths.groupBy("field_name", "value_length").agg(F.count("*").alias("records"))
