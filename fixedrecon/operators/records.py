"""Lines to records, and record-wide projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixedrecon.functions.text import normalise_spaces, slice_array, slice_field
from fixedrecon.layout import Layout
from fixedrecon.sources.records import scan_lines

# Columns the reader adds; they are never compared.
METADATA_COLUMNS = (
    "row_number", "source_file", "record_length", "expected_length", "length_match", "load_timestamp",
)


def parse_records(
    lines: DataFrame,
    layout: Layout,
    source_file: str | Column | None = None,
    include_group_slices: bool = False,
) -> DataFrame:
    """Slice column ``value`` into trimmed string columns plus the metadata
    columns. One projection: the optimizer drops every slice nobody uses."""
    clash = sorted(f.name for f in layout.fields if f.name.lower() in METADATA_COLUMNS)
    if clash:
        raise ValueError(f"fields named like a metadata column: {', '.join(clash)}")
    line = F.col("value")
    source = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return lines.select(
        F.monotonically_increasing_id().alias("row_number"),
        *[
            slice_field(line, f.start, f.length).alias(f.name)
            for f in layout.columns(include_group_slices)
        ],
        source.cast("string").alias("source_file"),
        F.length(line).alias("record_length"),
        F.lit(layout.record_length).alias("expected_length"),
        (F.length(line) == F.lit(layout.record_length)).alias("length_match"),
        F.current_timestamp().alias("load_timestamp"),
    )


def read_fixed_width(
    spark: SparkSession, path: str, layout: Layout, include_group_slices: bool = False
) -> DataFrame:
    """Read one side of a comparison, each record tagged with the path asked for."""
    return parse_records(scan_lines(spark, path), layout, path, include_group_slices)


def read_fixed_width_files(
    spark: SparkSession, path: str | list[str], layout: Layout, include_group_slices: bool = False
) -> DataFrame:
    """Same, each record tagged with the file it came from."""
    lines = scan_lines(spark, path)
    return parse_records(lines, layout, F.col("_metadata.file_path"), include_group_slices)


def with_array_column(
    lines: DataFrame, name: str, start: int, length: int, occurs: int
) -> DataFrame:
    """Add all occurrences of a repeated field as one array column."""
    return lines.withColumn(name, slice_array(F.col("value"), start, length, occurs))


def normalise_record_spaces(records: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Normalise spaces in every (or every listed) column."""
    chosen = set(columns) if columns is not None else set(records.columns)
    return records.select(
        *[normalise_spaces(F.col(c)).alias(c) if c in chosen else F.col(c) for c in records.columns]
    )


def suffix_columns(
    records: DataFrame, keys: Iterable[str], columns: Iterable[str], suffix: str
) -> DataFrame:
    """Keys unchanged, the other columns with a suffix."""
    keys = list(keys)
    return records.select(
        *keys, *[F.col(c).alias(f"{c}_{suffix}") for c in columns if c not in keys]
    )


def blank_nulls(records: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Show NULL as ''."""
    chosen = set(columns)
    return records.select(
        *[
            F.coalesce(F.col(c), F.lit("")).alias(c) if c in chosen else F.col(c)
            for c in records.columns
        ]
    )
