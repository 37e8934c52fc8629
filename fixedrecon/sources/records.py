"""Record files: newline-delimited text on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixedrecon.functions.text import slice_field_rtrim
from fixedrecon.layout import Layout


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in column ``value``. Large files are split by Spark."""
    return spark.read.text(path)


def scan_tuple_layout(spark: SparkSession, path: str | list[str], layout: Layout) -> DataFrame:
    """Lines sliced by a (name, start, end, type) layout, right-trimmed only."""
    line = F.col("value")
    return scan_lines(spark, path).select(
        *[slice_field_rtrim(line, f.start, f.length).alias(f.name) for f in layout.columns()]
    )
