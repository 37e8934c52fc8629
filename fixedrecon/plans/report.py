"""The run report as a table: ``section, item, legacy, modern, difference, severity``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixedrecon.operators.metrics import severities, verdict

REPORT_COLUMNS = ["section", "item", "legacy", "modern", "difference", "severity"]


def _row(section, item, legacy=None, modern=None, difference=None, severity=None):
    def text(value):
        return (F.lit(None) if value is None else value).cast("string")

    return F.struct(
        F.lit(section).alias("section"),
        item.cast("string").alias("item"),
        text(legacy).alias("legacy"),
        text(modern).alias("modern"),
        text(difference).alias("difference"),
        text(severity).alias("severity"),
    )


def _whole(column: str):
    """Counts as text without a fraction; percentages keep theirs."""
    c = F.col(column)
    return F.when(F.col("item") == "Mismatched Records", c.cast("string")).otherwise(
        c.cast("decimal(38,0)").cast("string")
    ) if column == "difference" else c.cast("decimal(38,0)").cast("string")


def report_table(
    metrics: DataFrame,
    legacy_structure: DataFrame,
    modern_structure: DataFrame,
    total_fields: int,
    fields: list[str],
    array_fields: list[str],
) -> DataFrame:
    """All inputs are one-row tables, whatever the size of the data. Sections:
    copybook, comparison, structure, issues, field analysis, recommendation."""
    copybook = legacy_structure.select(
        F.inline(
            F.array(
                _row("copybook", F.lit("Copybook Name"), F.col("copybook_name")),
                _row("copybook", F.lit("Total Fields"), F.lit(total_fields)),
                _row("copybook", F.lit("Record Length"), F.col("expected_length")),
                _row("copybook", F.lit("Array Fields"), F.lit(len(array_fields))),
            )
        )
    )
    comparison = severities(metrics).select(
        F.lit("comparison").alias("section"),
        "item",
        _whole("legacy").alias("legacy"),
        _whole("modern").alias("modern"),
        _whole("difference").alias("difference"),
        "severity",
    )
    measures = {
        "Expected Length": "expected_length",
        "Minimum Length": "min_length",
        "Maximum Length": "max_length",
        "Average Length": "avg_length",
    }

    def structure(one_row, side):
        values = [
            _row(
                "structure",
                F.lit(item),
                F.col(c) if side == "legacy" else None,
                F.col(c) if side == "modern" else None,
            )
            for item, c in measures.items()
        ]
        issues = F.transform(
            "issues",
            lambda i: _row(
                "issues",
                i,
                F.lit("found") if side == "legacy" else None,
                F.lit("found") if side == "modern" else None,
                None,
                F.lit("error"),
            ),
        )
        return one_row.select(F.inline(F.concat(F.array(*values), issues)))

    lengths = (
        structure(legacy_structure, "legacy")
        .unionByName(structure(modern_structure, "modern"))
        .groupBy("section", "item")
        .agg(*[F.max(c).alias(c) for c in REPORT_COLUMNS[2:]])
    )
    analysis = metrics.select(
        F.inline(
            F.array(
                _row("field analysis", F.lit("Fields Compared"), F.lit(len(fields))),
                _row("field analysis", F.lit("Array Fields Detected"), F.lit(", ".join(array_fields))),
                _row("recommendation", verdict(), F.col("match_rate_percent")),
            )
        )
    )
    return (
        copybook.unionByName(comparison).unionByName(lengths).unionByName(analysis)
        .select(*REPORT_COLUMNS)
    )
