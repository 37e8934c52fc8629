"""Metrics, summary, verdict and severities of a comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixedrecon.operators.compare import IN_LEGACY, IN_MODERN, Rules, both_present, has_mismatch
from fixedrecon.operators.spread import key_profile

# The limits and texts of the verdict.
EXCELLENT, GOOD = 95.0, 80.0
SMALL_SHARE = 0.05
VERDICTS = {
    "excellent": "Excellent data quality! Files are highly consistent.",
    "good": "Good data quality with minor discrepancies. Review mismatch details.",
    "poor": "Significant data discrepancies detected. Detailed investigation required.",
}
SUMMARY_METRICS = {
    "Total Legacy Records": "total_legacy_records",
    "Total Modern Records": "total_modern_records",
    "Records Only in Legacy": "legacy_only_records",
    "Records Only in Modern": "modern_only_records",
    "Common Records": "common_records",
    "Mismatched Records": "mismatched_records",
    "Perfect Matches": "perfect_matches",
    "Match Rate (%)": "match_rate_percent",
    "Fields Compared": "fields_compared",
    "Array Fields": "array_fields",
}


def array_bases(names: list[str]) -> list[str]:
    """Names before a ``_digits`` ending, each once, in order."""
    bases = [n.rpartition("_")[0] for n in names if "_" in n and n.rpartition("_")[2].isdigit()]
    return list(dict.fromkeys(bases))


def join_measures(rules: Rules) -> list[Column]:
    """The aggregates taken over the tagged rows of the join."""
    differs = has_mismatch(rules)
    return [
        F.count_if(~F.col(IN_MODERN)).alias("legacy_only_records"),
        F.count_if(~F.col(IN_LEGACY)).alias("modern_only_records"),
        F.count_if(both_present()).alias("common_records"),
        F.count_if(differs).alias("mismatched_records"),
        F.count_if(differs & both_present()).alias("mismatched_common_records"),
    ]


def _rate(mismatched: str) -> Column:
    common = F.col("common_records").cast("double")
    return F.round(
        (common - F.col(mismatched).cast("double")) / F.greatest(common, F.lit(1.0)) * 100, 2
    )


def with_rates(counts: DataFrame, rules: Rules) -> DataFrame:
    """Add both match rates and the column counts. The first rate counts
    one-sided records as mismatches (and may be negative), the second looks
    at common records only."""
    return (
        counts.withColumn("perfect_matches", F.col("common_records") - F.col("mismatched_records"))
        .withColumn("match_rate_percent", _rate("mismatched_records"))
        .withColumn("common_match_rate_percent", _rate("mismatched_common_records"))
        .withColumn("fields_compared", F.lit(len(rules.fields)))
        .withColumn("array_fields", F.lit(len(array_bases(list(rules.fields)))))
    )


def metrics(legacy: DataFrame, modern: DataFrame, tagged: DataFrame, rules: Rules) -> DataFrame:
    """One row of metrics: rows per key, summed up, and one aggregate over the join. A join that spreads crowded keys
    has counted the same rows per key, and that count is used again. The parts meet in a union, so there is no
    second join."""
    names = {"total_legacy_records": "rows__legacy", "total_modern_records": "rows__modern"}
    over_join = tagged.agg(*join_measures(rules))
    totals = key_profile(legacy, modern, rules.keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in names.items()]
    )
    parts = totals.unionByName(over_join, allowMissingColumns=True)
    return with_rates(parts.agg(*[F.sum(c).alias(c) for c in [*names, *over_join.columns]]), rules)


def summary(one_row: DataFrame) -> DataFrame:
    """``Metric, Value`` with ten rows."""
    entries = F.array(
        *[
            F.struct(F.lit(label).alias("Metric"), F.col(c).cast("double").alias("Value"))
            for label, c in SUMMARY_METRICS.items()
        ]
    )
    return one_row.select(F.inline(entries))


def verdict() -> Column:
    rate = F.col("match_rate_percent")
    return (
        F.when(rate >= EXCELLENT, VERDICTS["excellent"])
        .when(rate >= GOOD, VERDICTS["good"])
        .otherwise(VERDICTS["poor"])
    )


def with_verdict(one_row: DataFrame) -> DataFrame:
    return one_row.withColumn("verdict", verdict())


def severities(one_row: DataFrame) -> DataFrame:
    """``item, legacy, modern, difference, severity`` of the comparison table."""
    good, warning, error = F.lit("good"), F.lit("warning"), F.lit("error")
    total_l, total_m = F.col("total_legacy_records"), F.col("total_modern_records")
    shared, wrong = F.col("common_records"), F.col("mismatched_records")
    none = F.lit(None).cast("double")

    def row(item, legacy, modern, difference, severity):
        return F.struct(
            F.lit(item).alias("item"),
            legacy.cast("double").alias("legacy"),
            modern.cast("double").alias("modern"),
            difference.cast("double").alias("difference"),
            severity.cast("string").alias("severity"),
        )

    def zero_is_good(count):
        return F.when(count == 0, good).otherwise(warning)

    share = F.round(wrong / F.greatest(shared, F.lit(1)) * 100, 2)
    rows = F.array(
        row("Total Records", total_l, total_m, total_m - total_l,
            F.when(total_l == total_m, good).otherwise(warning)),
        row("Common Records", shared, shared, none, F.lit(None)),
        row("Mismatched Records", wrong, wrong, share,
            F.when(wrong == 0, good).when(wrong < shared * SMALL_SHARE, warning).otherwise(error)),
        row("Legacy Only", F.col("legacy_only_records"), none, none,
            zero_is_good(F.col("legacy_only_records"))),
        row("Modern Only", none, F.col("modern_only_records"), none,
            zero_is_good(F.col("modern_only_records"))),
    )
    return one_row.select(F.inline(rows))
