"""The whole comparison job.

Two passes over the data:

1. count rows per key and per length (shuffles keys and counts only). The final stage gives the
   structure report of both sides, the totals and the hot keys;
2. the full outer join of all other records, written as mismatch details while
   the same final stage counts mismatches.

Both passes collect their counters with an ``Observation`` placed in the
stage that writes. Spark counts every output partition of such a stage once,
also when executors are lost and tasks run again, so the numbers can be relied
on. Keys with several records on a side are compared by variants in a third pass,
or pair by pair, as the caller chooses.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fixedrecon.functions.text import is_blank
from fixedrecon.layout import Layout, collect_layout
from fixedrecon.operators import hot_keys as H
from fixedrecon.operators.compare import (
    Rules,
    field_measures,
    field_percentages,
    make_rules,
    mismatch_details,
    tag_mismatches,
)
from fixedrecon.operators.layout import parse_copybooks
from fixedrecon.operators.metrics import (
    array_bases,
    join_measures,
    summary,
    with_rates,
    with_verdict,
)
from fixedrecon.operators.quality import issue_list
from fixedrecon.operators.records import read_fixed_width
from fixedrecon.plans.report import report_table
from fixedrecon.sinks import claim_stamp, remove_folder, run_paths, write_results
from fixedrecon.sources.copybooks import scan_copybooks


@dataclass(frozen=True)
class ReconSpec:
    """What to compare. ``layout`` is a layout or the path of a copybook."""

    layout: Layout | str
    legacy: str
    modern: str
    output: str
    keys: tuple[str, ...]
    ignore: tuple[str, ...] = ()
    tolerance: Mapping[str, float] = field(default_factory=dict)
    scale_implied_decimals: bool = False
    include_group_slices: bool = False
    record_name: str | None = None
    duplicate_keys: str = "variants"  # or "pairs": what is written for keys with several records
    spread_rows: int = H.SPREAD_ROWS  # steers the spreading over tasks only


@dataclass(frozen=True)
class ReconResult:
    status: str
    copybook: str
    metrics: dict
    structure: dict
    field_mismatches: dict
    paths: dict
    duplicate_keys: int


def resolve_layout(spark: SparkSession, layout: Layout | str, record: str | None) -> Layout:
    if isinstance(layout, Layout):
        return layout
    return collect_layout(parse_copybooks(scan_copybooks(spark, layout)), record_name=record)


SIDES = ("legacy", "modern")


def _side_counts(records: DataFrame, keys: tuple[str, ...], side: str) -> DataFrame:
    """Two rows for each record: one for its key, one for its length. The latter
    have no key and are few after combining on the map side."""
    types = dict(records.dtypes)
    one = {s: F.lit(1 if s == side else 0).cast("long").alias(f"n__{s}") for s in SIDES}
    no_key = [F.lit(None).cast(types[k]).alias(k) for k in keys]
    no_length = F.lit(None).cast("int").alias("length__value")
    of_key = F.struct(F.lit(False).alias("is__length"), *keys, no_length, *one.values())
    of_length = F.struct(
        F.lit(True).alias("is__length"), *no_key, F.col("record_length").alias("length__value"), *one.values()
    )
    return records.select(F.inline(F.array(of_key, of_length)))


def profile_sides(legacy: DataFrame, modern: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Records per key (``rows__<side>``) and per length (``lengths__<side>``) in one
    aggregation: what is shuffled is a key or a length, and two counts."""
    both = _side_counts(legacy, keys, "legacy").unionByName(_side_counts(modern, keys, "modern"))
    counted = both.groupBy("is__length", *keys, "length__value").agg(*[F.sum(f"n__{s}").alias(f"n__{s}") for s in SIDES])
    zero = F.lit(0).cast("long")
    return counted.select(
        *keys,
        "length__value",
        *[F.when(~F.col("is__length"), F.col(f"n__{s}")).otherwise(zero).alias(f"rows__{s}") for s in SIDES],
        *[F.when(F.col("is__length"), F.col(f"n__{s}")).otherwise(zero).alias(f"lengths__{s}") for s in SIDES],
    )


def _profile_totals(keys: tuple[str, ...], marked, expected_length: int) -> list:
    out, length = H.profile_measures(keys), F.col("length__value")
    for s in SIDES:
        n = F.col(f"lengths__{s}")
        out += [
            F.sum(length * n).alias(f"chars__{s}"),
            F.sum(F.when(length != expected_length, n).otherwise(0)).alias(f"wrong__{s}"),
            F.sum(F.when(length == 0, n).otherwise(0)).alias(f"empty__{s}"),
            F.min(F.when(n > 0, length)).alias(f"shortest__{s}"),
            F.max(F.when(n > 0, length)).alias(f"longest__{s}"),
        ]
        out += [
            F.sum(F.when(is_blank(F.col(k)), F.col(f"rows__{s}")).otherwise(0)).alias(f"blank__{k}__{s}")
            for k in keys
        ]
    return out + H.marked_measures(marked, keys)


def one_row(spark: SparkSession, values: Mapping[str, tuple]) -> DataFrame:
    """One-row table from name -> (value, type): counters already collected."""
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(v).cast(t).alias(n) for n, (v, t) in values.items()]
    )


def _structure_rows(spark: SparkSession, layout: Layout, keys, totals: dict) -> dict[str, DataFrame]:
    """One-row structure report per side from the collected counters."""
    rows = {}
    for s in SIDES:
        n = totals[f"total_{s}_records"]
        values = {
            "copybook_name": (layout.name, "string"),
            "expected_length": (layout.record_length, "int"),
            "record_count": (n, "long"),
            "min_length": (totals[f"shortest__{s}"], "long"),
            "max_length": (totals[f"longest__{s}"], "long"),
            "avg_length": (totals[f"chars__{s}"] / n if n else None, "double"),
            "length_mismatches": (totals[f"wrong__{s}"] or 0, "long"),
            "empty_records": (totals[f"empty__{s}"] or 0, "long"),
            **{f"blank__{k}": (totals[f"blank__{k}__{s}"] or 0, "long") for k in keys},
        }
        rows[s] = (
            one_row(spark, values)
            .withColumn("avg_length", F.round("avg_length", 2))
            .withColumn("issues", issue_list(keys))
            .withColumn("validation_timestamp", F.current_timestamp())
        )
    return rows


METRIC_NAMES = [
    "total_legacy_records", "total_modern_records", "legacy_only_records", "modern_only_records",
    "common_records", "mismatched_records", "mismatched_common_records",
    "duplicate_key_groups_legacy", "duplicate_key_groups_modern",
]


def metrics_row(spark: SparkSession, counts: Mapping[str, int], rules: Rules) -> DataFrame:
    """One-row metrics table; counts are decimals because pairs of records
    with the same key can outnumber a long."""
    values = {n: (Decimal(int(counts[n])), H.BIG) for n in METRIC_NAMES}
    return with_rates(one_row(spark, values), rules)


def run_metrics_frame(spark: SparkSession, run: str, stages: Mapping[str, tuple]) -> DataFrame:
    """Audit rows: ``run, stage, rows, mismatches, started, ended``; the
    stages map a name to the last four values."""
    rows = [
        F.struct(
            F.lit(run).alias("run"),
            F.lit(stage).alias("stage"),
            F.lit(Decimal(int(count))).cast(H.BIG).alias("rows"),
            F.lit(Decimal(int(wrong))).cast(H.BIG).alias("mismatches"),
            F.timestamp_micros(F.lit(int(began * 1e6))).alias("started"),
            F.timestamp_micros(F.lit(int(ended * 1e6))).alias("ended"),
        )
        for stage, (count, wrong, began, ended) in stages.items()
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def reconcile(spark: SparkSession, spec: ReconSpec) -> ReconResult:
    """Run the job and write its outputs below ``spec.output``. Intermediate tables
    stand there as well, below ``_work``, until the job has ended."""
    H.checked_choice(spec.duplicate_keys)
    stamp = claim_stamp(spark, spec.output)
    paths = run_paths(spec.output, stamp)
    work = paths.pop("work")
    try:
        return _reconcile(spark, spec, stamp, paths, work)
    finally:
        remove_folder(spark, work)


def _reconcile(spark: SparkSession, spec: ReconSpec, stamp: str, paths: dict, work: str) -> ReconResult:
    began = time.time()
    layout = resolve_layout(spark, spec.layout, spec.record_name).with_keys(spec.keys)
    legacy = read_fixed_width(spark, spec.legacy, layout, spec.include_group_slices)
    modern = read_fixed_width(spark, spec.modern, layout, spec.include_group_slices)
    rules = make_rules(
        legacy, modern, spec.keys, spec.ignore, spec.tolerance, layout, spec.scale_implied_decimals
    )
    keys, variants = rules.keys, spec.duplicate_keys == "variants"

    # pass 1: rows per key
    marked = H.is_marked(keys, spec.duplicate_keys, spec.spread_rows)
    seen = Observation("key profile")
    profile = profile_sides(legacy, modern, keys).observe(
        seen, *_profile_totals(keys, marked, layout.record_length)
    )
    write_results(profile.filter(marked).select(*keys, "rows__legacy", "rows__modern"), f"{work}/keys")
    totals, profiled = seen.get, time.time()
    structure = _structure_rows(spark, layout, keys, totals)

    # pass 2: join, count and write the details
    two_sided = totals["marked_two_sided"]
    if two_sided or totals["marked_one_sided"]:
        split = H.split_marked(legacy, modern, spark.read.parquet(f"{work}/keys"), keys)
        joined = H.join_rest(split, rules)
        if two_sided and not variants:
            joined = joined.unionByName(H.join_pairs(split, rules, spec.spread_rows))
    else:
        joined = H.join_sides(legacy, modern, rules, spread_rows=None)  # pass 1 found no crowded key
    counted = Observation("comparison")
    tagged = tag_mismatches(joined, rules).observe(
        counted, F.count(F.lit(1)).alias("compared"), *join_measures(rules), *field_measures(rules)
    )
    write_results(mismatch_details(tagged, rules), paths["mismatch_details"])
    over_join, joined_at = counted.get, time.time()
    if not over_join["mismatched_records"]:
        remove_folder(spark, paths["mismatch_details"])

    # pass 3: pairs of keys with several records, counted without building them
    counts = dict(totals)
    wrong, wrong_common = over_join["mismatched_records"], over_join["mismatched_common_records"]
    differs = {f: over_join[f"differs__{f}"] for f in rules.values}
    compared = over_join["compared"]
    if variants and two_sided:
        sides = []
        for records, name in ((split.both_legacy, "legacy"), (split.both_modern, "modern")):
            write_results(H.variants(records, rules), f"{work}/variants_{name}")
            sides.append(spark.read.parquet(f"{work}/variants_{name}"))
        seen_pairs = Observation("duplicate pairs")
        partners = H.partner_counts(*sides, rules).observe(seen_pairs, H.equal_pairs())
        write_results(H.hot_details(partners), paths["duplicate_details"])
        all_pairs = int(totals["marked_pairs"])
        wrong_pairs = all_pairs - int(seen_pairs.get["hot_equal_pairs"])
        equal = {r.field_name: int(r.equal_pairs) for r in H.hot_field_equals(*sides, rules).collect()}
        wrong, wrong_common = wrong + wrong_pairs, wrong_common + wrong_pairs
        differs = {f: n + all_pairs - equal.get(f, 0) for f, n in differs.items()}
        compared += all_pairs
    counts.update(mismatched_records=wrong, mismatched_common_records=wrong_common)
    ended = time.time()

    # small tables
    metrics = metrics_row(spark, counts, rules)
    write_results(summary(metrics), paths["summary"], "csv")
    bases = array_bases(list(rules.fields))
    report = report_table(
        metrics, structure["legacy"], structure["modern"],
        len(layout.fields), list(rules.fields), bases,
    )
    write_results(report.coalesce(1), paths["report"])
    measured = {"compared": compared, **{f"differs__{f}": n for f, n in differs.items()}}
    stats = one_row(spark, {n: (Decimal(int(v)), H.BIG) for n, v in measured.items()})
    if differs:
        write_results(field_percentages(stats, rules), paths["field_stats"])
    read = totals["total_legacy_records"] + totals["total_modern_records"]
    audit = run_metrics_frame(
        spark,
        stamp,
        {
            "profile": (read, 0, began, profiled),
            "compare": (over_join["compared"], over_join["mismatched_records"], profiled, joined_at),
            "duplicate keys": (compared - over_join["compared"], wrong - over_join["mismatched_records"], joined_at, ended),
        },
    )
    audit.write.mode("append").parquet(paths["run_metrics"])
    return ReconResult(
        status="completed",
        copybook=layout.name,
        metrics=with_verdict(metrics).first().asDict()
        | {"compared_fields": list(rules.fields), "array_fields_detected": bases},
        structure={s: structure[s].first().asDict() for s in SIDES},
        field_mismatches=differs,
        paths={
            k: v
            for k, v in paths.items()
            if not (k == "mismatch_details" and not over_join["mismatched_records"])
            and not (k == "duplicate_details" and not (variants and two_sided))
        },
        duplicate_keys=totals["duplicate_key_groups_legacy"] + totals["duplicate_key_groups_modern"],
    )
