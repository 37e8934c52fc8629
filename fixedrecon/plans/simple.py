"""The short comparison job: tuple layout, normalised spaces, strict text
comparison, all joined rows and the bad ones as CSV."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from fixedrecon.layout import Layout, layout_from_tuples, one_copybook
from fixedrecon.operators import hot_keys as H
from fixedrecon.operators.compare import Rules, bad_records, join_sides_by_condition, simple_result
from fixedrecon.operators.copybook import UNKNOWN_COPYBOOK, simple_fields, simple_positions
from fixedrecon.operators.records import normalise_record_spaces
from fixedrecon.sinks import flatten_lists, read_csv, remove_folder, write_results
from fixedrecon.sources.copybooks import scan_copybooks
from fixedrecon.sources.records import scan_tuple_layout


@dataclass(frozen=True)
class SimpleSpec:
    layout: Layout | str  # or the path of a copybook in the short form
    legacy: str
    modern: str
    output: str
    keys: tuple[str, ...]
    duplicate_keys: str = "variants"  # or "pairs": what is written for keys with several records
    spread_rows: int = H.SPREAD_ROWS  # steers the spreading over tasks only


def compare_simple(
    legacy: DataFrame, modern: DataFrame, keys: Iterable[str], fields: Iterable[str], spread_rows: int | None = H.SPREAD_ROWS
) -> DataFrame:
    """Joined rows with ``mismatched_fields`` and ``mismatch_count``."""
    keys, fields = list(keys), list(fields)
    return simple_result(join_sides_by_condition(legacy, modern, keys, fields, spread_rows=spread_rows), keys, fields)


def write_simple(result: DataFrame, output: str) -> dict[str, str]:
    """Write all rows, then the bad ones. These are read back from the first
    output: that is cheaper than running the join again."""
    paths = {k: f"{output.rstrip('/')}/{k}" for k in ("validation_results", "bad_records")}
    flat = flatten_lists(result)
    write_results(flat, paths["validation_results"], "csv")
    written = read_csv(result.sparkSession, paths["validation_results"], flat.schema)
    write_results(bad_records(written), paths["bad_records"], "csv")
    return paths


def simple_layout(spark: SparkSession, layout: Layout | str) -> Layout:
    """The layout itself, or that of the one short copybook under a path."""
    if isinstance(layout, Layout):
        return layout
    placed = simple_positions(simple_fields(scan_copybooks(spark, layout)))
    rows = one_copybook(placed).orderBy("line_no").collect()  # the fields of one record
    name = rows[0].copybook_id if rows else UNKNOWN_COPYBOOK
    return layout_from_tuples(name, [(r.field_name, r.start_pos, r.end_pos, r.data_type) for r in rows])


def reconcile_simple(spark: SparkSession, spec: SimpleSpec) -> dict[str, str]:
    """Run the job; returns the output paths. With ``variants``, records of keys
    found on both sides and several times on one go to ``duplicate_records``, once per
    distinct record with the number of differing pairs, all others to the two result
    sets; with ``pairs`` all pairs go there."""
    H.checked_choice(spec.duplicate_keys)
    work = f"{spec.output.rstrip('/')}/_work/{uuid.uuid4().hex}"  # another job may write to the same output
    try:
        return _reconcile_simple(spark, spec, spec.output.rstrip("/"), work)
    finally:
        remove_folder(spark, work)


def _reconcile_simple(spark: SparkSession, spec: SimpleSpec, output: str, work: str) -> dict[str, str]:
    layout, keys = simple_layout(spark, spec.layout), list(spec.keys)
    fields = [f.name for f in layout.columns()]
    legacy = normalise_record_spaces(scan_tuple_layout(spark, spec.legacy, layout))
    modern = normalise_record_spaces(scan_tuple_layout(spark, spec.modern, layout))
    marked, seen = H.is_marked(keys, spec.duplicate_keys, spec.spread_rows), Observation("key profile")
    profile = H.key_profile(legacy, modern, keys).observe(seen, *H.marked_measures(marked, keys))
    write_results(profile.filter(marked), f"{work}/keys")
    found = seen.get
    if not found["marked_one_sided"] + found["marked_two_sided"]:
        return write_simple(compare_simple(legacy, modern, keys, fields, spread_rows=None), output)
    split = H.split_marked(legacy, modern, spark.read.parquet(f"{work}/keys"), keys)
    joined = join_sides_by_condition(
        split.rest_legacy, split.rest_modern, [*keys, H.SALT], [*fields, H.SALT], spread_rows=None
    )
    result = simple_result(joined, keys, fields)
    if spec.duplicate_keys == "pairs":
        chunked = [*fields, *H.CHUNKS]
        pairs = join_sides_by_condition(*H.in_chunks(split, spec.spread_rows), [*keys, *H.CHUNKS], chunked, "inner", spread_rows=None)
        return write_simple(result.unionByName(simple_result(pairs, keys, fields)), output)
    paths = write_simple(result, output)
    if found["marked_two_sided"]:
        rules = Rules(tuple(keys), tuple(fields))
        sides = []
        for records, name in ((split.both_legacy, "legacy"), (split.both_modern, "modern")):
            write_results(H.variants(records, rules), f"{work}/variants_{name}")
            sides.append(spark.read.parquet(f"{work}/variants_{name}"))
        paths["duplicate_records"] = f"{output}/duplicate_records"
        write_results(H.hot_details(H.partner_counts(*sides, rules)), paths["duplicate_records"])
    return paths
