"""Record comparison over one full outer join.

Presence on a side is kept in marker columns, so that a NULL or blank value is
never mistaken for a missing record. Records are shuffled by the join alone, and keys by
the count that spreads crowded ones; whatever is computed from the join (details, tags,
counts) is row-wise on top.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixedrecon.functions.compare import (
    any_of,
    beyond_tolerance,
    describe_difference,
    text_differs,
    text_differs_strict,
)
from fixedrecon.layout import Layout
from fixedrecon.operators.records import METADATA_COLUMNS, suffix_columns
from fixedrecon.operators.spread import BOTH, CHUNK_COLUMNS, SPREAD_ROWS, spread_sides, without_lone_copies

IN_LEGACY, IN_MODERN = "in__legacy", "in__modern"  # no field name has two underscores


def compared_columns(
    legacy: Iterable[str], modern: Iterable[str], ignore: Iterable[str] = ()
) -> list[str]:
    """Columns both sides have, in legacy order, without metadata and ignored ones."""
    other, skipped = set(modern), {*METADATA_COLUMNS, *ignore}
    return [c for c in legacy if c in other and c not in skipped]


def ignored_columns(layout: Layout, ignore: Iterable[str]) -> set[str]:
    """Ignore list widened to repeated and numbered columns of the same base."""
    return layout.names_of(ignore) | set(ignore)


@dataclass(frozen=True)
class Rules:
    """How fields are compared.

    ``tolerance`` maps a field to the largest accepted numeric difference;
    ``decimals`` maps a field to its implied decimal places (leave empty to
    compare the digits as they stand)."""

    keys: tuple[str, ...]
    fields: tuple[str, ...]
    tolerance: Mapping[str, float] = field(default_factory=dict)
    decimals: Mapping[str, int] = field(default_factory=dict)

    @property
    def values(self) -> list[str]:
        """Compared fields that are not keys."""
        return [f for f in self.fields if f not in self.keys]

    def mismatch(self, name: str, legacy: Column, modern: Column, both_present: Column) -> Column:
        limit = self.tolerance.get(name, 0)
        if limit > 0:
            return beyond_tolerance(
                legacy, modern, limit, both_present, self.decimals.get(name, 0)
            )
        return text_differs(legacy, modern)


def make_rules(
    legacy: DataFrame,
    modern: DataFrame,
    keys: Iterable[str],
    ignore: Iterable[str] = (),
    tolerance: Mapping[str, float] | None = None,
    layout: Layout | None = None,
    scale_implied_decimals: bool = False,
) -> Rules:
    skipped = ignored_columns(layout, ignore) if layout else set(ignore)
    decimals = (
        {f.name: f.decimals for f in layout.fields if f.decimals}
        if layout and scale_implied_decimals
        else {}
    )
    fields = compared_columns(legacy.columns, modern.columns, skipped)
    return Rules(tuple(keys), tuple(fields), dict(tolerance or {}), decimals)


def _presence(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {
            IN_LEGACY: F.coalesce(IN_LEGACY, F.lit(False)),
            IN_MODERN: F.coalesce(IN_MODERN, F.lit(False)),
        }
    )


def join_sides(
    legacy: DataFrame, modern: DataFrame, rules: Rules, how: str = "full_outer", spread_rows: int | None = SPREAD_ROWS
) -> DataFrame:
    """Full outer join on the keys; keys are merged, other fields get
    ``_legacy`` and ``_modern``. Only keys and compared fields are shuffled.

    Keys with more than ``spread_rows`` records on a side are dealt over several tasks, for which rows per key are
    counted first; the rows of the result are the same. None, for keys that are known to be few: joins as it is."""
    left = suffix_columns(legacy, rules.keys, rules.values, "legacy").withColumn(
        IN_LEGACY, F.lit(True)
    )
    right = suffix_columns(modern, rules.keys, rules.values, "modern").withColumn(
        IN_MODERN, F.lit(True)
    )
    if spread_rows is None:
        return _presence(left.join(right, list(rules.keys), how))
    left, right = spread_sides(left, right, rules.keys, spread_rows)
    joined = left.join(right, [*rules.keys, *CHUNK_COLUMNS], how)
    return _presence(without_lone_copies(joined, IN_LEGACY, IN_MODERN))


def join_sides_by_condition(
    legacy: DataFrame, modern: DataFrame, keys: Iterable[str], fields: Iterable[str], how: str = "full_outer",
    spread_rows: int | None = SPREAD_ROWS,
) -> DataFrame:
    """Full outer join that keeps both key sets: ``l_<field>``, ``m_<field>``. ``spread_rows`` as in ``join_sides``."""
    fields, keys = list(fields), list(keys)
    extra: list[str] = []
    if spread_rows is not None:
        sides = (side.select(*dict.fromkeys([*fields, *keys])) for side in (legacy, modern))
        legacy, modern = spread_sides(*sides, keys, spread_rows)
        extra = list(CHUNK_COLUMNS)

    def side(records: DataFrame, letter: str, present: str, both: str) -> DataFrame:
        more = [F.col(c).alias(f"{letter}_{c}") for c in extra] + ([F.col(both)] if extra else [])
        return records.select(*[F.col(c).alias(f"{letter}_{c}") for c in fields], *more, F.lit(True).alias(present))

    left = side(legacy, "l", IN_LEGACY, BOTH["legacy"])
    right = side(modern, "m", IN_MODERN, BOTH["modern"])
    condition = [F.col(f"l_{k}") == F.col(f"m_{k}") for k in [*keys, *extra]]
    joined = left.join(right, condition, how)
    if extra:
        joined = without_lone_copies(joined, IN_LEGACY, IN_MODERN).drop(*[f"{a}_{c}" for a in "lm" for c in extra])
    return _presence(joined)


def both_present() -> Column:
    return F.col(IN_LEGACY) & F.col(IN_MODERN)


def record_status() -> Column:
    return (
        F.when(both_present(), "common")
        .when(F.col(IN_LEGACY), "legacy_only")
        .otherwise("modern_only")
    )


def legacy_only(joined: DataFrame) -> DataFrame:
    return joined.filter(~F.col(IN_MODERN))


def modern_only(joined: DataFrame) -> DataFrame:
    return joined.filter(~F.col(IN_LEGACY))


def common(joined: DataFrame) -> DataFrame:
    return joined.filter(both_present())


def mismatch_conditions(rules: Rules) -> dict[str, Column]:
    """Boolean condition per compared field over the joined columns."""
    return {
        f: rules.mismatch(f, F.col(f"{f}_legacy"), F.col(f"{f}_modern"), both_present())
        for f in rules.values
    }


def tag_mismatches(joined: DataFrame, rules: Rules) -> DataFrame:
    """Add one boolean column ``differs__<field>`` per compared field."""
    conditions = mismatch_conditions(rules)
    if not conditions:
        return joined
    return joined.withColumns({f"differs__{f}": c for f, c in conditions.items()})


def tags(rules: Rules) -> dict[str, Column]:
    return {f: F.col(f"differs__{f}") for f in rules.values}


def has_mismatch(rules: Rules) -> Column:
    """True for tagged rows with at least one differing field."""
    return any_of(list(tags(rules).values()))


def tag_list(conditions: Mapping[str, Column]) -> Column:
    """Names of the fields whose condition holds."""
    if not conditions:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(c, F.lit(f)) for f, c in conditions.items()]))


def mismatch_details(tagged: DataFrame, rules: Rules) -> DataFrame:
    """Records with a mismatch: keys, both values, the difference in words,
    field list and count. Equal records are filtered out before any of the
    output columns is built."""
    legacy = {f: F.col(f"{f}_legacy") for f in rules.values}
    modern = {f: F.col(f"{f}_modern") for f in rules.values}
    blank = F.lit("")
    return (
        tagged.filter(has_mismatch(rules))
        .select(
            *rules.keys,
            *[F.coalesce(c, blank).alias(f"{f}_legacy") for f, c in legacy.items()],
            *[F.coalesce(c, blank).alias(f"{f}_modern") for f, c in modern.items()],
            *[
                F.when(c, describe_difference(f, legacy[f], modern[f])).alias(f"{f}_comparison")
                for f, c in tags(rules).items()
            ],
            tag_list(tags(rules)).alias("mismatched_fields"),
            record_status().alias("record_status"),
            F.current_timestamp().alias("validation_timestamp"),
        )
        .withColumn("mismatch_count", F.size("mismatched_fields"))
    )


def long_mismatches(tagged: DataFrame, rules: Rules) -> DataFrame:
    """One row per record and differing field, for reports across layouts."""
    found = F.array_compact(
        F.array(
            *[
                F.when(
                    c,
                    F.struct(
                        F.lit(f).alias("field_name"),
                        F.col(f"{f}_legacy").alias("legacy_value"),
                        F.col(f"{f}_modern").alias("modern_value"),
                    ),
                )
                for f, c in tags(rules).items()
            ]
        )
    )
    return tagged.filter(has_mismatch(rules)).select(
        *rules.keys, record_status().alias("record_status"), F.inline(found)
    )


def strict_conditions(keys: Iterable[str], fields: Iterable[str]) -> dict[str, Column]:
    """Conditions of the simple profile over ``l_`` / ``m_`` columns. A join on
    the keys makes them equal, still they are compared like every field."""
    return {f: text_differs_strict(F.col(f"l_{f}"), F.col(f"m_{f}")) for f in fields}


def simple_result(joined: DataFrame, keys: Iterable[str], fields: Iterable[str]) -> DataFrame:
    """Simple profile: all joined rows with the list and count of mismatches."""
    fields = list(fields)
    return joined.select(
        *[f"l_{f}" for f in fields],
        *[f"m_{f}" for f in fields],
        record_status().alias("record_status"),
        tag_list(strict_conditions(keys, fields)).alias("mismatched_fields"),
    ).withColumn("mismatch_count", F.size("mismatched_fields"))


def bad_records(result: DataFrame) -> DataFrame:
    return result.filter(F.col("mismatch_count") > 0)


def field_measures(rules: Rules) -> list[Column]:
    """Mismatches per field as aggregates ``differs__<field>``."""
    return [F.count_if(c).alias(f"differs__{f}") for f, c in tags(rules).items()]


def field_stats(tagged: DataFrame, rules: Rules) -> DataFrame:
    """Per field: rows compared, mismatches and their percentage. One global
    aggregate over the join, no row per field is ever shuffled."""
    counted = tagged.agg(F.count("*").alias("compared"), *field_measures(rules))
    return field_percentages(counted, rules)


def field_percentages(counted: DataFrame, rules: Rules) -> DataFrame:
    """One row per field from one row with ``compared`` and the measures."""
    entries = F.array(
        *[
            F.struct(F.lit(f).alias("field_name"), F.col(f"differs__{f}").alias("mismatched"))
            for f in rules.values
        ]
    )
    return counted.select("compared", F.inline(entries)).withColumn(
        "mismatch_percent",
        F.round(F.col("mismatched") * 100.0 / F.greatest(F.col("compared"), F.lit(1)), 2),
    )
