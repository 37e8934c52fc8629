"""Keys with several records on a side.

A comparison joins every legacy record with every modern record of the same
key. Keys are meant to be unique, but a blank key can hold a large share of
both files. What is written for such keys is the caller's choice and the same
at every number of records:

* ``variants``: equal records of a side collapse into variants with a count,
  variants that agree on every field are matched by one equi-join on all of
  them, and the rest of the ``legacy rows x modern rows`` pairs are mismatches.
  The counts equal those of the full join; the details list each differing
  variant once with the number of pairs it stands for;
* ``pairs``: every pair is listed like any other record.

Counts decide about the spreading of records only. Those of a crowded key on
one side match nothing: a salt spreads them over all tasks of the outer join.
Those of a crowded key on both sides need no outer join: both sides are cut
into chunks, and each pair of chunks is one group of an inner join.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fixedrecon.functions.compare import any_of, as_number
from fixedrecon.operators.compare import Rules, join_sides
from fixedrecon.operators.spread import SALTS, SPREAD_ROWS, crowded, key_matches, key_profile

# Column names with two underscores are internal: no field name has them.
SALT = "hot__salt"
CHUNKS = ("hot__chunk_legacy", "hot__chunk_modern")
BIG = "decimal(38,0)"  # pair counts outgrow a long


def pairs() -> Column:
    return F.col("rows__legacy").cast("decimal(19,0)") * F.col("rows__modern").cast("decimal(19,0)")


def profile_measures(keys: Iterable[str]) -> list[Column]:
    """Everything about the outer join that follows from row counts alone."""
    matched = key_matches(keys)

    def alone(count):
        return F.sum(F.when(~matched, F.col(count)).otherwise(0))

    return [
        F.coalesce(F.sum("rows__legacy"), F.lit(0)).alias("total_legacy_records"),
        F.coalesce(F.sum("rows__modern"), F.lit(0)).alias("total_modern_records"),
        F.coalesce(alone("rows__legacy"), F.lit(0)).alias("legacy_only_records"),
        F.coalesce(alone("rows__modern"), F.lit(0)).alias("modern_only_records"),
        F.coalesce(F.sum(F.when(matched, pairs().cast(BIG))), F.lit(0).cast(BIG)).alias("common_records"),
        F.count_if(F.col("rows__legacy") > 1).alias("duplicate_key_groups_legacy"),
        F.count_if(F.col("rows__modern") > 1).alias("duplicate_key_groups_modern"),
    ]


DUPLICATE_KEYS = ("variants", "pairs")


def checked_choice(duplicate_keys: str) -> str:
    if duplicate_keys not in DUPLICATE_KEYS:
        raise ValueError(f"duplicate_keys is one of {', '.join(DUPLICATE_KEYS)}")
    return duplicate_keys


def duplicated() -> Column:
    """More than one record of the key on a side."""
    return (F.col("rows__legacy") > 1) | (F.col("rows__modern") > 1)


def is_marked(keys: Iterable[str], duplicate_keys: str, spread_rows: int) -> Column:
    """Keys that the plain outer join is not to take as they are."""
    matched = key_matches(keys)
    if duplicate_keys == "variants":
        return (matched & duplicated()) | (~matched & crowded(spread_rows))
    return crowded(spread_rows)


def marked_measures(marked: Column, keys: Iterable[str]) -> list[Column]:
    """Marked keys on one side, on both, and the pairs of the latter."""
    matched = key_matches(keys)
    return [
        F.count_if(marked & ~matched).alias("marked_one_sided"),
        F.count_if(marked & matched).alias("marked_two_sided"),
        F.coalesce(F.sum(F.when(marked & matched, pairs().cast(BIG))), F.lit(0).cast(BIG)).alias("marked_pairs"),
    ]


@dataclass(frozen=True)
class Split:
    """Records of each side by what has to be done with them."""

    rest_legacy: DataFrame  # to be joined, with a salt
    rest_modern: DataFrame
    both_legacy: DataFrame  # of marked keys found on both sides, with row counts
    both_modern: DataFrame


def split_marked(legacy: DataFrame, modern: DataFrame, marks: DataFrame, keys: Iterable[str]) -> Split:
    """Route records by the table of marked keys. The adaptive planner takes
    its measured size: it broadcasts a small one, and splits the records of a
    frequent key in the join with a larger one.

    Records of marked keys without partner get a salt: they match nothing anyway
    and so spread over all tasks of the join. Numbers for salts count lines within
    an input split, hence a task that runs again gives the same ones."""
    keys = list(keys)
    marks = marks.select(
        *[F.col(k).alias(f"mark__{k}") for k in keys],
        "rows__legacy",
        "rows__modern",
        key_matches(keys).alias("hot__matched"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"mark__{k}")) for k in keys]
    names = [f"mark__{k}" for k in keys]

    def numbered(side):
        return side.withColumn("hot__line", F.monotonically_increasing_id())

    def rest(side):
        marked = numbered(side).join(marks, same, "left")
        salt = F.when(F.col("hot__matched").isNotNull(), (F.col("hot__line") % SALTS).cast("int")).otherwise(-1)
        return marked.filter(~F.coalesce("hot__matched", F.lit(False))).withColumn(SALT, salt).select(*side.columns, SALT)

    def both(side):
        return numbered(side).join(marks, same).filter("hot__matched").drop(*names, "hot__matched")

    return Split(rest(legacy), rest(modern), both(legacy), both(modern))


def join_rest(split: Split, rules: Rules) -> DataFrame:
    """The outer join of all records except those of marked keys on both sides."""
    salted = replace(rules, keys=(*rules.keys, SALT))
    return join_sides(split.rest_legacy, split.rest_modern, salted, spread_rows=None).drop(SALT)


def in_chunks(split: Split, spread_rows: int) -> tuple[DataFrame, DataFrame]:
    """Records of marked keys on both sides with the columns ``CHUNKS``: each
    record has a chunk of its own side and one copy for each of the other side's.
    An inner join on keys and chunks so meets every pair once."""
    mine, other = CHUNKS

    def chunks(side):
        return F.greatest(F.ceil(F.col(f"rows__{side}") / F.lit(float(spread_rows))), F.lit(1)).cast("long")

    def cut(records, own, own_chunk, partner, partner_chunk):
        return records.withColumn(own_chunk, F.pmod(F.xxhash64("hot__line"), chunks(own))).withColumn(
            partner_chunk, F.explode(F.sequence(F.lit(0).cast("long"), chunks(partner) - 1))
        )

    return (
        cut(split.both_legacy, "legacy", mine, "modern", other),
        cut(split.both_modern, "modern", other, "legacy", mine),
    )


def join_pairs(split: Split, rules: Rules, spread_rows: int) -> DataFrame:
    """Every pair of the marked keys on both sides, with the columns of the outer join."""
    legacy, modern = in_chunks(split, spread_rows)
    kept = [*rules.keys, *rules.values, *CHUNKS]
    chunked = replace(rules, keys=(*rules.keys, *CHUNKS))
    return join_sides(legacy.select(*kept), modern.select(*kept), chunked, "inner", spread_rows=None).drop(*CHUNKS)


def _cell(value: Column, tolerance: float, decimals: int) -> tuple[Column, Column]:
    """Join cell of a value and the cells its equals may be in.

    Without tolerance the text itself is the cell. With one, numbers fall into
    cells two tolerances wide, so the equals of a number lie in two of them."""
    exact = F.concat(F.lit("t"), value)
    if tolerance <= 0:
        return exact, F.array(exact)
    number, reach = as_number(value, decimals), tolerance * (1 + 1e-9)  # room for rounding

    def name(c):
        return F.concat(F.lit("n"), (c + F.lit(0.0)).cast("string"))

    def at(n):
        return F.rint(n / F.lit(2.0 * tolerance))

    low, high = at(number - F.lit(reach)), at(number + F.lit(reach))
    around = F.array_distinct(F.array(name(low), name(F.least(low + 1, high)), name(high)))
    return (
        F.when(number.isNotNull(), name(at(number))).otherwise(exact),
        F.when(number.isNotNull(), around).otherwise(F.array(exact)),
    )


def variants(hot_side: DataFrame, rules: Rules) -> DataFrame:
    """Distinct records of hot keys found on both sides, with ``hot__copies``.
    Grouping on the whole record spreads one key over all tasks."""
    values = [F.coalesce(F.col(f), F.lit("")).alias(f) for f in rules.values]
    return hot_side.groupBy(*rules.keys, *values, "rows__legacy", "rows__modern").agg(
        F.count("*").alias("hot__copies")
    )


def _with_cells(side: DataFrame, rules: Rules, around: bool) -> DataFrame:
    for i, f in enumerate(rules.values):
        own, near = _cell(F.col(f), rules.tolerance.get(f, 0), rules.decimals.get(f, 0))
        if around and rules.tolerance.get(f, 0) > 0:
            side = side.withColumn(f"cell__{i}", F.explode(near))
        else:
            side = side.withColumn(f"cell__{i}", own)
    return side


def equal_variants(legacy: DataFrame, modern: DataFrame, rules: Rules) -> DataFrame:
    """Pairs of variants without a mismatch. The join key is the whole record
    (numbers with a tolerance by cell), so only near-equal variants meet."""
    left = _with_cells(legacy, rules, around=True).select(
        *rules.keys,
        *[f"cell__{i}" for i in range(len(rules.values))],
        *[F.col(f).alias(f"{f}_legacy") for f in rules.values],
        F.col("hot__copies").alias("hot__copies_legacy"),
    )
    right = _with_cells(modern, rules, around=False).select(
        *rules.keys,
        *[f"cell__{i}" for i in range(len(rules.values))],
        *[F.col(f).alias(f"{f}_modern") for f in rules.values],
        F.col("hot__copies").alias("hot__copies_modern"),
    )
    differs = any_of(
        [
            rules.mismatch(f, F.col(f"{f}_legacy"), F.col(f"{f}_modern"), F.lit(True))
            for f in rules.values
        ]
    )
    on = [*rules.keys, *[f"cell__{i}" for i in range(len(rules.values))]]
    return left.join(right, on).filter(~differs)


def _times(a: str, b: str) -> Column:
    return (F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(19,0)")).cast(BIG)


def partner_counts(legacy: DataFrame, modern: DataFrame, rules: Rules) -> DataFrame:
    """Every variant of both sides: ``hot__side, keys, values,
    hot__copies, hot__partners`` (of the same key) and ``hot__equal_partners`` among them.
    Its size is that of the variants, never of the pairs."""
    def entry(side, copies, partners, equal):
        return [
            F.lit(side).alias("hot__side"),
            *rules.keys,
            *[F.col(f"{f}_{side}").alias(f) for f in rules.values],
            copies.cast("long").alias("hot__copies"),
            partners.cast("long").alias("hot__partners"),
            equal.cast("long").alias("hot__equal_partners"),
        ]

    def plain(side, name):
        return side.select(
            *rules.keys, "hot__copies", "rows__legacy", "rows__modern",
            *[F.col(f).alias(f"{f}_{name}") for f in rules.values],
        )

    none, zero = F.lit(None), F.lit(0)
    pairs_found = equal_variants(legacy, modern, rules).select(
        F.inline(
            F.array(
                F.struct(*entry("legacy", none, none, F.col("hot__copies_modern"))),
                F.struct(*entry("modern", none, none, F.col("hot__copies_legacy"))),
            )
        )
    )
    own = plain(legacy, "legacy").select(
        *entry("legacy", F.col("hot__copies"), F.col("rows__modern"), zero)
    ).unionByName(
        plain(modern, "modern").select(*entry("modern", F.col("hot__copies"), F.col("rows__legacy"), zero))
    )
    return (
        own.unionByName(pairs_found)
        .groupBy("hot__side", *rules.keys, *rules.values)
        .agg(
            F.max("hot__copies").alias("hot__copies"),
            F.max("hot__partners").alias("hot__partners"),
            F.sum("hot__equal_partners").alias("hot__equal_partners"),
        )
    )


def equal_pairs() -> Column:
    """Sum over ``partner_counts``: pairs without mismatch, each counted once."""
    legacy = F.when(F.col("hot__side") == "legacy", _times("hot__copies", "hot__equal_partners"))
    return F.coalesce(F.sum(legacy), F.lit(0).cast(BIG)).cast(BIG).alias("hot_equal_pairs")


def hot_details(counted: DataFrame) -> DataFrame:
    """Variants that differ from some partner record, with
    ``hot__mismatched_partners`` and ``hot__mismatched_pairs``."""
    return (
        counted.withColumn("hot__mismatched_partners", F.col("hot__partners") - F.col("hot__equal_partners"))
        .filter("hot__mismatched_partners > 0")
        .withColumn("hot__mismatched_pairs", _times("hot__copies", "hot__mismatched_partners"))
        .drop("hot__equal_partners")
    )


STEPS, EXACT = 1024, 2.0**42  # multiples of 1/STEPS below EXACT are added and subtracted without rounding


def _is_step(number: float) -> bool:
    return 0 < number < EXACT and number * STEPS == int(number * STEPS)


def _place(value: Column, decimals: int) -> Column:
    """The number of steps of a value that is a multiple of 1/STEPS, else NULL."""
    steps = as_number(value, decimals) * F.lit(float(STEPS))
    return F.when((F.abs(steps) < F.lit(EXACT * STEPS)) & (steps == F.floor(steps)), steps.cast("long"))


def _pairs_within(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``field_name, equal_pairs`` of numbers at most ``cmp__reach`` apart, by one sort instead of pairs. Both sides:
    keys, ``cmp__field, cmp__place, cmp__reach, hot__copies``, places in whole steps.

    What is within reach of a number ends in two cells twice the reach wide that lie side by side: in the lower one
    everything from its lower end on counts, in the upper one everything up to its upper end."""
    place, reach, group = F.col("cmp__place"), F.col("cmp__reach"), [*keys, "cmp__field"]

    def by_place(side):
        present = [F.col(k).isNotNull() for k in keys]
        side = side.filter(~any_of([~c for c in [*present, place.isNotNull()]]))
        return side.groupBy(*group, "cmp__place", "cmp__reach").agg(F.sum("hot__copies").alias("hot__copies"))

    def mark(at, order, held, weight):
        cell = ((at - F.pmod(at, 2 * reach)) / (2 * reach)).cast("long")
        return F.struct(
            cell.alias("cmp__cell"), at.alias("cmp__at"), F.lit(order).alias("cmp__order"),
            held.cast("long").alias("cmp__held"), weight.cast("long").alias("cmp__weight"),
        )

    zero, copies = F.lit(0), F.col("hot__copies")
    ends = by_place(left).select(*group, F.inline(F.array(mark(place - reach, 0, zero, copies), mark(place + reach, 2, zero, copies))))
    held = by_place(right).select(*group, F.inline(F.array(mark(place, 1, copies, zero))))
    cell = W.partitionBy(*group, "cmp__cell")
    upto = cell.orderBy("cmp__at", "cmp__order").rowsBetween(W.unboundedPreceding, 0)
    counted = (
        ends.unionByName(held)
        .withColumn("cmp__upto", F.sum("cmp__held").over(upto))
        .withColumn("cmp__all", F.sum("cmp__held").over(cell))
        .withColumn("cmp__found", F.when(F.col("cmp__order") == 0, F.col("cmp__all") - F.col("cmp__upto")).otherwise(F.col("cmp__upto")))
    )
    return counted.groupBy(F.col("cmp__field").alias("field_name")).agg(F.sum(_times("cmp__weight", "cmp__found")).alias("equal_pairs"))


def hot_field_equals(legacy: DataFrame, modern: DataFrame, rules: Rules) -> DataFrame:
    """Pairs of variants that agree, per field: ``field_name, equal_pairs``.
    Each field is counted by value before the sides meet.

    With a tolerance, numbers that are exact in steps (whole numbers above all) are counted against each other by
    running sums, as cells hold the more values the denser these lie. Only other values, or a tolerance that is not
    exact, meet in cells pair by pair."""
    limits = {f: t for f, t in rules.tolerance.items() if f in rules.values and t > 0}
    exact = [f for f, t in limits.items() if _is_step(t)]

    def by_value(side):
        entries = [
            F.struct(F.lit(f).alias("cmp__field"), F.col(f).alias("cmp__value")) for f in rules.values
        ]
        place = F.lit(None).cast("long")
        for f in exact:
            place = F.when(F.col("cmp__field") == f, _place(F.col("cmp__value"), rules.decimals.get(f, 0))).otherwise(place)
        return (
            side.select(*rules.keys, "hot__copies", F.inline(F.array(*entries)))
            .groupBy(*rules.keys, "cmp__field", "cmp__value")
            .agg(F.sum("hot__copies").alias("hot__copies"))
            .withColumn("cmp__place", place)
        )

    def in_cells(counted, around):
        cells = F.array(F.concat(F.lit("t"), F.col("cmp__value")))
        for f, limit in limits.items():
            own, near = _cell(F.col("cmp__value"), limit, rules.decimals.get(f, 0))
            cells = F.when(F.col("cmp__field") == f, near if around else F.array(own)).otherwise(cells)
        return counted.withColumn("cmp__cell", F.explode(cells))

    values = by_value(legacy), by_value(modern)
    # exact numbers meet the other kind only: their pairs are not even candidates here
    is_exact = F.col("cmp__place").isNotNull()
    kinds = F.when(is_exact, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    left = in_cells(values[0], True).withColumn("cmp__exact", F.explode(kinds))
    right = in_cells(values[1], False).select(
        *rules.keys, "cmp__field", "cmp__cell", is_exact.alias("cmp__exact"),
        F.col("cmp__value").alias("cmp__other"), F.col("hot__copies").alias("cmp__other_copies"),
    )
    # without a tolerance, equal cells are equal values
    differs = F.lit(False)
    for f in limits:
        beyond = rules.mismatch(f, F.col("cmp__value"), F.col("cmp__other"), F.lit(True))
        differs = F.when(F.col("cmp__field") == f, beyond).otherwise(differs)
    found = (
        left.join(right, [*rules.keys, "cmp__field", "cmp__cell", "cmp__exact"])
        .filter(~differs)
        .groupBy(F.col("cmp__field").alias("field_name"))
        .agg(F.sum(_times("hot__copies", "cmp__other_copies")).alias("equal_pairs"))
    )
    if exact:
        reach = F.create_map(*[F.lit(x) for f in exact for x in (f, int(limits[f] * STEPS))])[F.col("cmp__field")].cast("long")
        found = found.unionByName(_pairs_within(*[v.filter(is_exact).withColumn("cmp__reach", reach) for v in values], rules.keys))
    return found.groupBy("field_name").agg(F.sum("equal_pairs").cast(BIG).alias("equal_pairs")).filter("equal_pairs > 0")
