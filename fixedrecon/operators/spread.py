"""Spreading of crowded keys over the tasks of a join.

A full outer join gathers all records of a key in one task, and the adaptive planner cannot split it. A blank key can
hold most of a side. Rows per key are counted first (keys and two counts are shuffled, combined on the map side). The
records of a crowded key then get two more join keys:

* where the other side has none of the key, a salt: they match nothing anyway;
* where both sides have some, a chunk of the own side, and one copy for each chunk of the other side. Each pair of
  records meets in exactly one pair of chunks. A copy whose partner chunk is empty stays alone and is dropped.

The rows of the join are the same as without. Crowded keys stand in a broadcast table of at most ``MARKED`` keys, the
ones with the most rows: a key beyond them has no more rows than a ``MARKED``-th of its side, and is joined as it is."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names with two underscores are internal: no field name has them.
CHUNK_COLUMNS = ("spread__legacy", "spread__modern")
BOTH = {"legacy": "spread__both_legacy", "modern": "spread__both_modern"}
SALTS = 4096
SPREAD_ROWS = 10_000  # rows of a key in one group of a join
MARKED = 20_000


def key_profile(legacy: DataFrame, modern: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows per key and side. Only the keys are shuffled, after counting on
    the map side, so a hot key costs one row per map task."""
    keys = list(keys)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    names = ("rows__legacy", "rows__modern")
    both = legacy.select(*keys, one.alias(names[0]), zero.alias(names[1])).unionByName(
        modern.select(*keys, zero.alias(names[0]), one.alias(names[1]))
    )
    return both.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def key_matches(keys: Iterable[str]) -> Column:
    """The key occurs on both sides and can be equal to itself (no NULL)."""
    present = (F.col("rows__legacy") > 0) & (F.col("rows__modern") > 0)
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], present)


def crowded(spread_rows: int) -> Column:
    """More records of the key on a side than one group of a join should take."""
    return (F.col("rows__legacy") > spread_rows) | (F.col("rows__modern") > spread_rows)


def crowded_keys(legacy: DataFrame, modern: DataFrame, keys: list[str], spread_rows: int) -> DataFrame:
    """``mark__<key>, rows__legacy, rows__modern, spread__matched`` of the at most ``MARKED`` fullest crowded keys."""
    most = F.greatest("rows__legacy", "rows__modern")
    found = key_profile(legacy, modern, keys).filter(crowded(spread_rows)).orderBy(most.desc(), *keys).limit(MARKED)
    return found.select(
        *[F.col(k).alias(f"mark__{k}") for k in keys], "rows__legacy", "rows__modern", key_matches(keys).alias("spread__matched")
    )


def spread_sides(
    legacy: DataFrame, modern: DataFrame, keys: Iterable[str], spread_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``CHUNK_COLUMNS``, to be joined on as well, and ``BOTH`` of the side, true for records of a
    crowded key that both sides have. Lines are numbered within an input split, so a task that runs again
    deals them out alike."""
    keys = list(keys)
    marks = F.broadcast(crowded_keys(legacy, modern, keys, spread_rows))
    same = [F.col(k).eqNullSafe(F.col(f"mark__{k}")) for k in keys]
    matched, line = F.coalesce("spread__matched", F.lit(False)), F.col("spread__line")

    def chunks(side: str) -> Column:
        return F.greatest(F.ceil(F.col(f"rows__{side}") / F.lit(float(spread_rows))), F.lit(1)).cast("long")

    def dealt(records: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        alone = F.when(F.col("spread__matched").isNotNull(), line % SALTS).otherwise(0)
        first = F.lit(0).cast("long")
        return (
            records.withColumn("spread__line", F.monotonically_increasing_id())
            .join(marks, same, "left")
            .withColumn(mine, F.when(matched, F.pmod(F.xxhash64(line), chunks(own))).otherwise(alone).cast("long"))
            .withColumn(theirs, F.explode(F.when(matched, F.sequence(first, chunks(other) - 1)).otherwise(F.array(first))))
            .withColumn(BOTH[own], matched)
            .select(*records.columns, *CHUNK_COLUMNS, BOTH[own])
        )

    mine, theirs = CHUNK_COLUMNS
    return dealt(legacy, "legacy", "modern", mine, theirs), dealt(modern, "modern", "legacy", theirs, mine)


def without_lone_copies(joined: DataFrame, in_legacy: str, in_modern: str) -> DataFrame:
    """The joined rows without copies that met no partner, and without the columns of the spreading. The presence
    columns are NULL where a side is missing."""
    both = F.coalesce(*[F.col(c) for c in BOTH.values()], F.lit(False))
    lone = both & (F.col(in_legacy).isNull() | F.col(in_modern).isNull())
    return joined.filter(~lone).drop(*CHUNK_COLUMNS, *BOTH.values())
