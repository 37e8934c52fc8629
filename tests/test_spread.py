"""Crowded keys in the outer joins: the same rows, dealt over tasks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixedrecon.operators import compare as C
from fixedrecon.operators import metrics as M
from fixedrecon.operators import spread as S

SCHEMA = "K string, L string, T string"


def sides(spark, seed):
    """Keys alone on a side, crowded on one, on both, with NULL in one part; both sides partly empty of them."""
    draw = random.Random(seed)

    def rows(names, count):
        return [(draw.choice(names), draw.choice(["", "x", "x", None]), draw.choice(["p", "q", "", None])) for _ in range(count)]

    left = rows(["", "", "", "both", "left", "a", "b", None], 300) + [(f"k{i}", "x", "p") for i in range(40)]
    right = rows(["", "both", "right", "right", "a", "c", None], 200) + [(f"k{i}", "x", "q") for i in range(20, 60)]
    return (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (left, right))


@pytest.mark.parametrize("spread_rows", [1, 7, 50])
@pytest.mark.parametrize("keys", [("K",), ("K", "L")])
def test_same_rows_as_the_plain_join(spark, keys, spread_rows):
    legacy, modern = sides(spark, spread_rows)
    rules = C.make_rules(legacy, modern, keys)
    for how in ("full_outer", "right_outer", "inner"):
        plain = C.join_sides(legacy, modern, rules, how, spread_rows=None)
        found = C.join_sides(legacy, modern, rules, how, spread_rows=spread_rows)
        assert found.columns == plain.columns
        assert Counter(map(str, found.collect())) == Counter(map(str, plain.collect()))
    fields = ["K", "L", "T"]
    plain = C.join_sides_by_condition(legacy, modern, keys, fields, spread_rows=None)
    found = C.join_sides_by_condition(legacy, modern, keys, fields, spread_rows=spread_rows)
    assert found.columns == plain.columns
    assert Counter(map(str, found.collect())) == Counter(map(str, plain.collect()))


def test_more_crowded_keys_than_are_marked(spark, monkeypatch):
    monkeypatch.setattr(S, "MARKED", 2)
    legacy, modern = sides(spark, 3)
    rules = C.make_rules(legacy, modern, ("K",))
    assert S.crowded_keys(legacy, modern, ["K"], 1).count() == 2
    plain = C.join_sides(legacy, modern, rules, spread_rows=None)
    assert Counter(map(str, C.join_sides(legacy, modern, rules, spread_rows=1).collect())) == Counter(map(str, plain.collect()))


def test_empty_sides(spark):
    legacy, modern = sides(spark, 4)
    rules = C.make_rules(legacy, modern, ("K",))
    none = modern.limit(0)
    assert C.join_sides(legacy, none, rules, spread_rows=5).filter(C.IN_LEGACY).count() == legacy.count()
    assert C.join_sides(legacy.limit(0), none, rules, spread_rows=5).count() == 0


@pytest.mark.parametrize("other", ["blank on one side", "blank on both sides"])
def test_no_task_takes_a_key_of_most_records(spark, other):
    """A blank key holds 90 % of a side. The records are dealt to 64 partitions as the join does it."""
    legacy = spark.range(40_000).select(F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("").alias("K"), F.lit("x").alias("T"))
    keep = F.col("K") != "" if other == "blank on one side" else F.rand(1) < 0.03
    modern = legacy.filter(keep)
    left, right = S.spread_sides(legacy, modern, ["K"], 500)
    for side in (left, right):
        share = side.repartition(64, "K", *S.CHUNK_COLUMNS).groupBy(F.spark_partition_id()).count()
        n, most = share.agg(F.sum("count"), F.max("count")).first()
        assert most <= max(4 * 500, 4 * n / 64)
    plain = legacy.repartition(64, "K").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert plain > 36_000


def test_metrics_use_the_count_of_the_join_again(spark):
    legacy, modern = sides(spark, 5)
    rules = C.make_rules(legacy, modern, ("K",))
    joined = C.join_sides(legacy, modern, rules, spread_rows=20)
    found = M.metrics(legacy, modern, C.tag_mismatches(joined, rules), rules).first()
    plain = C.tag_mismatches(C.join_sides(legacy, modern, rules, spread_rows=None), rules)
    expected = plain.agg(*M.join_measures(rules)).first()
    assert (found.total_legacy_records, found.total_modern_records) == (legacy.count(), modern.count())
    assert all(found[c] == expected[c] for c in expected.asDict())


def test_crowded_keys_are_bounded_and_broadcast(spark):
    legacy, modern = sides(spark, 6)
    rules = C.make_rules(legacy, modern, ("K",))
    plan = C.join_sides(legacy, modern, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and f"TakeOrderedAndProject(limit={S.MARKED}" in plan
    assert "FullOuter" in plan and "Python" not in plan and "NestedLoop" not in plan
