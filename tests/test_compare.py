"""Comparison rules, properties of the comparison, hot keys against brute force."""

import random
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixedrecon.functions.text import normalise_spaces, slice_field, slice_field_rtrim
from fixedrecon.layout import layout_from_tuples
from fixedrecon.operators import compare as C
from fixedrecon.operators import hot_keys as H
from fixedrecon.operators import metrics as M
from fixedrecon.operators import records as R

SCHEMA = "K string, T string, N string"
KEYS = ["K"]


def frames(spark, legacy, modern, tolerance=None):
    left = spark.createDataFrame(legacy, SCHEMA)
    right = spark.createDataFrame(modern, SCHEMA)
    return left, right, C.make_rules(left, right, KEYS, tolerance=tolerance or {})


def details(left, right, rules):
    tagged = C.tag_mismatches(C.join_sides(left, right, rules), rules)
    return {r.K: r for r in C.mismatch_details(tagged, rules).collect()}


def measured(left, right, rules):
    tagged = C.tag_mismatches(C.join_sides(left, right, rules), rules)
    return M.metrics(left, right, tagged, rules).first()


@pytest.mark.parametrize(
    "legacy, modern, text, number",
    [
        ("5", "5", False, False),
        ("5", "6", True, False),
        ("5", "8", True, True),
        ("5", "", True, True),
        ("", "", False, False),
        (None, "", False, False),
        (None, None, False, False),
        (None, "5", True, True),
        ("x", "x", False, False),
        ("x", "5", True, True),
        ("05.0", "5", True, False),
    ],
)
def test_truth_table(spark, legacy, modern, text, number):
    left, right, rules = frames(spark, [("k", legacy, legacy)], [("k", modern, modern)], {"N": 2.0})
    found = details(left, right, rules)
    assert (found["k"].mismatched_fields if found else []) == ["T"] * text + ["N"] * number


def test_one_sided_records(spark):
    left, right, rules = frames(spark, [("a", "x", "1"), ("b", "", "1")], [("c", "y", "2")], {"N": 2.0})
    found = details(left, right, rules)
    # a blank text and a field with tolerance do not count without partner
    assert {k: (r.record_status, r.mismatched_fields) for k, r in found.items()} == {
        "a": ("legacy_only", ["T"]), "c": ("modern_only", ["T"]),
    }
    assert found["a"].T_comparison == "T:L[x]!=M[NULL]"
    assert (found["a"].T_legacy, found["a"].T_modern) == ("x", "")


def test_strict_profile_ignores_null(spark):
    left, right, _ = frames(spark, [("a", "x", None), ("b", "x", "1")], [("a", "y", "2")])
    joined = C.join_sides_by_condition(left, right, KEYS, ["K", "T", "N"])
    found = {r.l_K: (r.mismatched_fields, r.mismatch_count) for r in C.simple_result(joined, KEYS, ["K", "T", "N"]).collect()}
    assert found == {"a": (["T"], 1), "b": ([], 0)}


def test_scaled_decimals(spark):
    layout = layout_from_tuples("R", [("K", 1, 1, "STRING"), ("T", 2, 2, "STRING")])
    from dataclasses import replace

    from fixedrecon.layout import LayoutField

    layout = replace(layout, fields=(*layout.fields, LayoutField("N", 3, 5, "DECIMAL", 2, base_name="N")))
    left = spark.createDataFrame([("a", "", "00100")], SCHEMA)
    right = spark.createDataFrame([("a", "", "00101")], SCHEMA)
    plain = C.make_rules(left, right, KEYS, tolerance={"N": 0.02}, layout=layout)
    scaled = C.make_rules(left, right, KEYS, tolerance={"N": 0.02}, layout=layout, scale_implied_decimals=True)
    assert list(details(left, right, plain)) == ["a"]
    assert details(left, right, scaled) == {}


def test_field_named_like_metadata_is_refused(spark):
    layout = layout_from_tuples("R", [("RECORD_LENGTH", 1, 4, "STRING")])
    with pytest.raises(ValueError, match="RECORD_LENGTH"):
        R.parse_records(spark.createDataFrame([("0004",)], "value string"), layout)


def test_columns_in_layout_order():
    columns = ["row_number", "B", "A", "FILLER", "K", "load_timestamp"]
    assert C.compared_columns(columns, ["K", "A", "B", "FILLER", "source_file"], ["FILLER"]) == ["B", "A", "K"]
    assert M.array_bases(["A_01", "A_02", "B", "C_X", "D_1"]) == ["A", "D"]


records = st.lists(
    st.tuples(st.sampled_from("abcde"), st.sampled_from(["", "x", "y"]), st.sampled_from(["1", "2", "9"])),
    max_size=12, unique_by=lambda r: r[0],
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(legacy=records, modern=records)
def test_properties(spark, legacy, modern):
    left, right, rules = frames(spark, legacy, modern)
    m = measured(left, right, rules)
    assert m.total_legacy_records == m.common_records + m.legacy_only_records
    assert m.total_modern_records == m.common_records + m.modern_only_records
    back = measured(right, left, rules)
    assert (back.legacy_only_records, back.modern_only_records) == (m.modern_only_records, m.legacy_only_records)
    assert back.mismatched_records == m.mismatched_records
    assert measured(left, left, rules).mismatched_records == 0


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.tuples(*[st.text("abc ", max_size=6)] * 3))
def test_slices_give_the_line_back(spark, values):
    line = "".join(v.ljust(6) for v in values)
    sliced = spark.createDataFrame([(line,)], "value string").select(
        *[slice_field_rtrim(F.col("value"), 1 + 6 * i, 6).alias(f"f{i}") for i in range(3)]
    ).first()
    assert "".join(v.ljust(6) for v in sliced) == line


def test_trimming(spark):
    row = spark.createDataFrame([("  a  b\t ",)], "value string").select(
        slice_field(F.col("value"), 1, 8), slice_field_rtrim(F.col("value"), 1, 8), normalise_spaces(F.col("value"))
    ).first()
    assert tuple(row) == ("a  b\t", "  a  b", "a b\t")


def test_normalise_only_named_columns(spark):
    df = spark.createDataFrame([("a  b", "c  d")], "x string, y string")
    assert tuple(R.normalise_record_spaces(df, ["x"]).first()) == ("a b", "c  d")


def differs(a, b, limit):
    def number(v):
        try:
            return float(v)
        except (TypeError, ValueError):
            return None

    text = (a[1] or "") != (b[1] or "")
    x, y = number(a[2]), number(b[2])
    numeric = limit > 0 and x is not None and y is not None
    n = abs(x - y) > limit if numeric else (a[2] or "") != (b[2] or "")
    return text, n


def skewed(seed, modern=False):
    """Two thirds of the rows share two keys; copies, blanks and text in numbers."""
    rng = random.Random(seed)
    rows = []
    for _ in range(240):
        key = rng.choice(["", "hot", "hot", rng.choice("abcdefgh"), "one" if not modern else "two"])
        number = rng.choice(["", "x", "1", "1.0", "2", "3.5", "-4", "100", str(rng.randint(0, 30) / 4)])
        rows.append((key, rng.choice(["", None, "p", "q"]), number))
    return rows


@pytest.mark.parametrize("limit", [0, 0.5, 2.0])
def test_hot_keys_equal_all_pairs(spark, limit):
    legacy, modern = skewed(1), skewed(2, modern=True)
    left, right, rules = frames(spark, legacy, modern, {"N": limit} if limit else {})
    hot_table = H.key_profile(left, right, KEYS).filter(H.crowded(20))
    hot = {r.K: (r.rows__legacy, r.rows__modern) for r in hot_table.collect()}
    assert {"", "hot", "one", "two"} <= set(hot)
    split = H.split_marked(left, right, hot_table, KEYS)

    # what is joined: everything but the keys hot on both sides
    joined = H.join_rest(split, rules).select("K", C.IN_LEGACY, C.IN_MODERN).collect()
    both = {k for k, (n, m) in hot.items() if n and m}
    plain = C.join_sides(left, right, rules).select("K", C.IN_LEGACY, C.IN_MODERN).collect()
    assert sorted(map(tuple, joined)) == sorted(tuple(r) for r in plain if r.K not in both)

    # pairs in chunks: every pair once, with the columns of the outer join
    chunked = H.join_pairs(split, rules, 7)
    expected = C.join_sides(left, right, rules).filter(F.col("K").isin(list(both)))
    assert chunked.columns == expected.columns
    assert sorted(map(str, chunked.collect())) == sorted(map(str, expected.collect()))

    # what is counted: the same as over all pairs
    sides = H.variants(split.both_legacy, rules), H.variants(split.both_modern, rules)
    partners = H.partner_counts(*sides, rules)
    pairs = [(a, b) for a, b in product(legacy, modern) if a[0] == b[0] and a[0] in both]
    equal = sum(1 for a, b in pairs if not any(differs(a, b, limit)))
    assert int(partners.agg(H.equal_pairs()).first()[0]) == equal
    fields = {r.field_name: int(r.equal_pairs) for r in H.hot_field_equals(*sides, rules).collect()}
    for i, f in enumerate(["T", "N"]):
        assert fields.get(f, 0) == sum(1 for a, b in pairs if not differs(a, b, limit)[i])
    listed = H.hot_details(partners).groupBy("hot__side").agg(F.sum("hot__mismatched_pairs").alias("n")).collect()
    assert {r.hot__side: int(r.n) for r in listed} == dict.fromkeys(("legacy", "modern"), len(pairs) - equal)


@pytest.mark.parametrize("limit", [3, 0.5, 0.1])
def test_dense_numbers_are_counted_without_pairs(spark, limit):
    """Exact numbers, inexact ones, text and NaN of one key; the exact ones never meet in a join."""
    rng = random.Random(5)
    values = ["", "x", "NaN", "-0.0", "0.1", "0.30000000000000004", "1e20", "99999999999999", "9007199254740993", "1e-3", "Infinity"]
    values += [str(n) for n in range(-30, 30)] + [str(n / 8) for n in range(-9, 9)] + [str(n / 10) for n in range(-9, 9)]
    sides = [[("k", "p", rng.choice(values)) for _ in range(400)] for _ in range(2)]
    left, right, rules = frames(spark, *sides, {"N": limit})
    variants = [H.variants(s.withColumns({"rows__legacy": F.lit(400), "rows__modern": F.lit(400)}), rules) for s in (left, right)]
    found = {r.field_name: int(r.equal_pairs) for r in H.hot_field_equals(*variants, rules).collect()}

    def equal(x, y):
        try:
            return abs(float(x) - float(y)) <= limit
        except ValueError:
            return x == y

    assert found == {"T": 160_000, "N": sum(equal(a[2], b[2]) for a, b in product(*sides))}
    if limit == 3:
        dense = [[("k", "p", str(n % 2000)) for n in range(2000)]] * 2
        left, right, rules = frames(spark, *dense, {"N": 5000})
        variants = [H.variants(s.withColumns({"rows__legacy": F.lit(2000), "rows__modern": F.lit(2000)}), rules) for s in (left, right)]
        largest = []

        def rows_out(node):
            if node.getClass().getSimpleName().endswith("Join") or "JoinExec" in node.getClass().getSimpleName():
                largest.append(node.metrics().apply("numOutputRows").value())
            for i in range(node.children().size()):
                rows_out(node.children().apply(i))
            if node.getClass().getSimpleName().endswith("QueryStageExec"):
                rows_out(node.plan())

        result = H.hot_field_equals(*variants, rules)
        assert {r.field_name: int(r.equal_pairs) for r in result.collect()} == {"T": 4_000_000, "N": 4_000_000}
        plan = result._jdf.queryExecution().executedPlan()
        rows_out(plan.executedPlan() if hasattr(plan, "executedPlan") else plan)
        assert all(n < 10_000 for n in largest)


def test_null_keys_never_match(spark):
    left, right, rules = frames(spark, [(None, "x", "1")] * 30, [(None, "x", "1")] * 30)
    profile = H.key_profile(left, right, KEYS)
    m = profile.agg(*H.profile_measures(KEYS)).first()
    assert (m.legacy_only_records, m.modern_only_records, int(m.common_records)) == (30, 30, 0)
    split = H.split_marked(left, right, profile.filter(H.crowded(10)), KEYS)
    assert H.join_rest(split, rules).count() == 60
    assert split.both_legacy.count() == 0
