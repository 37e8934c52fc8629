"""Whole jobs, their outputs and the plans behind them."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fixedrecon import ReconSpec, SimpleSpec, reconcile, reconcile_simple, sinks
from fixedrecon.layout import layout_from_tuples
from fixedrecon.operators import compare as C
from fixedrecon.operators import quality as Q
from fixedrecon.operators import records as R
from fixedrecon.plans.reconcile import profile_sides
from fixedrecon.streaming import check_arrivals, compare_arrivals, prepare_legacy, prepared_legacy
from fixedrecon.streaming.prepared import part_of
from tests.session import session
from workload import fixtures as X
from workload import queries as W

SF01 = "/root/testdata/sf0.01"
SF001 = "/root/testdata/sf0.001"


def write(lines, path):
    lines.write.text(str(path))
    return str(path)


@pytest.fixture(scope="module")
def customer_run(tmp_path_factory):
    spark, base = session(), tmp_path_factory.mktemp("job")
    spec = ReconSpec(
        layout=X.CUST,
        legacy=write(X.customer_legacy(spark, SF01), base / "legacy"),
        modern=write(X.customer_modern(spark, SF01), base / "modern"),
        output=str(base / "out"),
        keys=("CUST_ID",),
        tolerance=X.CUST_TOLERANCE,
    )
    return reconcile(spark, spec)


def test_golden_counts(customer_run):
    """Counts worked out by hand for this fixture."""
    m = {k: v for k, v in customer_run.metrics.items()}
    assert (m["total_legacy_records"], m["total_modern_records"]) == (1500, 1486)
    assert (m["legacy_only_records"], m["modern_only_records"], m["common_records"]) == (30, 16, 1470)
    assert (m["mismatched_records"], m["mismatched_common_records"]) == (366, 320)
    assert (float(m["match_rate_percent"]), float(m["common_match_rate_percent"])) == (75.10, 78.23)
    assert customer_run.field_mismatches == {"CUST_NAME": 228, "NATION": 46, "SEGMENT": 122, "BALANCE": 87}
    assert m["compared_fields"] == ["CUST_ID", "CUST_NAME", "NATION", "SEGMENT", "BALANCE"]
    assert m["verdict"].startswith("Significant")


def test_outputs(spark, customer_run):
    paths = customer_run.paths
    assert re.search(r"/mismatch_details/\d{8}_\d{6}$", paths["mismatch_details"])
    assert spark.read.parquet(paths["mismatch_details"]).count() == 366
    summary = {r.Metric: float(r.Value) for r in spark.read.csv(paths["summary"], header=True).collect()}
    assert (summary["Perfect Matches"], summary["Fields Compared"]) == (1470 - 366, 5)
    report = spark.read.parquet(paths["report"])
    assert {r.section for r in report.select("section").distinct().collect()} == {
        "copybook", "comparison", "structure", "field analysis", "recommendation",
    }
    stats = {r.field_name: int(r.mismatched) for r in spark.read.parquet(paths["field_stats"]).collect()}
    assert stats == customer_run.field_mismatches
    assert spark.read.parquet(paths["run_metrics"]).count() == 3
    assert "duplicate_details" not in paths and customer_run.duplicate_keys == 0
    assert not os.path.exists(os.path.join(paths["mismatch_details"].split("mismatch_details")[0], "_work", os.path.basename(paths["mismatch_details"])))
    assert customer_run.structure["legacy"]["issues"] == []


def test_equal_sides_report_no_details(spark, tmp_path):
    path = write(X.customer_legacy(spark, SF001), tmp_path / "same")
    result = reconcile(
        spark, ReconSpec(layout=X.CUST, legacy=path, modern=path, output=str(tmp_path / "out"), keys=("CUST_ID",))
    )
    assert "mismatch_details" not in result.paths
    assert float(result.metrics["match_rate_percent"]) == 100.0


def test_empty_files(spark, tmp_path):
    empty = write(spark.createDataFrame([], "value string"), tmp_path / "empty")
    result = reconcile(
        spark, ReconSpec(layout=X.CUST, legacy=empty, modern=empty, output=str(tmp_path / "out"), keys=("CUST_ID",))
    )
    assert result.structure["legacy"]["avg_length"] is None
    assert int(result.metrics["common_records"]) == 0


def test_structure_of_both_passes_agrees(spark, tmp_path):
    """The job's structure numbers equal the stand-alone report."""
    path = write(X.customer_modern(spark, SF01, defects=True), tmp_path / "broken")
    result = reconcile(
        spark, ReconSpec(layout=X.CUST, legacy=path, modern=path, output=str(tmp_path / "out"), keys=("CUST_ID",))
    )
    report = Q.structure_report(R.read_fixed_width(spark, path, X.CUST), X.CUST, X.CUST_KEYS).first().asDict()
    report.pop("validation_timestamp")
    job = dict(result.structure["modern"])
    job.pop("validation_timestamp")
    assert job == report
    assert len(job["issues"]) == 3


def test_hot_keys_give_the_metrics_of_the_full_join(spark, tmp_path):
    base = dict(
        layout=X.ORD,
        legacy=write(X.order_legacy(spark, SF001), tmp_path / "legacy"),
        modern=write(X.order_modern(spark, SF001), tmp_path / "modern"),
        keys=("STATUS", "PRIORITY"),
        ignore=("ORDER_ID", "ORDER_TIME"),
        tolerance={"AMOUNT": 5000},
    )
    full = reconcile(spark, ReconSpec(output=str(tmp_path / "full"), duplicate_keys="pairs", **base))
    hot = reconcile(spark, ReconSpec(output=str(tmp_path / "hot"), spread_rows=3, **base))
    assert full.duplicate_keys == hot.duplicate_keys > 10
    assert "duplicate_details" not in full.paths
    assert hot.metrics == full.metrics
    assert hot.field_mismatches == full.field_mismatches
    assert hot.structure["legacy"]["issues"] == full.structure["legacy"]["issues"]
    listed = spark.read.parquet(hot.paths["duplicate_details"])
    pairs = listed.filter("hot__side = 'legacy'").agg(F.sum("hot__mismatched_pairs")).first()[0]
    rest = spark.read.parquet(hot.paths["mismatch_details"]).count() if "mismatch_details" in hot.paths else 0
    assert int(pairs) + rest == int(full.metrics["mismatched_records"])


def test_simple_job_with_and_without_hot_keys(spark, tmp_path):
    layout = layout_from_tuples("P", [("A", 1, 1, "STRING"), ("B", 2, 4, "STRING")])
    legacy = ["kx  ", "kx  ", "kxy ", "ab  ", "zz  ", "zz  ", "zz  ", "c  d"]
    modern = ["kx  ", "ky  ", "kx  ", "ab  ", "c d "]
    paths = {}
    for name, rows in (("legacy", legacy), ("modern", modern)):
        paths[name] = write(spark.createDataFrame([(r,) for r in rows], "value string"), tmp_path / name)
    pairs = dict(keys=("A",), duplicate_keys="pairs", **paths)
    full = reconcile_simple(spark, SimpleSpec(layout, output=str(tmp_path / "full"), **pairs))
    chunked = reconcile_simple(spark, SimpleSpec(layout, output=str(tmp_path / "chunked"), spread_rows=2, **pairs))
    for kind in full:
        assert sorted(map(str, spark.read.csv(full[kind], header=True).collect())) == sorted(
            map(str, spark.read.csv(chunked[kind], header=True).collect())
        )
    assert set(full) == {"validation_results", "bad_records"}
    assert spark.read.csv(full["validation_results"], header=True).count() == 9 + 1 + 3 + 1
    assert spark.read.csv(full["bad_records"], header=True).count() == 5
    hot = reconcile_simple(
        spark, SimpleSpec(layout, output=str(tmp_path / "hot"), keys=("A",), spread_rows=2, **paths)
    )
    assert spark.read.csv(hot["validation_results"], header=True).count() == 1 + 3 + 1
    assert spark.read.csv(hot["bad_records"], header=True).count() == 0
    records = spark.read.parquet(hot["duplicate_records"]).filter("hot__side = 'legacy'")
    assert int(records.agg(F.sum("hot__mismatched_pairs")).first()[0]) == 5


@pytest.mark.parametrize("choice", ["variants", "pairs"])
def test_one_output_form_at_every_number_of_records(spark, tmp_path, choice):
    """The same columns and tables whether a key has one record a side or a thousand."""
    layout = layout_from_tuples("P", [("A", 1, 1, "STRING"), ("B", 2, 4, "STRING")])
    forms = []
    for n in (2, 10, 1000 if choice == "variants" else 60):
        rows = {"legacy": [f"k{i % 7:03d}" for i in range(n)], "modern": [f"k{i % 5:03d}" for i in range(n)]}
        paths = {s: write(spark.createDataFrame([(r,) for r in v], "value string"), tmp_path / f"{s}{n}") for s, v in rows.items()}
        run = reconcile(
            spark,
            ReconSpec(layout=layout, output=str(tmp_path / f"out{n}"), keys=("A",), duplicate_keys=choice, spread_rows=20, **paths),
        )
        details = "duplicate_details" if choice == "variants" else "mismatch_details"
        forms.append((sorted(run.paths), spark.read.parquet(run.paths[details]).columns))
        wrong = sum(a != b for a in rows["legacy"] for b in rows["modern"])
        assert int(run.metrics["mismatched_records"]) == wrong
    assert forms[0] == forms[1] == forms[2]


def test_simple_job_reads_a_short_copybook(spark, tmp_path):
    book = tmp_path / "book"
    book.mkdir()
    (book / "P.cpy").write_text("05 A PIC X(1).\n05 B PIC X(3).\n")
    path = write(spark.createDataFrame([("kabc",), ("lxyz",)], "value string"), tmp_path / "in")
    out = reconcile_simple(spark, SimpleSpec(str(book), legacy=path, modern=path, output=str(tmp_path / "out"), keys=("A",)))
    assert spark.read.csv(out["validation_results"], header=True).columns[:2] == ["l_A", "l_B"]
    (book / "Q.cpy").write_text("05 A PIC X(1).\n")
    with pytest.raises(ValueError, match="several copybooks"):
        reconcile_simple(spark, SimpleSpec(str(book), legacy=path, modern=path, output=str(tmp_path / "no"), keys=("A",)))


def test_stream_runs_once_per_file(spark, tmp_path):
    folder = write(X.customer_modern(spark, SF001, defects=True).repartition(3), tmp_path / "in")
    args = (spark, folder, X.CUST, X.CUST_KEYS, str(tmp_path / "progress"), str(tmp_path / "out"))
    check_arrivals(*args).awaitTermination()
    first = spark.read.parquet(str(tmp_path / "out")).count()
    check_arrivals(*args).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == first == 3
    more = write(X.customer_legacy(spark, SF001), tmp_path / "more")
    import glob
    import shutil

    for f in glob.glob(f"{more}/part-*.txt"):
        shutil.copy(f, folder)
    check_arrivals(*args).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 4
    assert out.agg(F.sum("records")).first()[0] == X.customer_modern(spark, SF001).count() + X.customer_legacy(spark, SF001).count()


def test_stream_comparison(spark, tmp_path):
    folder = write(X.customer_modern(spark, SF001), tmp_path / "in")
    legacy, modern = W.customers(spark, SF001)
    rules = W.customer_rules(legacy, modern)
    compare_arrivals(
        spark, folder, X.CUST, legacy, rules, str(tmp_path / "progress"), str(tmp_path / "out")
    ).awaitTermination()
    tagged = C.tag_mismatches(C.join_sides(legacy, modern, rules).filter(C.IN_MODERN), rules)
    expected = {r.CUST_ID for r in C.mismatch_details(tagged, rules).collect()}
    assert {r.CUST_ID for r in spark.read.parquet(str(tmp_path / "out")).collect()} == expected


def test_prepared_legacy_reads_the_folders_of_a_batch(spark, tmp_path):
    legacy, modern = W.customers(spark, SF001)
    rules = W.customer_rules(legacy, modern)
    prepare_legacy(legacy, rules.keys, str(tmp_path / "legacy"), parts=50)
    prepared = prepared_legacy(spark, str(tmp_path / "legacy"))
    assert prepared.met_by(modern).count() == legacy.count()
    keys = [r[0] for r in legacy.select("CUST_ID").orderBy("CUST_ID").limit(2).collect()]
    lines = X.customer_modern(spark, SF001).filter(F.substring("value", 1, 10).isin(keys))
    folder = write(lines, tmp_path / "in")
    hit = {r[0] for r in legacy.filter(F.col("CUST_ID").isin(keys)).select(part_of(rules.keys, 50)).collect()}
    others = [f for f in (tmp_path / "legacy" / "records").glob("legacy__part=*/*.parquet") if int(f.parent.name.split("=")[1]) not in hit]
    assert len(others) > 40
    for f in others:  # whatever reads them fails
        f.write_bytes(b"no table")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    compare_arrivals(spark, folder, X.CUST, prepared, rules, str(tmp_path / "progress"), str(tmp_path / "out")).awaitTermination()
    part = modern.filter(F.col("CUST_ID").isin(keys))
    tagged = C.tag_mismatches(C.join_sides(legacy, part, rules).filter(C.IN_MODERN), rules)
    expected = C.mismatch_details(tagged, rules).drop("validation_timestamp")
    found = spark.read.parquet(str(tmp_path / "out")).select(*expected.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) != []


def test_prepared_legacy_with_crowded_null_and_no_keys(spark, tmp_path):
    rows = [("k", str(i)) for i in range(300)] + [(None, "n"), ("z", "1")]
    legacy = spark.createDataFrame(rows, "K string, V string")
    prepared = prepare_legacy(legacy, ["K"], str(tmp_path / "a"), parts=8)
    batch = spark.createDataFrame([("k", "7"), (None, "n"), ("y", "0")], "K string, V string")
    rules = C.Rules(("K",), ("K", "V"))
    for spread in (None, 10):
        joined = C.join_sides(prepared.met_by(batch), batch, rules, "right_outer", spread_rows=spread)
        assert joined.count() == 302 and joined.filter(~F.col(C.IN_LEGACY)).count() == 2
    empty = prepare_legacy(legacy.limit(0), ["K"], str(tmp_path / "b"), parts=8)
    assert empty.met_by(batch).columns == ["K", "V"] and empty.met_by(batch).count() == 0
    with pytest.raises(ValueError, match="prepared for the keys"):
        compare_arrivals(spark, str(tmp_path), X.CUST, empty, C.Rules(("V",), ("K", "V")), "p", "o")
    with pytest.raises(ValueError, match="no prepared legacy"):
        prepared_legacy(spark, str(tmp_path / "none"))


def test_runs_of_one_second_have_folders_of_their_own(spark, tmp_path):
    now = datetime(2024, 2, 28, 23, 59, 59)
    stamps = [sinks.claim_stamp(spark, f"{tmp_path}/", now) for _ in range(3)]
    assert stamps == ["20240228_235959", "20240229_000000", "20240229_000001"]
    assert sinks.claim_stamp(spark, str(tmp_path / "other"), now) == stamps[0]


def test_csv_keeps_blank_and_missing_apart(spark, tmp_path):
    values = [("", None), ('say "x"', "a\\b"), ("a,b", "|"), ("\tA", "\x00"), (" B ", "B\x01"), ("\x00", "\x00A")]
    df = spark.createDataFrame(values, "x string, y string")
    sinks.write_results(df, str(tmp_path / "csv"), "csv")
    assert sorted(map(str, sinks.read_csv(spark, str(tmp_path / "csv"), df.schema).collect())) == sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_native_with_one_shuffle_per_side(spark, tmp_path):
    legacy = R.read_fixed_width(spark, write(X.order_legacy(spark, SF001), tmp_path / "l"), X.ORD)
    modern = R.read_fixed_width(spark, write(X.order_modern(spark, SF001), tmp_path / "m"), X.ORD)
    rules = C.make_rules(legacy, modern, ["ORDER_ID"], ignore=["ORDER_TIME"])
    plan = plan_of(C.mismatch_details(C.tag_mismatches(C.join_sides(legacy, modern, rules, spread_rows=None), rules), rules))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Python" not in plan and "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
    assert "FullOuter" in plan
    # unused slices never reach the shuffle
    assert "45, 6" not in plan
    assert "Exchange hashpartitioning" not in plan_of(Q.structure_report(legacy, X.ORD, ["ORDER_ID"]))


def test_pass_over_keys_shuffles_two_counts(spark, tmp_path):
    """Key, length and two partial counts; no other column of a record."""
    path = write(X.customer_legacy(spark, SF001), tmp_path / "l")
    records = R.read_fixed_width(spark, path, X.CUST)
    profile = profile_sides(records, records, ("CUST_ID",))
    partial = [p for p in plan_of(profile).split("\n") if "partial_sum" in p]
    assert len(partial) == 1 and partial[0].count("partial_sum") == 2
    assert plan_of(profile).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", sorted(W.QUERIES))
def test_no_query_pairs_everything(spark, name):
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    result = W.QUERIES[name](spark, SF001)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    ran = store.executionsList(int(before), 1000)  # what a query that writes files has run by now
    plan = plan_of(result) + "".join(ran.apply(i).physicalPlanDescription() for i in range(ran.size()))
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan and not re.search("EvalPython|InPandas|InArrow|PythonUDF", plan)
