"""Copybooks to layouts: widths, positions, repetitions, redefinitions."""

import random

import pytest
from pyspark.sql import functions as F

from fixedrecon.functions import picture as P
from fixedrecon.layout import Layout, LayoutField, collect_layout, layout_from_tuples
from fixedrecon.operators import copybook as B
from fixedrecon.operators import quality as Q
from fixedrecon.operators.layout import (
    all_rejects,
    fields_to_compare,
    gather_books,
    layout_alignment,
    layout_schema,
    parse_copybooks,
    parsing_summary,
    place_entries,
)
from fixedrecon.sources import copybook_lines, scan_copybooks, write_copybook_libraries

# The customer master record as (level, name, clauses).
CUSTOMER = [
    (1, "CUSTOMER-MASTER-RECORD", ""),
    (5, "CUSTOMER-ID", "PIC X(10)"),
    (5, "CUSTOMER-INFO", ""),
    (10, "FIRST-NAME", "PIC X(20)"),
    (10, "LAST-NAME", "PIC X(20)"),
    (10, "MIDDLE-INITIAL", "PIC X(1)"),
    (5, "ADDRESS-INFO", ""),
    (10, "STREET-ADDRESS", "PIC X(40)"),
    (10, "CITY", "PIC X(25)"),
    (10, "STATE", "PIC X(2)"),
    (10, "ZIP-CODE", "PIC X(10)"),
    (5, "CONTACT-INFO", ""),
    (10, "PHONE-NUMBERS", "OCCURS 3 TIMES"),
    (15, "PHONE-NUMBER", "PIC X(15)"),
    (15, "PHONE-TYPE", "PIC X(1)"),
    (10, "EMAIL-ADDRESS", "PIC X(50)"),
    (5, "ACCOUNT-INFO", ""),
    (10, "ACCOUNT-BALANCE", "PIC S9(10)V99 COMP-3"),
    (10, "CREDIT-LIMIT", "PIC S9(8)V99"),
    (10, "ACCOUNT-STATUS", "PIC X(1)"),
    (10, "OPEN-DATE", "PIC X(8)"),
    (10, "LAST-ACTIVITY-DATE", "PIC X(8)"),
    (5, "DEMOGRAPHICS", ""),
    (10, "BIRTH-DATE", "PIC X(8)"),
    (10, "GENDER", "PIC X(1)"),
    (10, "INCOME-RANGE", "PIC X(2)"),
    (5, "AUDIT-FIELDS", ""),
    (10, "CREATED-DATE", "PIC X(8)"),
    (10, "CREATED-TIME", "PIC X(6)"),
    (10, "UPDATED-DATE", "PIC X(8)"),
    (10, "UPDATED-TIME", "PIC X(6)"),
    (10, "RECORD-VERSION", "PIC 9(3)"),
    (5, "FILLER", "PIC X(25)"),
]
# Start and length of its columns.
CUSTOMER_POSITIONS = {
    "CUSTOMER_ID": (1, 10), "FIRST_NAME": (11, 20), "LAST_NAME": (31, 20), "MIDDLE_INITIAL": (51, 1),
    "STREET_ADDRESS": (52, 40), "CITY": (92, 25), "STATE": (117, 2), "ZIP_CODE": (119, 10),
    "PHONE_NUMBER_01": (129, 15), "PHONE_TYPE_01": (144, 1), "PHONE_NUMBER_02": (145, 15),
    "PHONE_TYPE_02": (160, 1), "PHONE_NUMBER_03": (161, 15), "PHONE_TYPE_03": (176, 1),
    "EMAIL_ADDRESS": (177, 50), "ACCOUNT_BALANCE": (227, 12), "CREDIT_LIMIT": (239, 10),
    "ACCOUNT_STATUS": (249, 1), "OPEN_DATE": (250, 8), "LAST_ACTIVITY_DATE": (258, 8),
    "BIRTH_DATE": (266, 8), "GENDER": (274, 1), "INCOME_RANGE": (275, 2), "CREATED_DATE": (277, 8),
    "CREATED_TIME": (285, 6), "UPDATED_DATE": (291, 8), "UPDATED_TIME": (299, 6),
    "RECORD_VERSION": (305, 3), "FILLER": (308, 25),
}
CUSTOMER_GROUPS = {"PHONE_NUMBERS_01": (129, 16), "PHONE_NUMBERS_02": (145, 16), "PHONE_NUMBERS_03": (161, 16)}


def render(entries):
    return "\n".join(f"       {level:02d}  {name:<24}{clauses}".rstrip() + "." for level, name, clauses in entries)


def lines_of(spark, **books):
    table = spark.createDataFrame(list(books.items()), "id string, text string")
    return copybook_lines(table, F.col("id"), F.col("text"))


def layout_of(spark, text):
    return collect_layout(parse_copybooks(lines_of(spark, book=text)))


def places(layout, kind="elementary"):
    return {f.name: (f.start, f.length) for f in layout.fields if f.kind == kind}


def test_customer_master(spark, tmp_path):
    (tmp_path / "customer_master.cob").write_text(render(CUSTOMER))
    lines = scan_copybooks(spark, str(tmp_path / "*.cob"))
    table = parse_copybooks(lines)
    layout = collect_layout(table)
    assert (layout.name, layout.record_length) == ("CUSTOMER_MASTER_RECORD", 332)
    assert places(layout) == CUSTOMER_POSITIONS
    assert places(layout, "group_occurrence") == CUSTOMER_GROUPS
    assert len(layout.columns()) == 29
    assert len(layout.schema(include_group_slices=True).fields) == 32
    assert (layout.field("ACCOUNT_BALANCE").data_type, layout.field("ACCOUNT_BALANCE").decimals) == ("DECIMAL", 2)
    summary = parsing_summary(lines, table).first()
    assert (summary.total_fields, summary.parsed_lines, summary.record_length) == (33, 33, 332)
    names = [r.field_name for r in layout_schema(table).orderBy("ordinal").collect()]
    assert names == [f.name for f in layout.columns()]


@pytest.mark.parametrize(
    "clause, kind, length, decimals",
    [
        ("X(10)", "STRING", 10, 0),
        ("9(5)", "INTEGER", 5, 0),
        ("9(10)V99", "DECIMAL", 12, 2),
        ("S9(8)V99", "DECIMAL", 10, 2),
        ("X(10).", "STRING", 10, 0),
        ("S9(8)V99.", "DECIMAL", 10, 2),
        ("S9(10)V99 COMP-3.", "DECIMAL", 12, 2),
        ("X(9)", "STRING", 9, 0),
        ("XXX", "STRING", 3, 0),
        ("999", "INTEGER", 3, 0),
        ("A(4)", "STRING", 4, 0),
        ("S9(5)", "INTEGER", 5, 0),
        ("9(3)V9(4)", "DECIMAL", 7, 4),
        ("x(7)", "STRING", 7, 0),
    ],
)
def test_picture(spark, clause, kind, length, decimals):
    picture = P.picture_clause(F.lit(f" PIC {clause}"))
    row = spark.range(1).select(
        P.picture_type(picture).alias("kind"),
        P.picture_length(picture).alias("length"),
        P.picture_decimals(picture).alias("decimals"),
    ).first()
    assert (row.kind, row.length, row.decimals) == (kind, length, decimals)


def test_elementary_array(spark):
    layout = layout_of(spark, "       01 R.\n       05  PHONE-ARRAY PIC X(15) OCCURS 5 TIMES.")
    assert places(layout) == {f"PHONE_ARRAY_0{i + 1}": (1 + 15 * i, 15) for i in range(5)}


def test_array_in_last_place_counts_fully(spark):
    layout = layout_of(spark, "       05 A PIC X(2).\n       05 B PIC X(3) OCCURS 4 TIMES.")
    assert layout.record_length == 14
    assert layout.name == "UNKNOWN_COPYBOOK"


def test_redefinition_takes_no_room(spark):
    layout = layout_of(
        spark,
        "       05  CUSTOMER-NAME PIC X(30).\n"
        "       05  ALT-NAME PIC X(30) REDEFINES CUSTOMER-NAME.\n"
        "       05  NEXT-ONE PIC X(2).",
    )
    assert places(layout) == {"CUSTOMER_NAME": (1, 30), "ALT_NAME": (1, 30), "NEXT_ONE": (31, 2)}


NESTED = (
    "       01  R.\n           05  A PIC X(4).\n           05  B.\n"
    "               10  B1 PIC X(6).\n               10  B2 PIC X(6).\n"
    "           05  C REDEFINES B.\n               10  C1 PIC X(2).\n"
    "               10  C2 PIC X(8).\n               10  C3 REDEFINES C2.\n"
    "                   15  C31 PIC 9(3).\n                   15  C32 REDEFINES C31 PIC X(1).\n"
    "           05  D REDEFINES C PIC X(12).\n           05  E PIC X(1)."
)
NESTED_PLACES = {
    "A": (1, 4), "B1": (5, 6), "B2": (11, 6), "C1": (5, 2), "C2": (7, 8), "C31": (7, 3),
    "C32": (7, 1), "D": (5, 12), "E": (17, 1),
}


def test_nested_redefinitions(spark):
    assert places(layout_of(spark, NESTED)) == NESTED_PLACES


def test_redefinition_inside_a_repeated_group(spark):
    layout = layout_of(
        spark,
        "       01  R.\n           05  G OCCURS 2.\n               10  X PIC X(3).\n"
        "               10  Y REDEFINES X PIC 9(3).\n               10  Z PIC X.",
    )
    assert places(layout) == {
        "X_01": (1, 3), "Y_01": (1, 3), "Z_01": (4, 1), "X_02": (5, 3), "Y_02": (5, 3), "Z_02": (8, 1),
    }
    assert places(layout, "group_occurrence") == {"G_01": (1, 4), "G_02": (5, 4)}


def test_shallower_field_between_groups(spark):
    layout = layout_of(
        spark,
        "       01  R.\n       05 G1.\n       10 X PIC X(5).\n       05 Y PIC X(3).\n       05 G2.\n       10 Z PIC X(2).",
    )
    assert places(layout) == {"X": (1, 5), "Y": (6, 3), "Z": (9, 2)}


def test_two_records_start_at_one(spark):
    text = "       01  R1.\n           05  A PIC X(5).\n       01  R2.\n           05  B PIC X(7)."
    table = parse_copybooks(lines_of(spark, book=text))
    starts = {r.field_name: (r.record_name, r.start_pos) for r in table.filter("kind = 'elementary'").collect()}
    assert starts == {"A": ("R1", 1), "B": ("R2", 1)}
    assert [f.name for f in collect_layout(table).columns()] == ["A"]
    assert collect_layout(table, record_name="R2").record_length == 7


def test_free_format_comments_continuations(spark):
    text = (
        "      ****\n      * remark\n\n000100 01  REC.\n    05  FREE-NAME\n+   PIC X(4).\n"
        "000300     05  SECOND\n000400-    PIC 9(2) OCCURS 2.\n       88  FLAG VALUE 'Y'.\nC  old remark"
    )
    layout = layout_of(spark, text)
    assert layout.name == "REC"
    assert places(layout) == {"FREE_NAME": (1, 4), "SECOND_01": (5, 2), "SECOND_02": (7, 2)}


def test_rejects_do_not_stop_the_rest(spark):
    text = "       01  R.\n       5 NAME PIC X.\n       05 A PIC X(ABC).\n       05 B PIC X()\n       05 C PIC X(2)."
    lines = lines_of(spark, book=text)
    reasons = {r.line_no: r.reject_reason for r in B.rejected_lines(lines).collect()}
    assert set(reasons) == {2, 3, 4}
    assert reasons[2] == "no level number and name"
    assert places(layout_of(spark, text)) == {"C": (1, 2)}


def test_repeated_names_are_numbered_and_ignored_by_base(spark):
    text = "       01  R.\n       05 FILLER PIC X(2).\n       05 A PIC X.\n       05 FILLER PIC X(3)."
    table = parse_copybooks(lines_of(spark, book=text))
    assert places(collect_layout(table)) == {"FILLER": (1, 2), "A": (3, 1), "FILLER_2": (4, 3)}
    columns = layout_schema(table).join(table.select("copybook_id", "field_name", "base_name"), ["copybook_id", "field_name"])
    assert [r.field_name for r in fields_to_compare(columns, ["FILLER"]).collect()] == ["A"]


def test_many_copybooks_at_once_need_one_shuffle(spark):
    books = {f"b{i}": f"       01  R{i}.\n       05 A PIC X({i + 1}).\n       05 B PIC 9(2)." for i in range(50)}
    table = parse_copybooks(lines_of(spark, **books))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(copybook_id")
    assert "Join" not in plan and "Python" not in plan
    ends = {r.copybook_id: r.end_pos for r in table.filter("field_name = 'B'").collect()}
    assert ends == {f"b{i}": i + 3 for i in range(50)}


def test_simple_layout(spark):
    # The employee layout.
    text = "EMP-ID PIC X(5)\nEMP-NAME PIC X(15)\nEMP-DEPT pic x(5)\nEMP-SALARY PIC 9(10)\nSKIPPED PIC S9(3)"
    placed = B.simple_positions(B.simple_fields(lines_of(spark, book=text))).orderBy("line_no").collect()
    assert [(r.field_name, r.start_pos, r.end_pos, r.data_type) for r in placed] == [
        ("EMP_ID", 1, 5, "STRING"), ("EMP_NAME", 6, 20, "STRING"),
        ("EMP_DEPT", 21, 25, "STRING"), ("EMP_SALARY", 26, 35, "NUMERIC"),
    ]


def test_short_copybook_that_does_not_fit_is_rejected(spark):
    wide = "A PIC X(5)\nB PIC X(99999999999)\nC PIC 9(2)"
    huge = "A PIC X(5)\nB PIC X(" + "9" * 30 + ")"
    lines = lines_of(spark, good="A PIC X(5)\nB PIC X(2147483642)", wide=wide, huge=huge, long="A PIC X(2147483647)\nB PIC 9(1)")
    placed = B.simple_positions(B.simple_fields(lines)).collect()
    assert {(r.copybook_id, r.field_name, r.start_pos, r.end_pos) for r in placed} == {("good", "A", 1, 5), ("good", "B", 6, 2147483647)}
    assert {(r.copybook_id, r.line_no, r.reject_reason) for r in B.simple_rejects(lines).collect()} == {
        ("wide", 2, "length is too large"), ("wide", 3, "ends beyond the last position"),
        ("huge", 2, "length is too large"), ("long", 2, "ends beyond the last position"),
    }


def test_tuple_layout_and_alignment(spark):
    # The positions layout.
    layout = layout_from_tuples(
        "POSITIONS",
        [("CUSIP", 1, 9, "STRING"), ("BROKERAGE_ACCT", 10, 21, "STRING"), ("POSITION_ID", 22, 31, "STRING"), ("PARTITION_ID", 32, 36, "STRING")],
    )
    assert layout.record_length == 36
    rows = [("p", "r", f.name, f.start, f.end) for f in layout.fields] + [("p", "r", "X", 36, 40), ("p", "r", "Y", 43, 44)]
    table = spark.createDataFrame(rows, "copybook_id string, record_name string, field_name string, start_pos int, end_pos int")
    found = {r.field_name: r.alignment for r in layout_alignment(table).collect()}
    assert (found["POSITION_ID"], found["X"], found["Y"]) == ("ok", "overlap", "gap")


def test_bad_copybooks_do_not_end_the_parse(spark):
    """Too large an OCCURS is rejected, alone or by expansion; the good copybook beside it stays."""
    texts = {
        "good": "01 A.\n05 B PIC X(3).",
        "deep": "01 A.\n05 G OCCURS 60000.\n10 H OCCURS 60000.\n15 I PIC X(2).",
        "long": "01 A.\n05 B PIC X(3) OCCURS 10000000000.\n05 C PIC X(2).",
        "wide": "01 A.\n05 B PIC X(999999999) OCCURS 3.",
    }
    rows = spark.createDataFrame(list(texts.items()), "id string, body string")
    lines = copybook_lines(rows, F.col("id"), F.col("body"))
    found = {(r.copybook_id, r.field_name, r.start_pos) for r in parse_copybooks(lines).collect()}
    assert found == {("good", "A", 1), ("good", "B", 1), ("long", "A", 1), ("long", "C", 1)}
    rejects = {(r.copybook_id, r.line_no, r.reject_reason) for r in all_rejects(lines).collect()}
    assert rejects == {
        ("deep", 2, "expansion does not fit"), ("deep", 3, "expansion does not fit"),
        ("long", 2, "OCCURS count is too large"), ("wide", 2, "expansion does not fit"),
    }


def test_name_after_many_comments(spark):
    body = "\n".join(["* remark"] * 15 + ["01 LATE-NAME.", "05 B PIC X.", ""])
    lines = copybook_lines(spark.createDataFrame([("c", body)], "id string, body string"), F.col("id"), F.col("body"))
    assert lines.count() == 17
    assert {r.copybook_name for r in parse_copybooks(lines).collect()} == {"LATE_NAME"}


def test_field_inside_an_earlier_longer_one_overlaps(spark):
    rows = [("c", "r", "A", 1, 100), ("c", "r", "B", 10, 20), ("c", "r", "C", 50, 60), ("c", "r", "D", 103, 110)]
    table = spark.createDataFrame(rows, "copybook_id string, record_name string, field_name string, start_pos long, end_pos long")
    found = {r.field_name: (r.alignment, r.distance) for r in layout_alignment(table).collect()}
    assert found == {"A": ("ok", 0), "B": ("overlap", -91), "C": ("overlap", -51), "D": ("gap", 2)}


def test_files_of_one_name_stay_apart(spark, tmp_path):
    for folder, field in (("a", "X"), ("b", "Z")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "CUST.cob").write_text(f"01 R.\n05 {field} PIC X.\n")
    lines = scan_copybooks(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    fields = {(r.copybook_id[-10:], r.field_name) for r in parse_copybooks(lines).collect()}
    assert {("a/CUST.cob", "X"), ("b/CUST.cob", "Z")} <= fields


def test_type_errors_have_one_rule(spark):
    layout = Layout("T", 60, (
        LayoutField("I", 1, 10, "INTEGER"), LayoutField("D", 11, 10, "DECIMAL", 2), LayoutField("W", 21, 40, "INTEGER"),
    ))
    good = [("5", "12.5", "9" * 40), ("-5", "-.5", ""), ("+7 ", "7.", " "), ("", "12", "0"), ("0000000001", "1", "1")]
    bad = [("12.5", "1.2.3", "x"), ("1e3", "1e3", "9" * 41), ("5-", "-", "1 2"), ("99999999999", ".", "--1"), ("N/A", "1,5", "+")]
    schema = "I string, D string, W string"
    assert {r.invalid_values for r in Q.type_errors(spark.createDataFrame(good, schema), layout).collect()} == {0}
    assert {r.invalid_values for r in Q.type_errors(spark.createDataFrame(bad, schema), layout).collect()} == {5}


def test_libraries_hold_many_copybooks(spark, tmp_path):
    bodies = ["       01  A.\n           05  B PIC X.", "", "x\n", "x\n\n", "./ ADD NAME=Z\n.\n./ ENDUP\n..\n./ ENDUP", "a\r\nb\r.c\u2028.d", ".", "é\n"] * 40
    books = spark.createDataFrame([(f"M{i}", b) for i, b in enumerate(bodies)], "id string, body string").repartition(3)
    write_copybook_libraries(books, F.col("id"), F.col("body"), str(tmp_path / "lib"))
    assert len(list((tmp_path / "lib").glob("*.txt"))) <= 3
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # splits fall inside members
    try:
        scanned = scan_copybooks(spark, str(tmp_path / "lib"), r"\.txt\((.*)\)$", libraries=True)
        found = sorted(map(tuple, scanned.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == sorted(map(tuple, copybook_lines(books, F.col("id"), F.concat("body", F.lit("\n"))).collect()))


def test_entries_are_placed_once(spark):
    """A test for copybooks that fit must not repeat the pass over the entries."""
    books = spark.createDataFrame([("c", "       01  A.\n           05  B PIC X.")], "id string, body string")
    table = parse_copybooks(copybook_lines(books, F.col("id"), F.col("body"), tasks=2))
    assert table._jdf.queryExecution().optimizedPlan().toString().count("aggregate(entries#") == 1
    assert table.count() == 2


def test_placing_copies_no_state(spark):
    lines = spark.createDataFrame([("A", i, "01  REC." if i == 1 else f"    05  F-{i} PIC X(3).") for i in range(1, 400)], "copybook_id string, line_no int, raw string")
    placed = place_entries(gather_books(lines))
    # a transform copies what its function returns: the entries placed so far, for every entry
    assert "element_at(transform(array(" not in placed._jdf.queryExecution().optimizedPlan().toString()
    last = placed.selectExpr("size(placed) AS n", "element_at(placed, -1).first AS first").first()
    assert (last["n"], last["first"]) == (399, 3.0 * 397)


def test_patterns_run_once_a_statement_and_names_are_compared_in_shared_families_only(spark):
    lines = spark.createDataFrame([("A", 1, "01  REC."), ("A", 2, "    05  F PIC X(3).")], "copybook_id string, line_no int, raw string")
    described = B.describe_entries(B.statements(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert described.count(P.ENTRY) == 1
    parsed = parse_copybooks(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "shared_families" in parsed


def test_pre_tests_change_no_result(spark):
    """Every attribute against the patterns alone, on texts of all kinds."""
    draw = random.Random(5)
    parts = ["X(3)", "9(2)", "s9(4)", "V99", "v9(2)", "A", "x", "(12)", "X(ABC)", "X(0123456789)", "9((2))", ")", "(", "S", "V", ".", "-", "P(3)", "X()", "OCCURS", "B"]
    pictures = ["", *("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(600))]
    heads = ["05  A-B", " 01\tX", "5 SHORT", "05 05", "77 77-77", "  05 a_02_13 ", "05", "05  N\u00e9E", "05 A\u00a0B", "05 A\nB", "05 A\r", "\x0b05\x0cF"]
    tails = ["", ".", " PIC X(3).", " pic is 9(2)V9.", " PICTURE S9(4).", "\tOCCURS 3 TIMES", " occurs 99999999999", " REDEFINES B-C.", " redefines  x OCCURS 2 PIC XX..", " PICX(3)", " XPIC 9", " PIC X.Y."]
    texts = [h + t for h in heads for t in tails]

    statement, clauses = F.col("t"), F.regexp_extract("t", P.ENTRY, 3)
    level, found = F.regexp_extract("t", P.ENTRY, 1), F.regexp_extract(clauses, P.OCCURS, 1)
    named = F.upper(F.translate(F.regexp_extract("t", P.ENTRY, 2), "-", "_"))
    target = F.regexp_extract(clauses, P.REDEFINES, 1)
    rows = B.describe_entries(
        spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "line_no int, statement string").withColumn("t", F.col("statement"))
    ).select(
        "t", "level", "field_name", "pic_clause", "occurs", "redefines", F.coalesce(F.col("reject_reason") == "no level number and name", F.lit(False)).alias("no"),
        F.when(level != "", level.cast("int")).alias("level_"), named.alias("field_name_"),
        F.regexp_replace(F.regexp_extract(clauses, P.PICTURE, 1), r"\.$", "").alias("pic_clause_"),
        F.greatest(F.coalesce(found.try_cast("int"), F.lit(1)), F.lit(1)).alias("occurs_"),
        F.when(target != "", F.upper(F.translate(target, "-", "_"))).alias("redefines_"), (~statement.rlike(P.FIELD_LINE)).alias("no_"),
    )
    for r in rows.collect():
        names = ("level", "field_name", "pic_clause", "occurs", "redefines", "no")
        assert [r[c] for c in names] == [r[c + "_"] for c in names], r.t

    def width(part):
        repeats = F.regexp_extract_all(part, F.lit(P.REPEAT), F.lit(1))
        singles = F.length(F.translate(F.regexp_replace(part, P.REPEAT, ""), "()", ""))
        return F.aggregate(repeats, F.lit(0), lambda a, n: a + n.cast("int")) + singles

    picture, symbols = F.col("p"), F.regexp_replace("p", r"\(\d+\)", "")
    fraction = F.regexp_extract("p", "(?i)^[^V]*V(.*)$", 1)
    for r in spark.createDataFrame([(p,) for p in [*pictures, None]], "p string").select(
        "p",
        F.array(P.picture_length(picture), P.picture_decimals(picture)).alias("n"),
        F.array(width(F.regexp_replace("p", "(?i)^S?([^V]*)V?", "$1")), F.when(fraction != "", width(fraction)).otherwise(0)).alias("n_"),
        F.struct(P.picture_type(picture), P.has_bad_repeat(picture)).alias("k"),
        F.struct(F.when(symbols.rlike("(?i)V"), "DECIMAL").when(symbols.contains("9"), "INTEGER").otherwise("STRING"), picture.rlike(P.BAD_REPEAT)).alias("k_"),
    ).collect():
        assert (r.n, tuple(r.k)) == (r.n_, tuple(r.k_)), r.p
