"""The same results in DuckDB SQL, written from the rules of the layouts and
checks, not from the Spark code. Copybook results are closed formulas over
``part``; record results slice the rendered lines again."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- rendered lines


def money(c: str) -> str:
    return (
        f"CASE WHEN {c} < 0 THEN '-' || lpad(CAST(-({c}) AS VARCHAR), 11, '0') "
        f"ELSE lpad(CAST({c} AS VARCHAR), 12, '0') END"
    )


def customer_line(key: str, name: str, segment: str, cents: str) -> str:
    return (
        f"lpad(CAST({key} AS VARCHAR), 10, '0') || rpad({name}, 25, ' ') || "
        f"lpad(CAST(nation AS VARCHAR), 3, '0') || rpad({segment}, 12, ' ') || {money(cents)}"
    )


CASED = "CASE WHEN k % 11 = 0 THEN upper(name) ELSE name END"
MODERN_NAME = f"CASE WHEN k % 29 = 0 THEN replace({CASED}, '#', '  #') ELSE {CASED} END"
MODERN_SEGMENT = "CASE WHEN k % 19 = 0 THEN '' ELSE segment END"
MODERN_CENTS = (
    "(cents + CASE WHEN k % 13 = 0 THEN 25 ELSE 0 END + CASE WHEN k % 17 = 0 THEN 100 ELSE 0 END)"
)
LEGACY_NAME = "CASE WHEN k % 29 = 0 THEN replace(name, '#', ' #') ELSE name END"

CUST_LINES = f"""
cust AS (SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
    CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer),
legacy_lines AS (SELECT {customer_line('k', LEGACY_NAME, 'segment', 'cents')} AS value FROM cust),
modern_raw AS (
    SELECT k, {customer_line('k', MODERN_NAME, MODERN_SEGMENT, MODERN_CENTS)} AS value
    FROM cust WHERE k % 50 <> 7
    UNION ALL
    SELECT k, {customer_line('k + 1000000', MODERN_NAME, MODERN_SEGMENT, MODERN_CENTS)} AS value
    FROM cust WHERE k % 97 = 3),
modern_lines AS (SELECT value FROM modern_raw),
broken_lines AS (SELECT CASE WHEN k % 101 = 0 THEN ''
        WHEN k % 23 = 0 THEN substring(CASE WHEN k % 31 = 0 THEN '          ' || substring(value, 11) ELSE value END, 1, 58)
        WHEN k % 31 = 0 THEN '          ' || substring(value, 11) ELSE value END AS value
    FROM modern_raw)"""

CUST_FIELDS = [("CUST_ID", 1, 10), ("CUST_NAME", 11, 25), ("NATION", 36, 3), ("SEGMENT", 39, 12), ("BALANCE", 51, 12)]
ORD_FIELDS = [("ORDER_ID", 1, 10), ("STATUS", 11, 1), ("AMOUNT", 12, 10), ("ORDER_DATE", 22, 8), ("PRIORITY", 30, 15), ("ORDER_TIME", 45, 6)]
LINE_FIELDS = [("ORDER_ID", 1, 10), ("LINE_NO", 11, 2), ("PART_ID", 13, 10), ("QUANTITY", 23, 4), ("FLAG", 27, 1)]


def sliced(fields, source, extra=""):
    cols = ", ".join(f"trim(substring(value, {s}, {n})) AS {f}" for f, s, n in fields)
    return f"SELECT {cols}{extra} FROM {source}"


LENGTHS = ", length(value) AS record_length, 62 AS expected_length, length(value) = 62 AS length_match"
CUST = f"""WITH {CUST_LINES},
l AS ({sliced(CUST_FIELDS, 'legacy_lines', LENGTHS)}),
m AS ({sliced(CUST_FIELDS, 'modern_lines', LENGTHS)}),
b AS ({sliced(CUST_FIELDS, 'broken_lines', LENGTHS)})"""

TEXT_VALUES = ["CUST_NAME", "NATION", "SEGMENT"]
VALUES = [*TEXT_VALUES, "BALANCE"]
PAIRS = ", ".join(f"l.{f} AS {f}_legacy, m.{f} AS {f}_modern" for f in VALUES)
CUST_JOIN = f"""{CUST},
j AS (SELECT coalesce(l.CUST_ID, m.CUST_ID) AS CUST_ID, {PAIRS},
    l.CUST_ID IS NOT NULL AS in_l, m.CUST_ID IS NOT NULL AS in_m
    FROM l FULL OUTER JOIN m ON l.CUST_ID = m.CUST_ID),
t AS (SELECT *, CASE WHEN in_l AND in_m THEN 'common' WHEN in_l THEN 'legacy_only' ELSE 'modern_only' END AS record_status,
    {', '.join(f"coalesce({f}_legacy, '') <> coalesce({f}_modern, '') AS d_{f}" for f in TEXT_VALUES)},
    CASE WHEN TRY_CAST(BALANCE_legacy AS DOUBLE) IS NOT NULL AND TRY_CAST(BALANCE_modern AS DOUBLE) IS NOT NULL
         THEN abs(TRY_CAST(BALANCE_legacy AS DOUBLE) - TRY_CAST(BALANCE_modern AS DOUBLE)) > 50
         WHEN in_l AND in_m THEN BALANCE_legacy <> BALANCE_modern ELSE false END AS d_BALANCE
    FROM j)"""


def tag_text(fields, prefix="d_"):
    tags = ", ".join(f"CASE WHEN {prefix}{f} THEN '{f}' END" for f in fields)
    return f"concat_ws('|', {tags})"


def tag_count(fields, prefix="d_"):
    return " + ".join(f"CASE WHEN {prefix}{f} THEN 1 ELSE 0 END" for f in fields)


def any_tag(fields):
    return "(" + " OR ".join(f"d_{f}" for f in fields) + ")"


def comparison(f):
    return (
        f"CASE WHEN d_{f} THEN '{f}:L[' || coalesce({f}_legacy, 'NULL') || ']!=M[' || "
        f"coalesce({f}_modern, 'NULL') || ']' END AS {f}_comparison"
    )


def details(keys, fields, source="t"):
    return f"""SELECT {keys},
    {', '.join(f"coalesce({f}_legacy, '') AS {f}_legacy, coalesce({f}_modern, '') AS {f}_modern" for f in fields)},
    {', '.join(comparison(f) for f in fields)},
    {tag_text(fields)} AS mismatched_fields, record_status,
    CAST({tag_count(fields)} AS BIGINT) AS mismatch_count
FROM {source} WHERE {any_tag(fields)}"""


def order_line(status, cents):
    return f"""lpad(CAST(k AS VARCHAR), 10, '0') || {status} ||
    CASE WHEN k % 53 = 0 THEN '      N/A ' ELSE lpad(CAST({cents} AS VARCHAR), 10, '0') END ||
    CASE WHEN k % 41 = 0 THEN '00000000' WHEN k % 43 = 0 THEN substring(day, 1, 4) || '0230'
         WHEN k % 47 = 0 THEN '        ' ELSE day END ||
    rpad(priority, 15, ' ') || lpad(CAST(k * 7919 % 250000 AS VARCHAR), 6, '0')"""


ORD = f"""WITH ord AS (SELECT o_orderkey AS k, o_orderstatus AS status,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents, strftime(o_orderdate, '%Y%m%d') AS day,
    o_orderpriority AS priority FROM orders),
legacy_lines AS (SELECT {order_line('status', 'cents')} AS value FROM ord),
modern_lines AS (SELECT {order_line("CASE WHEN k % 37 = 0 THEN 'X' ELSE status END",
    "(cents + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 9 = 0 THEN 2 ELSE 0 END)")} AS value
    FROM ord WHERE k % 61 <> 5),
l AS ({sliced(ORD_FIELDS, 'legacy_lines')}),
m AS ({sliced(ORD_FIELDS, 'modern_lines')})"""


def line_line(quantity):
    return (
        "lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || "
        f"lpad(CAST(l_partkey AS VARCHAR), 10, '0') || lpad(CAST({quantity} AS VARCHAR), 4, '0') || l_returnflag"
    )


LINE = f"""WITH legacy_lines AS (SELECT {line_line('CAST(l_quantity AS BIGINT)')} AS value FROM lineitem),
modern_lines AS (SELECT {line_line('CAST(l_quantity AS BIGINT) + CASE WHEN l_partkey % 17 = 0 THEN 1 ELSE 0 END')} AS value
    FROM lineitem WHERE l_suppkey % 20 <> 3),
l AS ({sliced(LINE_FIELDS, 'legacy_lines')}),
m AS ({sliced(LINE_FIELDS, 'modern_lines')})"""
LINE_VALUES = ["PART_ID", "QUANTITY", "FLAG"]

TAG_LINES = """WITH lines AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') || rpad(p_name, 12, ' ') ||
    rpad(p_brand, 12, ' ') || rpad(p_type, 12, ' ') AS value FROM part)"""

# ---------------------------------------------------------------- copybooks

# line number, text; {k}, s, d and o are the part's key, size, digits and repetitions
COPYBOOK_LINES = [
    "'      * PART RECORD ' || p_brand",
    "CASE WHEN k % 4 = 1 THEN '       01  part-rec.' ELSE '000100 01  PART-REC.' END",
    "''",
    "'           05  PART-ID                 PIC 9(10).'",
    "'           05  PART-BODY.'",
    "'               10  PART-NAME           PIC X(' || s || ').'",
    "'               10  PART-PRICE          PIC S9(' || d || ')V99 COMP-3.'",
    "'                   88  PRICE-FREE      VALUE ZERO.'",
    "'               10  PART-TAGS           OCCURS ' || o || ' TIMES.'",
    "'                   15  TAG-CODE        PIC X(3).'",
    "'                   15  TAG-QTY         PIC 99 OCCURS 2.'",
    "'           05  PART-ALT                PIC X(5) REDEFINES ' || CASE WHEN k % 10 = 7 THEN 'NO-SUCH-NAME.' ELSE 'PART-BODY.' END",
    "'           05  PART-SIZE'",
    "'      +        PICTURE IS 9(3).'",
    "CASE WHEN k % 10 = 3 THEN '           05  BAD-FIELD           PIC X(ABC).' ELSE '           05  FILLER                  PIC A(4).' END",
    "CASE WHEN k % 6 = 0 THEN '        5  SHORT-LEVEL             PIC X.' ELSE 'C     OLD STYLE REMARK' END",
    "'           05  FILLER                  PIC X(7).'",
    "CASE WHEN k % 5 = 0 THEN '       01  PART-TRAILER.' ELSE '      * END' END",
    "CASE WHEN k % 5 = 0 THEN '           05  TRAILER-COUNT       PIC 9(6).' ELSE '' END",
]
BOOK = f"""WITH p AS (SELECT p_partkey AS k, 'PART' || p_partkey AS copybook_id, p_brand,
    CAST(p_size AS BIGINT) AS s, CAST(p_size % 7 + 1 AS BIGINT) AS d, CAST(p_size % 4 + 1 AS BIGINT) AS o FROM part),
book AS ({' UNION ALL '.join(f"SELECT *, CAST({i} AS BIGINT) AS line_no, {t} AS raw FROM p" for i, t in enumerate(COPYBOOK_LINES, 1))})"""

# lines that stay: not a comment, not blank
KEPT = """line_no NOT IN (1, 3) AND NOT (line_no = 16 AND k % 6 <> 0) AND NOT (line_no IN (18, 19) AND k % 5 <> 0)"""
# without columns 1-6 the text starts at column 7
STATEMENT = """CASE WHEN line_no = 13 THEN rtrim(substring(raw, 7)) || ' PICTURE IS 9(3).' ELSE rtrim(substring(raw, 7)) END"""
USABLE = """line_no NOT IN (1, 3, 14) AND NOT (line_no = 15 AND k % 10 = 3) AND line_no <> 16
    AND NOT (line_no IN (18, 19) AND k % 5 <> 0)"""


def per_line(values: dict[int, str], default: str) -> str:
    cases = " ".join(f"WHEN {n} THEN {v}" for n, v in values.items())
    return f"CASE line_no {cases} ELSE {default} END"


def entry_query(column: str, values: dict[int, str], default: str, where: str = "") -> str:
    return f"""{BOOK} SELECT copybook_id, line_no, {per_line(values, default)} AS {column}
FROM book WHERE {USABLE}{where}"""


# positions: where the parts of the record start
PLACED = f"""{BOOK},
q AS (SELECT *, 13 + s + d AS tags, 13 + s + d + 7 * o AS body_end, 13 + s + d + 7 * o + CASE WHEN k % 10 = 7 THEN 5 ELSE 0 END AS size_at,
    13 + s + d + 7 * o + CASE WHEN k % 10 = 7 THEN 8 ELSE 3 END AS filler_at FROM p),
occ AS (SELECT q.*, i FROM q, range(1, 5) AS r(i) WHERE i <= o),
f AS (
    SELECT copybook_id, 1 AS rec, 4 AS line_no, 1 AS i, 1 AS n, 'PART_ID' AS base_name, 'PART_ID' AS field_name, 'elementary' AS kind, 1 AS occurs, 1 AS start_pos, 10 AS length, 'PART_REC' AS parent FROM q
    UNION ALL SELECT copybook_id, 1, 6, 1, 1, 'PART_NAME', 'PART_NAME', 'elementary', 1, 11, s, 'PART_BODY' FROM q
    UNION ALL SELECT copybook_id, 1, 7, 1, 1, 'PART_PRICE', 'PART_PRICE', 'elementary', 1, 11 + s, d + 2, 'PART_BODY' FROM q
    UNION ALL SELECT copybook_id, 1, 9, i, 0, 'PART_TAGS', 'PART_TAGS' || CASE WHEN o > 1 THEN '_0' || i ELSE '' END, CASE WHEN o > 1 THEN 'group_occurrence' ELSE 'group' END, o, tags + (i - 1) * 7, CASE WHEN o > 1 THEN 7 ELSE 0 END, 'PART_BODY' FROM occ
    UNION ALL SELECT copybook_id, 1, 10, i, 1, 'TAG_CODE', 'TAG_CODE' || CASE WHEN o > 1 THEN '_0' || i ELSE '' END, 'elementary', 1, tags + (i - 1) * 7, 3, 'PART_TAGS' FROM occ
    UNION ALL SELECT copybook_id, 1, 11, i, j, 'TAG_QTY', 'TAG_QTY' || CASE WHEN o > 1 THEN '_0' || i ELSE '' END || '_0' || j, 'elementary', 2, tags + (i - 1) * 7 + 1 + 2 * j, 2, 'PART_TAGS' FROM occ, range(1, 3) AS r2(j)
    UNION ALL SELECT copybook_id, 1, 12, 1, 1, 'PART_ALT', 'PART_ALT', 'elementary', 1, CASE WHEN k % 10 = 7 THEN body_end ELSE 11 END, 5, 'PART_REC' FROM q
    UNION ALL SELECT copybook_id, 1, 13, 1, 1, 'PART_SIZE', 'PART_SIZE', 'elementary', 1, size_at, 3, 'PART_REC' FROM q
    UNION ALL SELECT copybook_id, 1, 15, 1, 1, 'FILLER', 'FILLER', 'elementary', 1, filler_at, 4, 'PART_REC' FROM q WHERE k % 10 <> 3
    UNION ALL SELECT copybook_id, 1, 17, 1, 1, 'FILLER', CASE WHEN k % 10 = 3 THEN 'FILLER' ELSE 'FILLER_2' END, 'elementary', 1, filler_at + CASE WHEN k % 10 = 3 THEN 0 ELSE 4 END, 7, 'PART_REC' FROM q
    UNION ALL SELECT copybook_id, 2, 19, 1, 1, 'TRAILER_COUNT', 'TRAILER_COUNT', 'elementary', 1, 1, 6, 'PART_TRAILER' FROM q WHERE k % 5 = 0)"""
SCHEMA = f"""{PLACED},
cols AS (SELECT *, row_number() OVER (PARTITION BY copybook_id ORDER BY rec,
    CASE WHEN line_no IN (10, 11) THEN 10 ELSE line_no END, i, line_no, n) AS ordinal
    FROM f WHERE kind = 'elementary')"""
RECORD_END = "filler_at + CASE WHEN k % 10 = 3 THEN 6 ELSE 10 END"

SIMPLE = {
    4: ("PART_ID", "10", "NUMERIC"), 6: ("PART_NAME", "s", "STRING"), 10: ("TAG_CODE", "3", "STRING"),
    12: ("PART_ALT", "5", "STRING"), 17: ("FILLER", "7", "STRING"), 19: ("TRAILER_COUNT", "6", "NUMERIC"),
}
SIMPLE_ROWS = f"""{BOOK},
simple AS (SELECT copybook_id, line_no,
    {per_line({n: f"'{v[0]}'" for n, v in SIMPLE.items()}, "''")} AS field_name,
    CAST({per_line({n: v[1] for n, v in SIMPLE.items()}, '0')} AS BIGINT) AS length,
    {per_line({n: f"'{v[2]}'" for n, v in SIMPLE.items()}, "''")} AS data_type
    FROM book WHERE line_no IN (4, 6, 10, 12, 17) OR (line_no = 19 AND k % 5 = 0))"""

ORACLE["cb_normalise"] = f"""{BOOK} SELECT copybook_id, line_no, substring(raw, 7) AS text,
    line_no = 14 AS is_continuation FROM book WHERE {KEPT}"""
ORACLE["cb_continuation"] = f"""{BOOK} SELECT copybook_id, line_no, {STATEMENT} AS statement
FROM book WHERE {KEPT} AND line_no <> 14"""
ORACLE["cb_field_lines"] = f"""{BOOK} SELECT copybook_id, line_no, {STATEMENT} AS statement
FROM book WHERE {KEPT} AND line_no NOT IN (14, 16)"""
LEVELS = {2: "1", 6: "10", 7: "10", 8: "88", 9: "10", 10: "15", 11: "15", 18: "1"}
NAMES = {
    2: "'PART_REC'", 4: "'PART_ID'", 5: "'PART_BODY'", 6: "'PART_NAME'", 7: "'PART_PRICE'", 8: "'PRICE_FREE'",
    9: "'PART_TAGS'", 10: "'TAG_CODE'", 11: "'TAG_QTY'", 12: "'PART_ALT'", 13: "'PART_SIZE'",
    18: "'PART_TRAILER'", 19: "'TRAILER_COUNT'",
}
ORACLE["cb_level_name"] = f"""{BOOK} SELECT copybook_id, line_no, CAST({per_line(LEVELS, '5')} AS BIGINT) AS level,
    {per_line(NAMES, "'FILLER'")} AS field_name FROM book WHERE {USABLE}"""
PICTURES = {
    4: "'9(10)'", 6: "'X(' || s || ')'", 7: "'S9(' || d || ')V99'", 10: "'X(3)'", 11: "'99'", 12: "'X(5)'",
    13: "'9(3)'", 15: "'A(4)'", 17: "'X(7)'", 19: "'9(6)'",
}
ORACLE["cb_pic"] = entry_query("pic_clause", PICTURES, "''")
ORACLE["cb_pic_type"] = f"""{BOOK} SELECT copybook_id, line_no, {per_line(PICTURES, "''")} AS pic_clause,
    {per_line({4: "'INTEGER'", 7: "'DECIMAL'", 11: "'INTEGER'", 13: "'INTEGER'", 19: "'INTEGER'"}, "'STRING'")} AS data_type
FROM book WHERE {USABLE} AND line_no IN ({', '.join(map(str, PICTURES))})"""
ORACLE["cb_pic_length"] = entry_query(
    "length", {4: "10", 6: "s", 7: "d + 2", 10: "3", 11: "2", 12: "5", 13: "3", 15: "4", 17: "7", 19: "6"}, "0"
)
ORACLE["cb_decimals"] = entry_query("decimal_positions", {7: "CAST(2 AS BIGINT)"}, "CAST(0 AS BIGINT)")
ORACLE["cb_occurs"] = entry_query("occurs", {9: "o", 11: "2"}, "1")
ORACLE["cb_redefines"] = entry_query(
    "redefines", {12: "CASE WHEN k % 10 = 7 THEN 'NO_SUCH_NAME' ELSE 'PART_BODY' END"}, "NULL"
)
ORACLE["cb_positions"] = f"""{PLACED} SELECT copybook_id,
    CASE WHEN rec = 1 THEN 'PART_REC' ELSE 'PART_TRAILER' END AS record_name, field_name,
    CAST(start_pos AS BIGINT) AS start_pos, CAST(start_pos + length - 1 AS BIGINT) AS end_pos, parent
FROM f WHERE kind <> 'group'"""
ORACLE["cb_redefines_pos"] = f"""{PLACED} SELECT copybook_id, 'PART_ALT' AS field_name,
    CASE WHEN k % 10 = 7 THEN 'NO_SUCH_NAME' ELSE 'PART_BODY' END AS redefines, k % 10 <> 7 AS in_redefinition,
    CAST(CASE WHEN k % 10 = 7 THEN body_end ELSE 11 END AS BIGINT) AS start_pos FROM q"""
ORACLE["cb_occurs_expand"] = f"""{PLACED} SELECT copybook_id, base_name, field_name, kind, CAST(occurs AS BIGINT) AS occurs,
    CAST(CASE WHEN base_name = 'TAG_QTY' THEN (i - 1) * 2 + n ELSE i END AS BIGINT) AS occurrence,
    CAST(length AS BIGINT) AS length, CAST(start_pos AS BIGINT) AS start_pos FROM f WHERE line_no IN (9, 10, 11)"""
ORACLE["cb_name"] = f"{BOOK} SELECT copybook_id, 'PART_REC' AS copybook_name FROM p"
ORACLE["cb_record_length"] = f"{PLACED} SELECT copybook_id, CAST({RECORD_END} AS BIGINT) AS record_length FROM q"
ORACLE["cb_summary"] = f"""{PLACED} SELECT copybook_id,
    CAST(12 - CASE WHEN k % 10 = 3 THEN 1 ELSE 0 END + CASE WHEN k % 5 = 0 THEN 2 ELSE 0 END AS BIGINT) AS total_fields,
    CAST(13 + CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 5 = 0 THEN 2 ELSE 0 END AS BIGINT) AS parsed_lines,
    CAST({RECORD_END} AS BIGINT) AS record_length FROM q"""
ORACLE["cb_rejects"] = f"""{BOOK} SELECT copybook_id, line_no, {STATEMENT} AS statement,
    CASE WHEN line_no = 15 THEN 'repeat count is not a number' ELSE 'no level number and name' END AS reject_reason
FROM book WHERE (line_no = 15 AND k % 10 = 3) OR (line_no = 16 AND k % 6 = 0)"""
ORACLE["cb_simple"] = f"{SIMPLE_ROWS} SELECT * FROM simple"
ORACLE["cb_simple_positions"] = f"""{SIMPLE_ROWS}, ends AS (SELECT *, CAST(sum(length) OVER
    (PARTITION BY copybook_id ORDER BY line_no) AS BIGINT) AS end_pos FROM simple)
SELECT *, end_pos - length + 1 AS start_pos FROM ends"""
ORACLE["cb_overlays"] = """WITH s AS (SELECT 'SUPP' || s_suppkey AS copybook_id, s_suppkey % 5 + 3 AS a, s_suppkey % 3 + 1 AS n FROM supplier),
i AS (SELECT *, CASE WHEN n > 1 THEN '_0' || i ELSE '' END AS x, 7 + a + 6 * (i - 1) AS p FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM s)),
f AS (
    SELECT copybook_id, 'SUPP_REC' AS record_name, unnest([
        {'name': 'S_ID', 'b': 1, 'e': 6, 'r': false}, {'name': 'S_NAME', 'b': 7, 'e': 6 + a, 'r': false},
        {'name': 'ALT_A', 'b': 7, 'e': 8, 'r': true}, {'name': 'ALT_B', 'b': 9, 'e': 11, 'r': true},
        {'name': 'ALT_C1', 'b': 9, 'e': 9, 'r': true}, {'name': 'ALT_C2', 'b': 10, 'e': 11, 'r': true},
        {'name': 'S_THIRD', 'b': 7, 'e': 10, 'r': true}, {'name': 'S_END', 'b': 7 + a + 6 * n, 'e': 9 + a + 6 * n, 'r': false}]) AS e, 'elementary' AS kind FROM s
    UNION ALL SELECT copybook_id, 'SUPP_REC', unnest([
        {'name': 'L_CODE' || x, 'b': p, 'e': p + 3, 'r': false}, {'name': 'L_NUM' || x, 'b': p, 'e': p + 3, 'r': true},
        {'name': 'L_P1' || x, 'b': p, 'e': p, 'r': true}, {'name': 'L_P2' || x, 'b': p + 1, 'e': p + 3, 'r': true},
        {'name': 'L_QTY' || x, 'b': p + 4, 'e': p + 5, 'r': false}]), 'elementary' FROM i
    UNION ALL SELECT copybook_id, 'SUPP_REC', {'name': 'S_LINES' || x, 'b': p, 'e': p + 5, 'r': false}, 'group_occurrence' FROM i WHERE n > 1
    UNION ALL SELECT copybook_id, 'SUPP_TRAILER', unnest([{'name': 'T_COUNT', 'b': 1, 'e': 5, 'r': false}, {'name': 'T_TEXT', 'b': 1, 'e': 5, 'r': true}]), 'elementary' FROM s
)
SELECT copybook_id, record_name, e['name'] AS field_name, kind, CAST(e['b'] AS BIGINT) AS start_pos, CAST(e['e'] AS BIGINT) AS end_pos, e['r'] AS in_redefinition FROM f"""
SHORT = """WITH s AS (SELECT s_suppkey AS k, 'SHORT' || s_suppkey AS copybook_id FROM supplier),
f AS (SELECT k, copybook_id, unnest([
    {'line_no': 1, 'name': 'SUPP_ID', 'n': k % 9 + 1, 'kind': '9'},
    {'line_no': 2, 'name': 'SUPP_NOTE', 'n': CASE WHEN k % 7 = 0 THEN 99999999999 ELSE 12 END, 'kind': 'X'},
    {'line_no': 3, 'name': 'SUPP_TEXT', 'n': CASE WHEN k % 11 = 0 THEN 2147483647 ELSE 20 END, 'kind': 'X'},
    {'line_no': 4, 'name': 'SUPP_END', 'n': 2, 'kind': '9'}], recursive := true) FROM s)"""
ORACLE["cb_simple_fit"] = f"""{SHORT}, e AS (SELECT *, sum(n) OVER (PARTITION BY copybook_id ORDER BY line_no) AS upto FROM f WHERE k % 7 <> 0 AND k % 11 <> 0)
SELECT copybook_id, CAST(line_no AS BIGINT) AS line_no, name AS field_name, n AS length, CASE kind WHEN 'X' THEN 'STRING' ELSE 'NUMERIC' END AS data_type,
    CAST(upto - n + 1 AS BIGINT) AS start_pos, CAST(upto AS BIGINT) AS end_pos FROM e"""
ORACLE["cb_simple_rejects"] = f"""{SHORT}
SELECT copybook_id, CAST(line_no AS BIGINT) AS line_no, replace(name, '_', '-') || CASE WHEN line_no = 3 AND k % 11 <> 0 THEN ' pic x(' ELSE ' PIC ' || kind || '(' END || n || ')' AS statement,
    CASE WHEN line_no = 2 THEN 'length is too large' ELSE 'ends beyond the last position' END AS reject_reason
FROM f WHERE (k % 7 = 0 AND line_no >= 2) OR (k % 11 = 0 AND line_no >= 3)"""
ORACLE["cb_schema"] = f"{SCHEMA} SELECT copybook_id, ordinal, field_name, 'string' AS type FROM cols"
ORACLE["cmp_columns"] = f"""{SCHEMA} SELECT copybook_id, ordinal, field_name, field_name = 'PART_ID' AS is_key
FROM cols WHERE base_name NOT IN ('FILLER', 'TAG_QTY')"""
ORACLE["cmp_array_fields"] = f"""{SCHEMA} SELECT copybook_id, regexp_extract(field_name, '^(.*)_[0-9]+$', 1) AS base_name,
    count(*) AS columns FROM cols WHERE regexp_matches(field_name, '_[0-9]+$') GROUP BY ALL"""
ORACLE["src_copybook_lines"] = f"{BOOK} SELECT copybook_id, line_no, raw FROM book"
ORACLE["dq_copybook_alignment"] = f"""{PLACED} SELECT copybook_id, 'ok' AS alignment, count(*) AS fields FROM f
JOIN q USING (copybook_id) WHERE kind = 'elementary' AND (line_no <> 12 OR k % 10 = 7) GROUP BY ALL"""
ORACLE["dq_layout_alignment"] = """WITH p AS (SELECT 'PART' || p_partkey AS copybook_id, p_partkey % 3 AS r, CAST(p_size AS BIGINT) AS s,
    CAST(CASE p_partkey % 3 WHEN 1 THEN 2 WHEN 2 THEN -1 ELSE 0 END AS BIGINT) AS shift FROM part)
SELECT copybook_id, 'REC' AS record_name, 'ID' AS field_name, CAST(1 AS BIGINT) AS start_pos, CAST(10 AS BIGINT) AS end_pos, CAST(0 AS BIGINT) AS distance, 'ok' AS alignment FROM p
UNION ALL SELECT copybook_id, 'REC', 'NAME', 11 + shift, 10 + s + shift, shift,
    CASE r WHEN 1 THEN 'gap' WHEN 2 THEN 'overlap' ELSE 'ok' END FROM p
UNION ALL SELECT copybook_id, 'REC', 'PRICE', 11 + s + shift, 20 + s + shift, 0, 'ok' FROM p"""

# ---------------------------------------------------------------- sources, records

ORACLE["src_text_scan"] = f"WITH {CUST_LINES} SELECT value FROM legacy_lines"
ORACLE["src_tuple_layout"] = f"""{LINE} SELECT {', '.join(f"rtrim(substring(value, {s}, {n})) AS {f}" for f, s, n in LINE_FIELDS)} FROM legacy_lines"""
ORACLE["rec_slice"] = f"{CUST} SELECT {', '.join(f for f, _, _ in CUST_FIELDS)} FROM l"
ORACLE["rec_slice_array"] = f"""{TAG_LINES} SELECT trim(substring(value, 1, 10)) AS PART_ID,
    trim(substring(value, 11, 12)) AS TAG_01, trim(substring(value, 23, 12)) AS TAG_02, trim(substring(value, 35, 12)) AS TAG_03,
    trim(substring(value, 11, 12)) || '|' || trim(substring(value, 23, 12)) || '|' || trim(substring(value, 35, 12)) AS tags FROM lines"""
ORACLE["rec_slice_rtrim"] = f"""{ORD} SELECT {', '.join(f"rtrim(substring(value, {s}, {n})) AS {f}" for f, s, n in ORD_FIELDS)} FROM legacy_lines"""
ORACLE["rec_normalise_spaces"] = f"""{CUST} SELECT regexp_replace(trim(CUST_ID), ' +', ' ', 'g') AS CUST_ID,
    regexp_replace(trim(CUST_NAME), ' +', ' ', 'g') AS CUST_NAME, regexp_replace(trim(SEGMENT), ' +', ' ', 'g') AS SEGMENT FROM m"""
ORACLE["rec_source_file"] = f"{CUST} SELECT CUST_ID, CAST(1 AS BIGINT) AS path_tags, CAST(1 AS BIGINT) AS file_tags FROM l"
ORACLE["rec_length_match"] = f"""{CUST} SELECT CUST_ID, CAST(record_length AS BIGINT) AS record_length,
    CAST(expected_length AS BIGINT) AS expected_length, length_match FROM b"""
ORACLE["rec_load_timestamp"] = f"{CUST} SELECT CUST_ID, true AS has_timestamp FROM l"
ORACLE["rec_suffix"] = f"{CUST} SELECT CUST_ID, {', '.join(f'{f} AS {f}_legacy' for f in VALUES)} FROM l"
ORACLE["rec_blank_null"] = f"""{CUST_JOIN} SELECT CUST_ID,
    {', '.join(f"coalesce({f}_{s}, '') AS {f}_{s}" for f in VALUES for s in ('legacy', 'modern'))} FROM j"""

# ---------------------------------------------------------------- structure

ORACLE["qc_length_counts"] = f"""{CUST} SELECT count(*) AS record_count,
    count(*) FILTER (WHERE record_length <> 62) AS length_mismatches FROM b"""
ORACLE["qc_length_rows"] = f"""{CUST} SELECT CUST_ID, CUST_NAME, BALANCE, CAST(record_length AS BIGINT) AS record_length
FROM b WHERE record_length <> 62"""
ORACLE["qc_length_stats"] = f"""{CUST} SELECT CAST(min(record_length) AS BIGINT) AS min_length,
    CAST(max(record_length) AS BIGINT) AS max_length, round(avg(record_length), 2) AS avg_length FROM b"""
ORACLE["qc_empty_records"] = f"{CUST} SELECT count(*) AS empty_records FROM b WHERE record_length = 0"
ORACLE["qc_null_keys"] = f"""{CUST} SELECT 'CUST_ID' AS field_name, count(*) FILTER (WHERE CUST_ID = '') AS blank_keys FROM b
UNION ALL SELECT 'SEGMENT', count(*) FILTER (WHERE SEGMENT = '') FROM b"""
COUNTED = """SELECT '{side}' AS side, count(*) AS record_count, CAST(min(record_length) AS BIGINT) AS min_length,
    CAST(max(record_length) AS BIGINT) AS max_length, round(avg(record_length), 2) AS avg_length,
    count(*) FILTER (WHERE record_length <> 62) AS length_mismatches, count(*) FILTER (WHERE record_length = 0) AS empty_records,
    count(*) FILTER (WHERE CUST_ID = '') AS blank__CUST_ID FROM {table}"""
ISSUES = [
    ("length_mismatches", "format('{:,}', length_mismatches) || ' records have incorrect length'"),
    ("empty_records", "format('{:,}', empty_records) || ' completely empty records found'"),
    ("blank__CUST_ID", "'Primary key field CUST_ID has ' || format('{:,}', blank__CUST_ID) || ' null/empty values'"),
]
ORACLE["qc_structure"] = f"""{CUST}, c AS ({COUNTED.format(side='legacy', table='l')} UNION ALL {COUNTED.format(side='modern', table='b')})
SELECT *, 'CUST_RECORD' AS copybook_name, CAST(62 AS BIGINT) AS expected_length,
    concat_ws('; ', {', '.join(f"CASE WHEN {n} > 0 THEN {t} END" for n, t in ISSUES)}) AS issues FROM c"""
ORACLE["qc_issues"] = f"""{CUST}, c AS ({COUNTED.format(side='modern', table='b')}),
i AS ({' UNION ALL '.join(f"SELECT {o} AS o, {t} AS issue FROM c WHERE {n} > 0" for o, (n, t) in enumerate(ISSUES))})
SELECT row_number() OVER (ORDER BY o) - 1 AS n, issue FROM i"""

# ---------------------------------------------------------------- comparison

ORACLE["join_full_using"] = f"{CUST_JOIN} SELECT CUST_ID, {', '.join(f'{f}_legacy, {f}_modern' for f in VALUES)} FROM j"
ORACLE["join_full_cond"] = f"""{CUST} SELECT {', '.join(f'l.{f} AS l_{f}, m.{f} AS m_{f}' for f, _, _ in CUST_FIELDS)}
FROM l FULL OUTER JOIN m ON l.CUST_ID = m.CUST_ID"""
ORACLE["cmp_legacy_only"] = f"{CUST} SELECT CUST_ID, 'legacy_only' AS record_status FROM l WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.CUST_ID = l.CUST_ID)"
ORACLE["cmp_modern_only"] = f"{CUST} SELECT CUST_ID, 'modern_only' AS record_status FROM m WHERE NOT EXISTS (SELECT 1 FROM l WHERE m.CUST_ID = l.CUST_ID)"
ORACLE["cmp_common"] = f"{CUST} SELECT l.CUST_ID AS CUST_ID, 'common' AS record_status FROM l JOIN m ON l.CUST_ID = m.CUST_ID"
ORACLE["cmp_text"] = f"{CUST_JOIN} SELECT CUST_ID, {', '.join(f'd_{f} AS {f}_differs' for f in TEXT_VALUES)} FROM t"
ORACLE["cmp_tolerance"] = f"""{ORD}, j AS (SELECT coalesce(l.ORDER_ID, m.ORDER_ID) AS ORDER_ID, l.AMOUNT AS AMOUNT_legacy, m.AMOUNT AS AMOUNT_modern
    FROM l FULL OUTER JOIN m ON l.ORDER_ID = m.ORDER_ID),
n AS (SELECT *, TRY_CAST(AMOUNT_legacy AS DOUBLE) / 100.0 AS x, TRY_CAST(AMOUNT_modern AS DOUBLE) / 100.0 AS y FROM j)
SELECT ORDER_ID, AMOUNT_legacy, AMOUNT_modern, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN abs(x - y) > 0.015
    WHEN AMOUNT_legacy IS NULL OR AMOUNT_modern IS NULL THEN false ELSE AMOUNT_legacy <> AMOUNT_modern END AS differs FROM n"""
ORACLE["cmp_text_strict"] = f"""{CUST} SELECT coalesce(l.CUST_ID, m.CUST_ID) AS CUST_ID,
    {', '.join(f"CASE WHEN l.{f} <> m.{f} THEN '{f}' END AS {f}_tag" for f, _, _ in CUST_FIELDS)}
FROM l FULL OUTER JOIN m ON l.CUST_ID = m.CUST_ID"""
ORACLE["cmp_detail_text"] = f"{CUST_JOIN} SELECT CUST_ID, {', '.join(comparison(f) for f in VALUES)} FROM t"
ORACLE["cmp_field_list"] = f"{CUST_JOIN} SELECT CUST_ID, {tag_text(VALUES)} AS mismatched_fields FROM t"
ORACLE["cmp_mismatch_rows"] = f"""{CUST_JOIN} SELECT CUST_ID, record_status, CAST({tag_count(VALUES)} AS BIGINT) AS mismatch_count
FROM t WHERE {any_tag(VALUES)}"""
ORACLE["cmp_details"] = f"{CUST_JOIN} {details('CUST_ID', VALUES)}"
ORACLE["cmp_details_long"] = f"{CUST_JOIN} " + " UNION ALL ".join(
    f"SELECT CUST_ID, record_status, '{f}' AS field_name, {f}_legacy AS legacy_value, {f}_modern AS modern_value FROM t WHERE d_{f}"
    for f in VALUES
)
NORMAL = ", ".join(
    f"regexp_replace(trim(rtrim(substring(value, {s}, {n}))), ' +', ' ', 'g') AS {f}" for f, s, n in CUST_FIELDS
)
ALL_CUST = [f for f, _, _ in CUST_FIELDS]
RECON = f"""WITH {CUST_LINES}, l AS (SELECT {NORMAL} FROM legacy_lines), m AS (SELECT {NORMAL} FROM modern_lines),
r AS (SELECT {', '.join(f'l.{f} AS l_{f}, m.{f} AS m_{f}, coalesce(l.{f} <> m.{f}, false) AS d_{f}' for f in ALL_CUST)}
    FROM l FULL OUTER JOIN m ON l.CUST_ID = m.CUST_ID),
out AS (SELECT {', '.join(f'l_{f}, m_{f}' for f in ALL_CUST)},
    CASE WHEN l_CUST_ID IS NOT NULL AND m_CUST_ID IS NOT NULL THEN 'common' WHEN l_CUST_ID IS NOT NULL THEN 'legacy_only' ELSE 'modern_only' END AS record_status,
    {tag_text(ALL_CUST)} AS mismatched_fields, CAST({tag_count(ALL_CUST)} AS BIGINT) AS mismatch_count FROM r)"""
ORACLE["recon_result"] = f"{RECON} SELECT * FROM out"
ORACLE["recon_bad_records"] = f"{RECON} SELECT * FROM out WHERE mismatch_count > 0"
ORACLE["job_recon"] = ORACLE["job_simple_copybook"] = ORACLE["recon_bad_records"]
ORACLE["sink_recon_csv"] = f"""{RECON} SELECT *, 'validation_results' AS output FROM out
UNION ALL SELECT *, 'bad_records' AS output FROM out WHERE mismatch_count > 0"""
ORACLE["cmp_composite_key"] = f"""{LINE}, t AS (SELECT coalesce(l.ORDER_ID, m.ORDER_ID) AS ORDER_ID, coalesce(l.LINE_NO, m.LINE_NO) AS LINE_NO,
    {', '.join(f"l.{f} AS {f}_legacy, m.{f} AS {f}_modern, coalesce(l.{f}, '') <> coalesce(m.{f}, '') AS d_{f}" for f in LINE_VALUES)},
    CASE WHEN l.ORDER_ID IS NULL THEN 'modern_only' WHEN m.ORDER_ID IS NULL THEN 'legacy_only' ELSE 'common' END AS record_status
    FROM l FULL OUTER JOIN m ON l.ORDER_ID = m.ORDER_ID AND l.LINE_NO = m.LINE_NO) {details('ORDER_ID, LINE_NO', LINE_VALUES)}"""
ORACLE["cmp_duplicate_keys"] = f"""{LINE}, j AS (SELECT l.ORDER_ID AS a, m.ORDER_ID AS b FROM l FULL OUTER JOIN m ON l.ORDER_ID = m.ORDER_ID AND l.LINE_NO = m.LINE_NO),
n AS (SELECT count(*) FILTER (WHERE b IS NULL) AS legacy_only_records, count(*) FILTER (WHERE a IS NULL) AS modern_only_records,
    count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS common_records FROM j)
SELECT n.*, (SELECT count(*) FROM l) AS total_legacy_records, (SELECT count(*) FROM m) AS total_modern_records,
    (SELECT count(*) FROM (SELECT 1 FROM l GROUP BY ORDER_ID, LINE_NO HAVING count(*) > 1)) AS duplicate_key_groups_legacy,
    (SELECT count(*) FROM (SELECT 1 FROM m GROUP BY ORDER_ID, LINE_NO HAVING count(*) > 1)) AS duplicate_key_groups_modern FROM n"""

# all pairs of records with the same status and priority, counted the plain way
HOT_DIFFERS = """l.ORDER_DATE <> m.ORDER_DATE OR CASE WHEN l.x IS NOT NULL AND m.x IS NOT NULL THEN abs(l.x - m.x) > 5000
    ELSE l.AMOUNT <> m.AMOUNT END"""
HOT = f"""{ORD}, ln AS (SELECT *, TRY_CAST(AMOUNT AS DOUBLE) AS x FROM l), mn AS (SELECT *, TRY_CAST(AMOUNT AS DOUBLE) AS x FROM m)"""
ORACLE["cmp_hot_pairs"] = f"""{HOT} SELECT count(*) FILTER (WHERE NOT ({HOT_DIFFERS})) AS hot_equal_pairs
FROM ln l JOIN mn m ON l.STATUS = m.STATUS AND l.PRIORITY = m.PRIORITY"""
ORACLE["cmp_hot_fields"] = f"""{HOT}, j AS (SELECT l.ORDER_DATE = m.ORDER_DATE AS same_date,
    CASE WHEN l.x IS NOT NULL AND m.x IS NOT NULL THEN abs(l.x - m.x) <= 5000 ELSE l.AMOUNT = m.AMOUNT END AS same_amount
    FROM ln l JOIN mn m ON l.STATUS = m.STATUS AND l.PRIORITY = m.PRIORITY)
SELECT 'ORDER_DATE' AS field_name, count(*) AS equal_pairs FROM j WHERE same_date
UNION ALL SELECT 'AMOUNT', count(*) FROM j WHERE same_amount"""


def hot_side(side, own, other):
    return f"""SELECT '{side}' AS hot__side, o.STATUS AS STATUS, o.PRIORITY AS PRIORITY, o.AMOUNT AS AMOUNT, o.ORDER_DATE AS ORDER_DATE,
    any_value(v.copies) AS hot__copies, count(*) AS hot__partners,
    count(*) FILTER (WHERE o.ORDER_DATE <> p.ORDER_DATE OR CASE WHEN o.x IS NOT NULL AND p.x IS NOT NULL THEN abs(o.x - p.x) > 5000 ELSE o.AMOUNT <> p.AMOUNT END) AS hot__mismatched_partners
    FROM (SELECT DISTINCT STATUS, PRIORITY, AMOUNT, ORDER_DATE, x FROM {own}) o
    JOIN (SELECT STATUS, PRIORITY, AMOUNT, ORDER_DATE, count(*) AS copies FROM {own} GROUP BY ALL) v USING (STATUS, PRIORITY, AMOUNT, ORDER_DATE)
    JOIN {other} p ON o.STATUS = p.STATUS AND o.PRIORITY = p.PRIORITY GROUP BY o.STATUS, o.PRIORITY, o.AMOUNT, o.ORDER_DATE"""


ORACLE["cmp_hot_details"] = f"""{HOT}, h AS ({hot_side('legacy', 'ln', 'mn')} UNION ALL {hot_side('modern', 'mn', 'ln')})
SELECT *, hot__copies * hot__mismatched_partners AS hot__mismatched_pairs FROM h WHERE hot__mismatched_partners > 0"""

# ---------------------------------------------------------------- metrics, jobs

METRICS = f"""{CUST_JOIN}, c AS (SELECT (SELECT count(*) FROM l) AS total_legacy_records, (SELECT count(*) FROM m) AS total_modern_records,
    count(*) FILTER (WHERE NOT in_m) AS legacy_only_records, count(*) FILTER (WHERE NOT in_l) AS modern_only_records,
    count(*) FILTER (WHERE in_l AND in_m) AS common_records, count(*) FILTER (WHERE {any_tag(VALUES)}) AS mismatched_records,
    count(*) FILTER (WHERE in_l AND in_m AND {any_tag(VALUES)}) AS mismatched_common_records FROM t),
x AS (SELECT *, common_records - mismatched_records AS perfect_matches,
    round(CAST(common_records - mismatched_records AS DOUBLE) / greatest(common_records, 1) * 100, 2) AS match_rate_percent,
    round(CAST(common_records - mismatched_common_records AS DOUBLE) / greatest(common_records, 1) * 100, 2) AS common_match_rate_percent,
    CAST(5 AS BIGINT) AS fields_compared, CAST(0 AS BIGINT) AS array_fields FROM c)"""
LABELS = {
    "Total Legacy Records": "total_legacy_records", "Total Modern Records": "total_modern_records",
    "Records Only in Legacy": "legacy_only_records", "Records Only in Modern": "modern_only_records",
    "Common Records": "common_records", "Mismatched Records": "mismatched_records",
    "Perfect Matches": "perfect_matches", "Match Rate (%)": "match_rate_percent",
    "Fields Compared": "fields_compared", "Array Fields": "array_fields",
}


def summary_rows(source="x"):
    return " UNION ALL ".join(
        f"SELECT '{label}' AS Metric, CAST({c} AS DOUBLE) AS Value FROM {source}" for label, c in LABELS.items()
    )


VERDICT = """CASE WHEN match_rate_percent >= 95 THEN 'Excellent data quality! Files are highly consistent.'
    WHEN match_rate_percent >= 80 THEN 'Good data quality with minor discrepancies. Review mismatch details.'
    ELSE 'Significant data discrepancies detected. Detailed investigation required.' END"""
SEVERITY = """sev AS (
SELECT 'Total Records' AS item, CAST(total_legacy_records AS DOUBLE) AS legacy, CAST(total_modern_records AS DOUBLE) AS modern,
    CAST(total_modern_records - total_legacy_records AS DOUBLE) AS difference,
    CASE WHEN total_modern_records = total_legacy_records THEN 'good' ELSE 'warning' END AS severity FROM x
UNION ALL SELECT 'Common Records', common_records, common_records, NULL, NULL FROM x
UNION ALL SELECT 'Mismatched Records', mismatched_records, mismatched_records,
    round(CAST(mismatched_records AS DOUBLE) / greatest(common_records, 1) * 100, 2),
    CASE WHEN mismatched_records = 0 THEN 'good' WHEN mismatched_records < common_records * 0.05 THEN 'warning' ELSE 'error' END FROM x
UNION ALL SELECT 'Legacy Only', legacy_only_records, NULL, NULL, CASE WHEN legacy_only_records = 0 THEN 'good' ELSE 'warning' END FROM x
UNION ALL SELECT 'Modern Only', NULL, modern_only_records, NULL, CASE WHEN modern_only_records = 0 THEN 'good' ELSE 'warning' END FROM x)"""
ORACLE["met_metrics"] = f"{METRICS} SELECT * FROM x"
ORACLE["met_summary"] = f"{METRICS} {summary_rows()}"
ORACLE["met_verdict"] = f"{METRICS} SELECT match_rate_percent, {VERDICT} AS verdict FROM x"
ORACLE["met_severity"] = f"{METRICS}, {SEVERITY} SELECT * FROM sev"
ORACLE["sink_parquet"] = ORACLE["sink_json"] = ORACLE["job_full"] = ORACLE["cmp_details"]
ORACLE["sink_csv"] = ORACLE["job_metrics"] = ORACLE["met_summary"]
ORACLE["sink_run_layout"] = f"""{METRICS} SELECT 'mismatch_details' AS artifact, true AS stamped, mismatched_records AS rows FROM x
UNION ALL SELECT 'summary', true, 10 FROM x"""
S = "CAST({} AS VARCHAR)"
ORACLE["report_table"] = f"""{METRICS}, {SEVERITY},
ls AS (SELECT min(record_length) AS lo, max(record_length) AS hi, round(avg(record_length), 2) AS av FROM l),
ms AS (SELECT min(record_length) AS lo, max(record_length) AS hi, round(avg(record_length), 2) AS av FROM m),
fixed(section, item, legacy, modern, difference, severity) AS (VALUES
    ('copybook', 'Copybook Name', 'CUST_RECORD', NULL, NULL, NULL), ('copybook', 'Total Fields', '5', NULL, NULL, NULL),
    ('copybook', 'Record Length', '62', NULL, NULL, NULL), ('copybook', 'Array Fields', '0', NULL, NULL, NULL),
    ('structure', 'Expected Length', '62', '62', NULL, NULL), ('field analysis', 'Fields Compared', '5', NULL, NULL, NULL),
    ('field analysis', 'Array Fields Detected', '', NULL, NULL, NULL))
SELECT section, item, legacy, modern, difference, severity FROM fixed
UNION ALL SELECT 'comparison', item, {S.format('CAST(legacy AS BIGINT)')}, {S.format('CAST(modern AS BIGINT)')},
    CASE WHEN item = 'Mismatched Records' THEN {S.format('difference')} ELSE {S.format('CAST(difference AS BIGINT)')} END, severity FROM sev
UNION ALL SELECT 'structure', 'Minimum Length', {S.format('ls.lo')}, {S.format('ms.lo')}, NULL, NULL FROM ls, ms
UNION ALL SELECT 'structure', 'Maximum Length', {S.format('ls.hi')}, {S.format('ms.hi')}, NULL, NULL FROM ls, ms
UNION ALL SELECT 'structure', 'Average Length', {S.format('ls.av')}, {S.format('ms.av')}, NULL, NULL FROM ls, ms
UNION ALL SELECT 'recommendation', {VERDICT}, {S.format('match_rate_percent')}, NULL, NULL, NULL FROM x"""
ORACLE["job_copybook"] = f"""{TAG_LINES}, w AS (SELECT substring(value, 1, 10) AS PART_ID, trim(substring(value, 11, 12)) AS a,
    trim(substring(value, 23, 12)) AS b, trim(substring(value, 35, 12)) AS c FROM lines),
t AS (SELECT PART_ID, a AS TAG_01_legacy, a AS TAG_01_modern, b AS TAG_02_legacy, b AS TAG_02_modern,
    c AS TAG_03_legacy, '????????????' AS TAG_03_modern, 'common' AS record_status, false AS d_TAG_01, false AS d_TAG_02, c <> '????????????' AS d_TAG_03
    FROM w WHERE right(PART_ID, 1) = '3') {details('PART_ID', ['TAG_01', 'TAG_02', 'TAG_03'])}"""
# every pair again, one-sided records of a missing status and key included
ORACLE["job_hot_keys"] = f"""{HOT}, j AS (SELECT l.STATUS AS a, m.STATUS AS b, l.ORDER_DATE AS ld, m.ORDER_DATE AS md,
    CASE WHEN l.x IS NOT NULL AND m.x IS NOT NULL THEN abs(l.x - m.x) > 5000
         WHEN l.STATUS IS NULL OR m.STATUS IS NULL THEN false ELSE l.AMOUNT <> m.AMOUNT END AS d
    FROM ln l FULL OUTER JOIN mn m ON l.STATUS = m.STATUS AND l.PRIORITY = m.PRIORITY),
c AS (SELECT (SELECT count(*) FROM l) AS total_legacy_records, (SELECT count(*) FROM m) AS total_modern_records,
    count(*) FILTER (WHERE b IS NULL) AS legacy_only_records, count(*) FILTER (WHERE a IS NULL) AS modern_only_records,
    count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS common_records,
    count(*) FILTER (WHERE d OR coalesce(ld, '') <> coalesce(md, '')) AS mismatched_records FROM j),
x AS (SELECT *, common_records - mismatched_records AS perfect_matches,
    round(CAST(common_records - mismatched_records AS DOUBLE) / greatest(common_records, 1) * 100, 2) AS match_rate_percent,
    4 AS fields_compared, 0 AS array_fields FROM c) {summary_rows()}"""

# ---------------------------------------------------------------- declared checks

ORACLE["dq_length_class"] = f"""{CUST} SELECT CASE WHEN record_length < 62 THEN 'short' WHEN record_length > 62 THEN 'long' ELSE 'ok' END AS length_class,
    count(*) AS records FROM b GROUP BY 1"""
ORACLE["dq_mandatory"] = f"{CUST} " + " UNION ALL ".join(
    f"SELECT '{f}' AS field_name, count(*) FILTER (WHERE {f} = '') AS blank_values FROM b" for f in ("CUST_ID", "CUST_NAME", "SEGMENT")
)
ORACLE["dq_types"] = f"{ORD} " + " UNION ALL ".join(
    f"SELECT '{f}' AS field_name, count(*) FILTER (WHERE {f} <> '' AND NOT regexp_matches({f}, '^[0-9]+$')) AS invalid_values FROM l"
    for f in ("ORDER_ID", "AMOUNT")
)
ORACLE["dq_completeness"] = f"{CUST} " + " UNION ALL ".join(
    f"""SELECT '{f}' AS field_name, count(*) AS records, count(*) FILTER (WHERE {f} = '') AS blank_values,
    round(count(*) FILTER (WHERE {f} = '') * 100.0 / count(*), 2) AS blank_percent,
    round(count(*) FILTER (WHERE {f} = '') * 100.0 / count(*), 2) > 5 AS above_limit FROM b""" for f in ALL_CUST
)
ORACLE["dq_datetime"] = f"""{ORD} SELECT 'ORDER_DATE' AS field_name, count(*) FILTER (WHERE ORDER_DATE <> '' AND try_strptime(ORDER_DATE, '%Y%m%d') IS NULL) AS invalid_values FROM l
UNION ALL SELECT 'ORDER_TIME', count(*) FILTER (WHERE ORDER_TIME <> '' AND NOT (CAST(substring(ORDER_TIME, 1, 2) AS INT) < 24
    AND CAST(substring(ORDER_TIME, 3, 2) AS INT) < 60 AND CAST(substring(ORDER_TIME, 5, 2) AS INT) < 60)) FROM l"""
ORACLE["dq_field_stats"] = f"{CUST_JOIN} " + " UNION ALL ".join(
    f"""SELECT '{f}' AS field_name, count(*) AS compared, count(*) FILTER (WHERE d_{f}) AS mismatched,
    round(count(*) FILTER (WHERE d_{f}) * 100.0 / count(*), 2) AS mismatch_percent FROM t""" for f in VALUES
)
ORACLE["dq_field_lengths"] = f"{ORD} " + " UNION ALL ".join(
    f"SELECT '{f}' AS field_name, length({f}) AS value_length, count(*) AS records FROM l GROUP BY 2" for f, _, _ in ORD_FIELDS
)
ORACLE["rec_row_number"] = "SELECT count(*) AS distinct_ids, count(*) AS rows, CAST(1 AS BIGINT) AS rows_per_id FROM lineitem"
ORACLE["stream_arrivals"] = f"""{CUST} SELECT 4 AS files, 2 AS batches, count(*) AS records, count(*) FILTER (WHERE record_length <> 62) AS length_mismatches,
    count(*) FILTER (WHERE record_length = 0) AS empty_records, count(*) FILTER (WHERE CUST_ID = '') AS blank_keys FROM b"""
ORACLE["dq_run_metrics"] = f"""WITH m AS ({ORACLE["met_metrics"]})
SELECT 'profile' AS stage, CAST(total_legacy_records + total_modern_records AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS mismatches, true AS ordered FROM m
UNION ALL SELECT 'compare', CAST(legacy_only_records + modern_only_records + common_records AS BIGINT), CAST(mismatched_records AS BIGINT), true FROM m
UNION ALL SELECT 'duplicate keys', CAST(0 AS BIGINT), CAST(0 AS BIGINT), true FROM m"""
ORACLE["stream_compare"] = f"""SELECT * FROM ({ORACLE["cmp_details"]}) WHERE record_status <> 'legacy_only'"""
ORACLE["stream_compare_prepared"] = ORACLE["stream_compare"]
