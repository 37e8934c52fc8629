"""Record files and copybooks rendered from the driver tables.

Only expressions that any SQL engine can repeat: the oracle renders the same
lines on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixedrecon.layout import Layout, LayoutField, layout_from_tuples

CUST = layout_from_tuples(
    "CUST_RECORD",
    [
        ("CUST_ID", 1, 10, "INTEGER"),
        ("CUST_NAME", 11, 35, "STRING"),
        ("NATION", 36, 38, "INTEGER"),
        ("SEGMENT", 39, 50, "STRING"),
        ("BALANCE", 51, 62, "INTEGER"),
    ],
)
CUST_KEYS = ["CUST_ID"]
CUST_TOLERANCE = {"BALANCE": 50}

ORD = Layout(
    "ORDER_RECORD",
    50,
    tuple(
        LayoutField(n, s, e - s + 1, t, d, base_name=n)
        for n, s, e, t, d in [
            ("ORDER_ID", 1, 10, "INTEGER", 0),
            ("STATUS", 11, 11, "STRING", 0),
            ("AMOUNT", 12, 21, "DECIMAL", 2),
            ("ORDER_DATE", 22, 29, "STRING", 0),
            ("PRIORITY", 30, 44, "STRING", 0),
            ("ORDER_TIME", 45, 50, "STRING", 0),
        ]
    ),
)

LINE = layout_from_tuples(
    "LINE_RECORD",
    [
        ("ORDER_ID", 1, 10, "INTEGER"),
        ("LINE_NO", 11, 12, "INTEGER"),
        ("PART_ID", 13, 22, "INTEGER"),
        ("QUANTITY", 23, 26, "INTEGER"),
        ("FLAG", 27, 27, "STRING"),
    ],
)
LINE_KEYS = ["ORDER_ID", "LINE_NO"]

TAGS = Layout(
    "PART_TAGS",
    46,
    (
        LayoutField("PART_ID", 1, 10, "INTEGER", base_name="PART_ID"),
        *[LayoutField(f"TAG_{i + 1:02d}", 11 + 12 * i, 12, base_name="TAG") for i in range(3)],
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def signed_cents(cents: Column) -> Column:
    """Twelve characters: zero-padded, a minus sign in front of negatives."""
    return F.when(
        cents < 0, F.concat(F.lit("-"), F.lpad((-cents).cast("string"), 11, "0"))
    ).otherwise(F.lpad(cents.cast("string"), 12, "0"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
    )


def _customer_line(key: Column, name: Column, segment: Column, cents: Column) -> Column:
    return F.concat(
        F.lpad(key.cast("string"), 10, "0"),
        F.rpad(name, 25, " "),
        F.lpad(F.col("nation").cast("string"), 3, "0"),
        F.rpad(segment, 12, " "),
        signed_cents(cents),
    )


def customer_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("k"), F.col("name")
    spaced = F.when(k % 29 == 0, F.replace(name, F.lit("#"), F.lit(" #"))).otherwise(name)
    return _customers(spark, sf_dir).select(
        _customer_line(k, spaced, F.col("segment"), F.col("cents")).alias("value")
    )


def customer_modern(spark: SparkSession, sf_dir: str, defects: bool = False) -> DataFrame:
    """The altered side. ``defects`` adds broken lines for structure checks."""
    k, name = F.col("k"), F.col("name")
    cased = F.when(k % 11 == 0, F.upper(name)).otherwise(name)
    spaced = F.when(k % 29 == 0, F.replace(cased, F.lit("#"), F.lit("  #"))).otherwise(cased)
    segment = F.when(k % 19 == 0, "").otherwise(F.col("segment"))
    cents = (
        F.col("cents")
        + F.when(k % 13 == 0, 25).otherwise(0)
        + F.when(k % 17 == 0, 100).otherwise(0)
    )
    keys = F.array_compact(
        F.array(F.when(k % 50 != 7, k), F.when(k % 97 == 3, k + 1000000))
    )
    rows = _customers(spark, sf_dir).withColumn("key", F.explode(keys))
    line = _customer_line(F.col("key"), spaced, segment, cents)
    if defects:
        line = F.when(k % 31 == 0, F.concat(F.lit(" " * 10), F.substring(line, 11, 52))).otherwise(line)
        line = F.when(k % 23 == 0, F.substring(line, 1, 58)).otherwise(line)
        line = F.when(k % 101 == 0, "").otherwise(line)
    return rows.select(line.alias("value"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.col("o_orderpriority").alias("priority"),
    )


def _order_line(status: Column, cents: Column) -> Column:
    k, day = F.col("k"), F.col("day")
    broken = (
        F.when(k % 41 == 0, "00000000")
        .when(k % 43 == 0, F.concat(F.substring(day, 1, 4), F.lit("0230")))
        .when(k % 47 == 0, " " * 8)
        .otherwise(day)
    )
    return F.concat(
        F.lpad(k.cast("string"), 10, "0"),
        status,
        F.when(k % 53 == 0, "      N/A ").otherwise(F.lpad(cents.cast("string"), 10, "0")),
        broken,
        F.rpad(F.col("priority"), 15, " "),
        F.lpad((k * 7919 % 250000).cast("string"), 6, "0"),
    )


def order_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select(_order_line(F.col("status"), F.col("cents")).alias("value"))


def order_modern(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    cents = (
        F.col("cents") + F.when(k % 7 == 0, 1).otherwise(0) + F.when(k % 9 == 0, 2).otherwise(0)
    )
    status = F.when(k % 37 == 0, "X").otherwise(F.col("status"))
    return (
        _orders(spark, sf_dir).filter(k % 61 != 5).select(_order_line(status, cents).alias("value"))
    )


def lineitem_lines(spark: SparkSession, sf_dir: str, modern: bool = False) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("bigint")
    if modern:
        rows = rows.filter(F.col("l_suppkey") % 20 != 3)
        quantity = quantity + F.when(F.col("l_partkey") % 17 == 0, 1).otherwise(0)
    return rows.select(
        F.concat(
            F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
            F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
            F.lpad(F.col("l_partkey").cast("string"), 10, "0"),
            F.lpad(quantity.cast("string"), 4, "0"),
            F.col("l_returnflag"),
        ).alias("value")
    )


def part_tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(
            F.lpad(F.col("p_partkey").cast("string"), 10, "0"),
            F.rpad("p_name", 12, " "),
            F.rpad("p_brand", 12, " "),
            F.rpad("p_type", 12, " "),
        ).alias("value")
    )


def part_copybook_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One copybook per part: ``copybook_id, content``. Sizes and repetitions
    follow ``p_size``; the other variations follow the key."""
    k, s = F.col("p_partkey"), F.col("p_size")
    size, digits, times = (
        s.cast("string"), (s % 7 + 1).cast("string"), (s % 4 + 1).cast("string")
    )
    lines = [
        F.concat(F.lit("      * PART RECORD "), F.col("p_brand")),
        F.when(k % 4 == 1, "       01  part-rec.").otherwise("000100 01  PART-REC."),
        F.lit(""),
        F.lit("           05  PART-ID                 PIC 9(10)."),
        F.lit("           05  PART-BODY."),
        F.concat(F.lit("               10  PART-NAME           PIC X("), size, F.lit(").")),
        F.concat(F.lit("               10  PART-PRICE          PIC S9("), digits, F.lit(")V99 COMP-3.")),
        F.lit("                   88  PRICE-FREE      VALUE ZERO."),
        F.concat(F.lit("               10  PART-TAGS           OCCURS "), times, F.lit(" TIMES.")),
        F.lit("                   15  TAG-CODE        PIC X(3)."),
        F.lit("                   15  TAG-QTY         PIC 99 OCCURS 2."),
        F.concat(
            F.lit("           05  PART-ALT                PIC X(5) REDEFINES "),
            F.when(k % 10 == 7, "NO-SUCH-NAME.").otherwise("PART-BODY."),
        ),
        F.lit("           05  PART-SIZE"),
        F.lit("      +        PICTURE IS 9(3)."),
        F.when(k % 10 == 3, "           05  BAD-FIELD           PIC X(ABC).").otherwise(
            "           05  FILLER                  PIC A(4)."
        ),
        F.when(k % 6 == 0, "        5  SHORT-LEVEL             PIC X.").otherwise(
            "C     OLD STYLE REMARK"
        ),
        F.lit("           05  FILLER                  PIC X(7)."),
        F.when(k % 5 == 0, "       01  PART-TRAILER.").otherwise("      * END"),
        F.when(k % 5 == 0, "           05  TRAILER-COUNT       PIC 9(6).").otherwise(""),
    ]
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("PART"), k.cast("string")).alias("copybook_id"),
        F.array_join(F.array(*lines), "\n").alias("content"),
    )


def supplier_copybook_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One copybook per supplier with overlays: redefinitions of redefinitions, inside a repeated group, and two
    records. ``copybook_id, content``."""
    k = F.col("s_suppkey")
    lines = [
        F.lit("       01  SUPP-REC."),
        F.lit("           05  S-ID                PIC 9(6)."),
        F.lit("           05  S-BODY."),
        F.concat(F.lit("               10  S-NAME          PIC X("), (k % 5 + 3).cast("string"), F.lit(").")),
        F.concat(F.lit("               10  S-LINES         OCCURS "), (k % 3 + 1).cast("string"), F.lit(" TIMES.")),
        F.lit("                   15  L-CODE      PIC X(4)."),
        F.lit("                   15  L-NUM       REDEFINES L-CODE PIC 9(4)."),
        F.lit("                   15  L-PARTS     REDEFINES L-NUM."),
        F.lit("                       20  L-P1    PIC X."),
        F.lit("                       20  L-P2    PIC X(3)."),
        F.lit("                   15  L-QTY       PIC 99."),
        F.lit("           05  S-ALT               REDEFINES S-BODY."),
        F.lit("               10  ALT-A           PIC X(2)."),
        F.lit("               10  ALT-B           PIC X(3)."),
        F.lit("               10  ALT-C           REDEFINES ALT-B."),
        F.lit("                   15  ALT-C1      PIC X."),
        F.lit("                   15  ALT-C2      PIC XX."),
        F.lit("           05  S-THIRD             REDEFINES S-ALT PIC X(4)."),
        F.lit("           05  S-END               PIC X(3)."),
        F.lit("       01  SUPP-TRAILER."),
        F.lit("           05  T-COUNT             PIC 9(5)."),
        F.lit("           05  T-TEXT              REDEFINES T-COUNT PIC X(5)."),
    ]
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("SUPP"), k.cast("string")).alias("copybook_id"),
        F.array_join(F.array(*lines), "\n").alias("content"),
    )


def short_copybook_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One copybook in the short form per supplier; some have a length that no position holds, or lengths that end
    beyond the last position. ``copybook_id, content``."""
    k = F.col("s_suppkey")
    lines = [
        F.concat(F.lit("SUPP-ID PIC 9("), (k % 9 + 1).cast("string"), F.lit(")")),
        F.when(k % 7 == 0, "SUPP-NOTE PIC X(99999999999)").otherwise("SUPP-NOTE PIC X(12)"),
        F.when(k % 11 == 0, "SUPP-TEXT PIC X(2147483647)").otherwise("SUPP-TEXT pic x(20)"),
        F.lit("SUPP-END PIC 9(2)"),
    ]
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("SHORT"), k.cast("string")).alias("copybook_id"),
        F.array_join(F.array(*lines), "\n").alias("content"),
    )
