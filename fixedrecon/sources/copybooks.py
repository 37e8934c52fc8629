"""Copybooks: many small files, one row per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def copybook_lines(texts: DataFrame, copybook_id: Column, text: Column, tasks: int | None = None) -> DataFrame:
    """``copybook_id, line_no, raw`` from a table holding one copybook per row.
    The line end of the last line starts no line of its own.

    ``tasks`` deals the copybooks over so many tasks for all that follows. Thousands of copybooks are few bytes but
    much parsing: left to their size, a small table stays with one task."""
    books = texts.select(copybook_id.alias("copybook_id"), text.alias("body"))
    books = books.repartition(tasks, "copybook_id") if tasks else books
    return books.select(
        "copybook_id",
        F.posexplode(F.split(F.regexp_replace("body", r"\r?\n\z", ""), "\r?\n")).alias("pos", "raw"),
    ).select("copybook_id", (F.col("pos") + 1).alias("line_no"), "raw")


# The control lines around a member of a copybook library. Lines of a member that start with a dot are
# written with one more, so that no text looks like a control line.
ADD, END = "./ ADD NAME=", "\n./ ENDUP\n"


def write_copybook_libraries(texts: DataFrame, copybook_id: Column, text: Column, path: str) -> None:
    """Copybooks as members of library files, as many files as ``texts`` has partitions: a file for each copybook costs
    a folder entry, a commit and a task's start, whatever its size. An id is a name without line ends. As in a text
    file of its own, the last line of a copybook is ended."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?md)^\.", "..")
    texts.select(F.concat(F.lit(ADD), copybook_id, F.lit("\n"), body).alias("value")).write.option("lineSep", END).text(path)


def scan_copybooks(
    spark: SparkSession, path: str | list[str], id_pattern: str = "^(.*)$", libraries: bool = False
) -> DataFrame:
    """``copybook_id, line_no, raw`` from copybook files. The id is the first
    group of ``id_pattern`` in the file path, by default the whole path, as files
    in different folders can share a name. A copybook describes one record, so reading each file whole
    keeps its line order at no cost.

    With ``libraries`` each file holds many copybooks, as ``write_copybook_libraries`` writes them; the path of one is
    that of its file with the member in brackets, ``lib.txt(MEMBER)``. Such files are split between members."""
    file_path = F.col("_metadata.file_path")
    if not libraries:
        files = spark.read.text(path, wholetext=True)
        return copybook_lines(files, F.regexp_extract(file_path, id_pattern, 1), F.col("value"))
    members = spark.read.text(path, lineSep=END)
    member = F.regexp_extract("value", r"\A\./ ADD NAME=([^\n]*)\n", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"\A[^\n]*\n", ""), r"(?md)^\.\.", ".")
    named = F.concat(file_path, F.lit("("), member, F.lit(")"))
    return copybook_lines(members, F.regexp_extract(named, id_pattern, 1), F.concat(body, F.lit("\n")))
