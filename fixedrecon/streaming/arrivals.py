"""Structured Streaming over a folder that receives record files.

Each micro-batch overwrites its own ``batch=<id>`` folder, so a batch that is
run again after a failure leaves exactly one copy of its result, and the
checkpoint keeps a file from being read twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fixedrecon.functions.text import is_blank
from fixedrecon.layout import Layout
from fixedrecon.operators.compare import Rules, join_sides, mismatch_details, tag_mismatches
from fixedrecon.operators.records import parse_records
from fixedrecon.operators.spread import SPREAD_ROWS
from fixedrecon.streaming.prepared import PreparedLegacy


def file_structure(records: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Structure counters per source file."""
    return records.groupBy("source_file").agg(
        F.count("*").alias("records"),
        F.count_if(~F.col("length_match")).alias("length_mismatches"),
        F.count_if(F.col("record_length") == 0).alias("empty_records"),
        *[F.count_if(is_blank(F.col(k))).alias(f"blank__{k}") for k in keys],
    )


def _run(
    spark: SparkSession, folder: str, layout: Layout, checkpoint: str, output: str,
    process: Callable[[DataFrame], DataFrame], max_files: int | None,
) -> StreamingQuery:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(folder).select("value", F.col("_metadata.file_path").alias("file_path"))

    def write(batch: DataFrame, batch_id: int) -> None:
        records = parse_records(batch, layout, F.col("file_path"))
        process(records).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def check_arrivals(
    spark: SparkSession, folder: str, layout: Layout, keys: Iterable[str],
    checkpoint: str, output: str, max_files: int | None = None,
) -> StreamingQuery:
    """Structure check of every new file; one result row per file."""
    keys = list(keys)
    return _run(
        spark, folder, layout, checkpoint, output, lambda r: file_structure(r, keys), max_files
    )


def compare_arrivals(
    spark: SparkSession, folder: str, layout: Layout, legacy: DataFrame | PreparedLegacy, rules: Rules,
    checkpoint: str, output: str, max_files: int | None = None,
) -> StreamingQuery:
    """Compare every new record with a static legacy side; records without a
    legacy partner are included, legacy records not yet delivered are not.

    With a ``PreparedLegacy`` a batch reads the folders that its keys fall into, and crowded keys among them are spread
    over tasks. With a DataFrame each batch reads the whole legacy side: without ``max_files`` all files that
    have arrived form one batch, a table bucketed by the keys is not shuffled, and the adaptive planner splits a
    key that is frequent in the batch; rows per key are not counted for each batch."""
    prepared = isinstance(legacy, PreparedLegacy)
    if prepared and legacy.keys != rules.keys:
        raise ValueError(f"the legacy side was prepared for the keys {', '.join(legacy.keys)}")

    def process(records: DataFrame) -> DataFrame:
        known = legacy.met_by(records) if prepared else legacy
        joined = join_sides(known, records, rules, "right_outer", spread_rows=SPREAD_ROWS if prepared else None)
        return mismatch_details(tag_mismatches(joined, rules), rules)

    return _run(spark, folder, layout, checkpoint, output, process, max_files)
