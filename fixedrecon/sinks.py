"""Writers. Paths are any Hadoop file system; credentials belong to the cluster."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The folders and the stamp of a run.
DETAILS_FOLDER = "mismatch_details"
SUMMARY_FOLDER = "summary"
RUN_STAMP = "%Y%m%d_%H%M%S"
LIST_SEPARATOR = "|"
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_results(df: DataFrame, path: str, format_type: str = "parquet") -> None:
    """Overwrite ``path`` with parquet (default), CSV with header, or JSON.
    The number of files follows the partitions of ``df``."""
    writer = df.write.mode("overwrite")
    kind = format_type.lower()
    if kind == "csv":
        writer.options(header=True, escape='"', **KEEP_BLANKS).csv(path)
    elif kind == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read what ``write_results`` wrote as CSV. NULL is written as nothing
    and '' as two quotes; a line end, which no field of a record has, stands for
    NULL and so keeps them apart."""
    options = {"header": True, "escape": '"', "nullValue": "\n", "emptyValue": "", **KEEP_BLANKS}
    return spark.read.csv(path, schema=schema, **options)


def flatten_lists(df: DataFrame) -> DataFrame:
    """Array columns as ``a|b|c`` text, for formats without arrays."""
    arrays = {n for n, t in df.dtypes if t.startswith("array<string")}
    return df.select(
        *[F.array_join(c, LIST_SEPARATOR).alias(c) if c in arrays else F.col(c) for c in df.columns]
    )


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime(RUN_STAMP)


def claim_stamp(spark: SparkSession, base: str, now: datetime | None = None) -> str:
    """The stamp of a new run below ``base``: the present second, or the first one after it that no other run has
    claimed by a file below ``_runs``. So two runs into one output never share a folder."""
    moment = now or datetime.now()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while True:
        stamp = run_stamp(moment)
        place = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/_runs/{stamp}")
        if place.getFileSystem(conf).createNewFile(place):
            return stamp
        moment += timedelta(seconds=1)


def run_paths(base: str, stamp: str) -> dict[str, str]:
    """Output folders of one run."""
    base = base.rstrip("/")
    return {
        "mismatch_details": f"{base}/{DETAILS_FOLDER}/{stamp}",
        "summary": f"{base}/{SUMMARY_FOLDER}/{stamp}",
        "duplicate_details": f"{base}/duplicate_key_details/{stamp}",
        "report": f"{base}/report/{stamp}",
        "field_stats": f"{base}/field_stats/{stamp}",
        "run_metrics": f"{base}/run_metrics",
        "work": f"{base}/_work/{stamp}",
    }


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables below ``spark.checkpoint.dir``, the
    place every executor can reach; an error where that is not set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any Hadoop file system, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
