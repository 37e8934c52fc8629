"""Folders for what queries write: shared on a cluster, temporary in a local session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from fixedrecon.sinks import scratch_folder


def folder(spark: SparkSession, purpose: str) -> str:
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="fixedrecon-"))
    return scratch_folder(spark, purpose)
