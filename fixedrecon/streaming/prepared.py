"""A legacy side laid out once, so that a batch of arriving records reads only what its keys can meet.

Records are written in folders by a hash of their key. The keys of a batch name at most ``parts`` folders, and only
those are read: a batch of a hundredth of the keys reads about its own folders, not the legacy side."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from fixedrecon.sinks import remove_folder

# Column names with two underscores are internal: no field name has them.
PART = "legacy__part"
PARTS = 1024
HELD = "keys array<string>, parts int, record_schema string"


def part_of(keys: Iterable[str], parts: int) -> Column:
    """The folder of a key. Equal texts of different types are the same key."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class PreparedLegacy:
    path: str
    keys: tuple[str, ...]
    parts: int
    schema: StructType

    def met_by(self, records: DataFrame) -> DataFrame:
        """The legacy records in the folders that keys of ``records`` fall into. The driver reads the numbers
        of those folders, ``parts`` at most."""
        part = part_of(self.keys, self.parts)
        hit = [r[0] for r in records.select(part.alias(PART)).distinct().collect()]
        spark = records.sparkSession
        whole = spark.read.schema(StructType([*self.schema, StructField(PART, IntegerType())])).parquet(f"{self.path}/records")
        return whole.filter(F.col(PART).isin(hit)).drop(PART)


def prepare_legacy(legacy: DataFrame, keys: Iterable[str], path: str, parts: int = PARTS) -> PreparedLegacy:
    """``legacy`` written below ``path``, once for all streams that compare with it on ``keys``.

    Tasks take ranges of (folder, line), so a frequent key is written by several of them, and a folder by few. What says how
    the records lie is written last: a preparation that was cut short is not found by ``prepared_legacy``, and is
    written anew by calling this again. An empty side and NULL keys are allowed; NULL meets nothing."""
    spark, keys = legacy.sparkSession, tuple(keys)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = "legacy__line"
    laid = legacy.withColumn(PART, part_of(keys, parts)).withColumn(line, F.monotonically_increasing_id())
    laid = laid.repartitionByRange(tasks, PART, line).sortWithinPartitions(PART, *keys).drop(line)
    remove_folder(spark, f"{path}/layout")  # until the records are whole
    laid.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/records")
    held = spark.createDataFrame([(list(keys), parts, legacy.schema.json())], HELD)
    held.coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    return prepared_legacy(spark, path)


def prepared_legacy(spark: SparkSession, path: str) -> PreparedLegacy:
    """What ``prepare_legacy`` has written below ``path``; ValueError where nothing whole is there."""
    try:
        held = spark.read.schema(HELD).parquet(f"{path}/layout").first()
    except AnalysisException:
        held = None
    if held is None:
        raise ValueError(f"no prepared legacy side at {path}")
    return PreparedLegacy(path, tuple(held["keys"]), held["parts"], StructType.fromJson(json.loads(held["record_schema"])))
