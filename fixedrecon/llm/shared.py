"""Intermediate tables in the folder that the driver and all executors share; what a worker keeps between tasks."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_held: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """What this worker process keeps under ``name`` from one task to the next."""
    if name not in _held:
        _held[name] = make()
    return _held[name]


def return_memory() -> None:
    """Give memory that is free in this process back to the system: the C library and Arrow keep most of it for later use,
    and an executor has all its workers beside its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


def release_held() -> None:
    """Drop all that is held; for tasks of another step, as workers live on and would hold it beside their own work."""
    if _held:
        _held.clear()
        gc.collect()
    return_memory()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for tasks that hold nothing: what other steps hold goes before, what the task has freed goes after."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_held()
        yield from run(batches)
        return_memory()

    return task


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset, a session on one machine
    sets its own; on a cluster it is an error, as executors don't see each other's disks."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="fixedrecon-llm-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it has ended and its result is written."""
    before, changed = spark.conf.get(SHUFFLE_CLEANUP, None), True
    try:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    except PySparkException:  # a version without the setting keeps the files a while
        changed = False
    try:
        yield
    finally:
        if changed and before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        elif changed:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: its lineage ends, and the loss of
    an executor costs no earlier work. The folder lives as long as the checkpoint folder does,
    as what is returned reads it."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(table: DataFrame) -> None:
    """Delete the folder of a ``stored`` table that nothing reads any more."""
    spark = table.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
