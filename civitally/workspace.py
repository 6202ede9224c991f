"""Session defaults and the shared folder for intermediate tables.

Intermediate tables are ordinary Parquet written below the folder named by
``spark.checkpoint.dir``, so they outlive any executor, cut lineage, are read
back column-pruned and give Catalyst a true size for its join choice.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any, Callable

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_local_root: str | None = None
_open: dict[str, SparkSession] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else the session's
    own checkpoint folder. A machine-local folder serves local masters only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get().rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set spark.checkpoint.dir to a shared folder; master is {master}")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="civitally-")
    return _local_root


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@atexit.register
def _remove_open() -> None:
    """Folders whose tables a lazy result may have read until now."""
    for path, spark in _open.items():
        try:
            if spark.sparkContext._jsc is not None:
                _remove(spark, path)
        except Exception:  # the session has ended before us
            return


def local_table(spark: SparkSession, schema: T.StructType, columns: list[list]) -> DataFrame:
    """A small driver-side table as a local relation, so that Catalyst knows its size."""
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return local_table(spark, schema, [[] for _ in schema])


class Workspace:
    """A private folder of staged tables for one job run.

    As a context manager it removes the folder once the job has succeeded; a
    failed run leaves its tables for inspection. Where a result is returned lazily
    its folder must outlive the call and is removed when the process ends.
    """

    def __init__(self, spark: SparkSession, label: str = "job"):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        _open[self.path] = spark

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        target = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, name: str) -> None:
        """Remove a staged table that nothing reads any more."""
        _remove(self.spark, f"{self.path}/{name}")

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, failure, *_) -> None:
        _open.pop(self.path, None)
        if failure is None:
            _remove(self.spark, self.path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a job when it ends, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def concurrently(spark: SparkSession, *jobs: Callable[[], Any]) -> list:
    """Run independent Spark jobs side by side; results in the given order."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inherit(j)) for j in jobs]]


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster passes its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("civitally")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
