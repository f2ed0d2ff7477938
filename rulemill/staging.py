"""Written intermediate tables, so that several readers share one computation.

A staged table is Parquet in a folder that all executors share: the one named by
``spark.checkpoint.dir``, or a folder in the session's warehouse where that is
unset. It survives lost executors, and columns nobody reads are pruned. The
plan is the same everywhere; a cluster whose warehouse is a plain local path
and that names no checkpoint folder is an error.

What was shuffled for a staged table is deleted once it is written: nothing reads
it again, and Spark alone would keep it until the driver collects garbage.

``drop_staged`` deletes what a session has staged since a mark, for callers that
know when their results have been consumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
#: While a table is written: shuffle files go at the end of the query, and rows of
#: up to so many folders are not sorted by folder first.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING = {_CLEANUP: "true", "spark.sql.maxConcurrentOutputFileWriters": "8"}
_staged: dict[str, list[str]] = {}


def _filesystem(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    shared = spark.conf.get(_CONF, None)
    if shared:
        return shared
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = warehouse.startswith(("file:", "/"))
    if local and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"{_CONF} must name a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_staged"


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    old = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return the table."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _writing(spark):
        writer.parquet(path)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_mark(spark: SparkSession) -> int:
    """A point in time for ``drop_staged``."""
    return len(_staged.get(spark.sparkContext.applicationId, []))


def drop_staged(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables staged after the mark but for the last ``keep``; returns how many."""
    paths = _staged.get(spark.sparkContext.applicationId, [])
    gone = paths[since:max(since, len(paths) - keep)]
    for path in gone:
        place, files = _filesystem(spark, path)
        files.delete(place, True)
    del paths[since:since + len(gone)]
    return len(gone)
