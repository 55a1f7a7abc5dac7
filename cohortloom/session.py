"""Session settings the plans in this package are written for."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes the shuffles, turns a join into a broadcast only after the
# small side has been measured, and splits a hot join key over several tasks.
# A generated function of over 8,000 bytes is never compiled by the JVM, so it would run the parsing
# of dates many times slower than the single projections that Spark takes instead.
ADAPTIVE = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a session somebody else created."""
    for name, value in ADAPTIVE.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(
    cpus: int | str = "*", partitions: int = 8, memory: str = "12g", shared: str | None = None
) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own. ``shared`` is its shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
        builder = builder.config("spark.sql.warehouse.dir", f"{shared.rstrip('/')}/warehouse")
    for name, value in ADAPTIVE.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets one folder of its own: on a cluster the
    executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_root(spark.sparkContext.applicationId)


@functools.cache
def _own_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"cohortloom-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one."""
    path = f"{shared_root(spark)}/run-{uuid.uuid4().hex}"
    for folders in _SCRATCHES:
        folders.append(path)
    return path


def staged(df: DataFrame) -> DataFrame:
    """Write a result once to the shared folder and go on from there.

    It is computed once, survives the loss of executors, and the planner knows its size.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Spark itself opens it, whatever the store."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    system, found = hadoop_path(spark, path)
    return system.exists(found)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    system, found = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(found)) if system.exists(found) else []


def remove(spark: SparkSession, path: str) -> None:
    system, found = hadoop_path(spark, path)
    system.delete(found, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, found = hadoop_path(spark, path)
    system.mkdirs(found)


_SCRATCHES: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the shared folders taken inside, so nothing that is read later may lie there."""
    folders: list[str] = []
    _SCRATCHES.append(folders)
    try:
        yield
    finally:
        # By identity: a list of a scratch around this one may hold the same folders.
        _SCRATCHES[:] = [other for other in _SCRATCHES if other is not folders]
        for folder in folders:
            remove(spark, folder)
