"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shardloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shardloom-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SCOPES: list[list[str]] = []


def as_written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of ``as_written`` that nothing reads any more; any other table is left alone."""
    spark = df.sparkSession
    folders = {os.path.dirname(f) for f in df.inputFiles()}
    if len(folders) == 1 and os.path.dirname(folder := folders.pop()) == file_uri(spark, shared_dir(spark)).rstrip("/"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def without_leftovers(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function whose scratch tables are deleted when it returns, but for those that its result still reads."""
    @wraps(make)
    def run(*args, **settings) -> DataFrame:
        _SCOPES.append([])
        try:
            out = make(*args, **settings)
        finally:
            made = _SCOPES.pop()
        spark = out.sparkSession
        read = {os.path.dirname(f) for f in out.inputFiles()}
        for path in made:
            if file_uri(spark, path) not in read:
                gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
        return out

    return run


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


#: Most bytes of a batch that goes to a Python worker inside ``sparing``.
BATCH_BYTES = 4 << 20


@contextmanager
def sparing(spark: SparkSession) -> Iterator[None]:
    """Queries inside leave no shuffle files behind when they end, and send Python workers small batches.

    Otherwise shuffle files go when the driver collects its garbage. A session's own smaller limit of batches is kept.
    """
    cleanup, batch = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {key: spark.conf.get(key, None) for key in (cleanup, batch)}
    limit = re.match(r"([0-9]+)b?$", before[batch] or "")
    spark.conf.set(cleanup, "true")
    if not limit or int(limit[1]) > BATCH_BYTES:
        spark.conf.set(batch, str(BATCH_BYTES))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def file_uri(spark: SparkSession, path: str) -> str:
    """The path with its file system spelled out, as Spark resolves it, so that tasks open the same place."""
    jvm = spark.sparkContext._jvm
    name = jvm.org.apache.hadoop.fs.Path(path)
    full = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(name).toString()
    return re.sub(r"^file:/+", "file:///", full)
