"""Stages of a job whose finished output is used again as long as what they were made from is unchanged."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.session import file_uri


def file_marks(spark: SparkSession, path: str) -> str:
    """What tells one state of a file or folder from another: names, sizes and times of all files, or that it is missing."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        told = F.xxhash64("path", "length", "modificationTime")
        return ":".join(map(str, files.select("path", "length", "modificationTime").agg(F.count(F.lit(1)), F.bit_xor(told)).first()))
    except Exception as err:  # noqa: BLE001 - a source that cannot be listed is a state of its own
        return f"unreadable: {type(err).__name__}"


def table_mark(df: DataFrame) -> str:
    """The same for a table: its rows, in any order."""
    told = F.xxhash64(*[F.col(c) for c in df.columns])
    return ":".join(map(str, df.select(told.alias("h")).agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)"))).first()))


def fingerprint(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


class Stages:
    """A folder of stages. Each has an output, and a mark of its inputs that is written once the output is whole."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, file_uri(spark, folder)
        self.skipped: list[str] = []

    def _file(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(self.folder, name))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return os.path.join(self.folder, name)

    def mark_of(self, name: str) -> str | None:
        path, store = self._file(f"{name}.done")
        if not store.exists(path):
            return None
        stream = store.open(path)
        try:
            return bytes(stream.readNBytes(256)).decode()
        finally:
            stream.close()

    def run(self, name: str, mark: str, make: Callable[[str], None], anew: bool = False) -> str:
        """The path of the stage's output, made by ``make(path)`` unless it is there under the same mark.

        The mark goes before the output is touched and comes back, by a rename, when it is whole: a run that is ended
        in between makes the stage anew, on an empty place.
        """
        if not anew and self.mark_of(name) == mark:
            self.skipped.append(name)
            return self.path(name)
        final, store = self._file(f"{name}.done")
        store.delete(final, False)
        store.delete(self._file(name)[0], True)
        make(self.path(name))
        partial, _ = self._file(f".{name}.{uuid.uuid4().hex}")
        stream = store.create(partial, True)
        stream.write(bytearray(mark.encode()))
        stream.close()
        store.rename(partial, final)
        return self.path(name)

    def has(self, name: str) -> bool:
        path, store = self._file(name)
        return store.exists(path)

    def forget(self, name: str) -> None:
        """Delete a stage's output and keep its mark."""
        path, store = self._file(name)
        store.delete(path, True)

    def table(self, name: str, mark: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A stage whose output is a table."""
        return self.spark.read.parquet(self.run(name, mark, lambda path: make().write.option("compression", "zstd").parquet(path)))


def chained(mark: str, names: Sequence[str]) -> dict[str, str]:
    """Marks of stages that follow one another from the same inputs."""
    return {name: fingerprint(mark, list(names[:i + 1])) for i, name in enumerate(names)}
