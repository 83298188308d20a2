"""A manifest as a log of commits: every version can be read at any time, and writers do not overwrite one another.

A commit writes its entries to a folder of its own and then claims the next number by creating a file that must not
exist yet. Of two writers at one number one succeeds; the other goes on to the next number, or, if it has asked to
follow a certain version, is told of the conflict.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.session import file_uri
from shardloom.sources.shard_files import ENTRY_COLUMNS, ENTRY_SCHEMA, HEAD_SCHEMA, _measured, manifest


class ConflictError(RuntimeError):
    """Another writer has committed the version that this one wanted to make."""


class ManifestLog:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, file_uri(spark, path)

    def _file(self, name: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions, from 0 on."""
        folder, store = self._file("log")
        if not store.exists(folder):
            return []
        return sorted(int(s.getPath().getName()[:-5]) for s in store.listStatus(folder) if s.getPath().getName().endswith(".json"))

    def _claim(self, version: int, body: str) -> bool:
        """Make the commit file of a version; false if there is one."""
        final, store = self._file(f"log/{version:010d}.json")
        try:
            stream = store.create(final, False)
        except Py4JJavaError as err:
            if "FileAlreadyExistsException" in str(err.java_exception.getClass().getName()) or store.exists(final):
                return False
            raise
        stream.write(bytearray(body.encode()))
        stream.close()
        return True

    def commit(self, entries: DataFrame, tokenizer: str, vocab_size: int, shard_size: int | None = None, val_fraction: float | None = None,
               after: int | None = None) -> int:
        """Add entries; the number of the version this made.

        With ``after`` the version must directly follow that one (-1: be the first), else ``ConflictError`` is raised and
        nothing is added.
        """
        if after is not None and self.versions() != list(range(after + 1)):
            raise ConflictError(f"{self.path}: version {after} is not the last one")
        folder = f"part-{uuid.uuid4().hex}"
        entries.select(*ENTRY_COLUMNS).orderBy("split", "shard_idx").write.parquet(f"{self.path}/{folder}")
        added = self.spark.read.schema(ENTRY_SCHEMA).parquet(f"{self.path}/{folder}")
        head = manifest(added, tokenizer, vocab_size, shard_size, val_fraction).first().asDict()
        body = json.dumps({"folder": folder, "head": head})
        version = len(self.versions()) if after is None else after + 1
        while not self._claim(version, body):
            if after is not None:
                part, store = self._file(folder)
                store.delete(part, True)
                raise ConflictError(f"{self.path}: version {version} was committed by another writer")
            version += 1
        return version

    def read(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """``(head, entries)`` as of a version, the last one if none is given. Later commits do not change it."""
        known = [v for v in self.versions() if version is None or v <= version]
        if not known or (version is not None and known[-1] != version):
            raise ValueError(f"{self.path}: no version {version if version is not None else 0}")
        commits = self.spark.read.schema(f"folder string, head struct<{HEAD_SCHEMA.replace(' ', ': ').replace(',:', ',')}>").json(
            [f"{self.path}/log/{v:010d}.json" for v in known])
        folders = [r["folder"] for r in commits.select("folder").collect()]  # one per commit
        entries = self.spark.read.schema(ENTRY_SCHEMA).parquet(*[f"{self.path}/{f}" for f in folders])
        return _measured(commits.select("head.*")), entries.select(*ENTRY_COLUMNS)

    def added(self) -> DataFrame:
        """Every entry with the version that added it."""
        log = self.spark.read.schema("folder string").json(f"{self.path}/log").select(
            "folder", F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("int").alias("version"))
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(part-[0-9a-f]+)/[^/]*$", 1)
        rows = self.spark.read.schema(ENTRY_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(self.path)
        return rows.select(*ENTRY_COLUMNS, folder.alias("folder")).join(F.broadcast(log), "folder").drop("folder")
