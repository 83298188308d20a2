"""Shard files as a Spark data source: byte ranges as partitions, filters on the file name before anything is opened.

A large file makes several partitions; ranges of small files share one, so that tasks follow the bytes and not the files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from shardloom.spec import SHARD_PATTERN

SCHEMA = "source string, split string, shard_idx int, start_tok long, ids array<int>"
READ_CHUNK = 1 << 16
#: Chunks of one range: 16 MB of a file at the usual chunk size.
RANGE_CHUNKS = 128
#: Tokens up to which ranges share a partition.
SHARED_TOKENS = 1 << 22


def store_of(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@dataclass
class ShardRange(InputPartition):
    """Tokens ``start`` to ``end`` of one shard file, and the ranges that are read after it by the same task."""

    path: str
    source: str
    split: str
    shard_idx: int
    start: int
    end: int
    more: list[ShardRange] = field(default_factory=list)


def shared(ranges: list[ShardRange], most: int = SHARED_TOKENS) -> list[ShardRange]:
    """Neighbouring ranges drawn together up to ``most`` tokens, each group as its first range."""
    out, held = [], 0
    for r in ranges:
        held += r.end - r.start
        if out and held <= most:
            out[-1].more.append(r)
        else:
            out.append(r)
            held = r.end - r.start
    return out


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    source, split, shard_idx, start, tokens = zip(*rows)
    ends = np.cumsum([0, *map(len, tokens)])
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(tokens)))
    return pa.RecordBatch.from_arrays(
        [pa.array(source), pa.array(split), pa.array(shard_idx, pa.int32()), pa.array(start, pa.int64()), ids],
        names=["source", "split", "shard_idx", "start_tok", "ids"])


class ShardReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.directory, self.chunk = options["path"], int(options.get("chunk", READ_CHUNK))
        # Columns whose values come from the file name, and the values wanted of them.
        self.wanted: dict[str, set] = {c: set(v.split(",")) for c in ("source", "split") if (v := options.get(c))}

    def partitions(self) -> list[ShardRange]:
        from pyarrow import fs

        store, base = store_of(self.directory)
        found = []
        for info in store.get_file_info(fs.FileSelector(base)):
            named = re.match(SHARD_PATTERN, info.base_name)
            if not named or info.type != fs.FileType.File or info.size % 2 or not info.size:
                continue
            at = {"source": named[1], "split": named[2], "shard_idx": int(named[3])}
            if all(at[c] in values for c, values in self.wanted.items()):
                step, n = self.chunk * RANGE_CHUNKS, info.size // 2
                found += [ShardRange(path=info.path, start=a, end=min(a + step, n), **at) for a in range(0, n, step)]
        return shared(sorted(found, key=lambda r: (r.path, r.start)))

    def read(self, partition: ShardRange | None) -> Iterator[pa.RecordBatch]:
        """One row per chunk; a file is opened at the range and no more than a chunk of it is held.

        Rows of small files travel together until they make up a chunk. Where nothing was planned there is no
        partition to read.
        """
        if partition is None:
            return
        store, _ = store_of(self.directory)
        rows, held = [], 0
        for part in [partition, *partition.more]:
            with store.open_input_file(part.path) as file:
                for at in range(part.start, part.end, self.chunk):
                    n = min(self.chunk, part.end - at)
                    tokens = np.frombuffer(file.read_at(2 * n, 2 * at), "<u2").astype(np.int32)
                    if len(tokens) != n:
                        raise ValueError(f"{part.path}: shorter than it was when it was listed")
                    if rows and held + n > self.chunk:
                        yield batch_of(rows)
                        rows, held = [], 0
                    rows.append((part.source, part.split, part.shard_idx, at, tokens))
                    held += n
        if rows:
            yield batch_of(rows)


class PushingReader(ShardReader):
    """Takes over equalities on what the file name tells; for sessions that push filters to Python sources."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in ("source", "split", "shard_idx"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted[column] & values if column in self.wanted else values
            else:
                yield f


class ShardFiles(DataSource):
    """``spark.read.format("shard_files").load(directory)``: token chunks of all shard files of a folder.

    Options: ``chunk`` (tokens per row), ``source`` and ``split`` (names, joined by commas; others are not opened).
    """

    @classmethod
    def name(cls) -> str:
        return "shard_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ShardReader:
        return (PushingReader if self.options.get("pushdown") == "true" else ShardReader)(self.options)
