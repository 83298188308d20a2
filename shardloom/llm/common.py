"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.session import as_written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a blank; other bytes stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: Most ids that are sent to every executor; beyond it the same join shuffles.
ID_BROADCAST = 1_000_000


#: Most bytes of a batch that Spark hands to a Python worker: workers keep what their largest batch took.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let batches of long texts end early; a session that sets a smaller limit keeps it."""
    now = re.match(r"([0-9]+)b?$", str(spark.conf.get(_BATCH_KEY)))  # as a number only where a session has set it so
    if not now or int(now[1]) > most:
        spark.conf.set(_BATCH_KEY, str(most))


def tidy() -> None:
    """Give the memory of a finished task back to the system; an idle worker would hold it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_case(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def in_fold(doc_id: Column, fold: int, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def words_of(text: str) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(WORD_BYTES).split()


def folded_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts of a column as one run of UTF-8 bytes with A-Z lower-cased, and their n + 1 bounds.

    Null texts are empty.
    """
    texts = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    run = data.slice(bounds[0], bounds[-1] - bounds[0]).to_pybytes().lower() if data is not None else b""
    return run, bounds - bounds[0]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def by_batch(make, out: list[str]):
    """A ``mapInArrow`` function from one that turns a batch into columns given by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = make(batch)
                yield pa.RecordBatch.from_arrays([made[name] for name in out], names=out)
                del made
        tidy()

    return run


def kept_rows(rows: DataFrame, verdicts: DataFrame, key: str, limit: int = ID_BROADCAST) -> DataFrame:
    """Rows whose key has a verdict ``keep``, or none at all (null equals null).

    Rows that share a key cannot be told apart and go only if all of their verdicts say so. The keys that go are
    written and counted: up to ``limit`` of them are broadcast and the rows stay where they are, more of them meet
    the rows in a shuffle.
    """
    gone = as_written(verdicts.groupBy(F.col(key).alias("__gone")).agg(F.bool_or("keep").alias("__keep"))
                      .filter("not __keep").select("__gone"), "gone")
    if gone.limit(limit + 1).count() <= limit:
        gone = F.broadcast(gone)
    return rows.join(gone, F.col(key).eqNullSafe(F.col("__gone")), "left_anti")


def with_row_key(rows: DataFrame) -> DataFrame:
    """The rows, written once with a key ``__row`` of their own, so that every later read sees the same keys."""
    bound_batches(rows.sparkSession)
    return as_written(rows.withColumn("__row", F.monotonically_increasing_id()), "rows")


def with_few(rows: DataFrame, few: DataFrame, keys: list[str], limit: int = ID_BROADCAST // 10,
             how: str = "inner") -> DataFrame:
    """Rows joined to a table of one row per key (null equals null), whose other names are new to the rows.

    The small side is counted and broadcast up to ``limit`` rows; a larger one meets the rows in a shuffle.
    """
    side = few.withColumnsRenamed({k: f"__{k}" for k in keys})
    if few.limit(limit + 1).count() <= limit:
        side = F.broadcast(side)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(side, same, how).drop(*[f"__{k}" for k in keys])


def utf8_texts(column: pa.Array) -> Iterator[memoryview]:
    """The UTF-8 bytes of each text of a column, one after the other and without copies; null texts are empty."""
    texts = column.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1].tolist() if len(texts) else [0]
    data = memoryview(texts.buffers()[2] or b"")
    known = texts.is_valid().to_pylist()
    for a, b, there in zip(bounds, bounds[1:], known):
        yield data[a:b] if there else data[:0]


def with_places(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    """Rows with ``place``, counted from 1 in ``order`` for the first ``most`` of them and null for the others.

    The rows are dealt over ranges of the order and written with the number of their range; only the counts of the
    ranges reach the driver. Rows are numbered within the ranges that hold the first ones. The order must tell all
    rows apart for the ranges to be even.
    """
    dealt = as_written(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes, before, first = sorted(tuple(r) for r in dealt.groupBy("__part").count().collect()), 0, []
    for part, n in sizes:
        if before < most:
            first.append((part, before))
        before += n
    spark = rows.sparkSession
    offsets = spark.createDataFrame(first, "__part int, __before long")
    place = F.col("__before") + F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    ahead = dealt.join(F.broadcast(offsets), "__part").select(*rows.columns, place.alias("place"))
    last = first[-1][0] if first else -1
    return ahead.withColumn("place", F.when(F.col("place") <= most, F.col("place"))).unionByName(
        dealt.filter(F.col("__part") > last).select(*rows.columns, F.lit(None).cast("long").alias("place")))
