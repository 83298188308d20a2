"""Importance resampling of documents toward the distribution of a target corpus, by bit-sliced aggregation.

The features of a text are its runs of one to three words, each hashed to a bucket. The gain of a bucket is how much
likelier the target is to use it than the documents are. A document's weight is the sum of the gains of its features:
its counts per bucket are held as planes of one bit per bucket, and so are the sizes of the gains, apart for positive
and negative ones. A plane of counts AND a plane of gains, the bits counted and shifted by the places of both, adds up
to the exact weight. Documents are drawn without repetition by their weight with Gumbel noise from a hash of the id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import WORD_BYTES, column_of, utf8_texts, with_places
from shardloom.session import as_written

BUCKETS = 10_000
SEED = 42
LEAST_WORDS, DRAWN_PERCENT = 20, 5
#: Bytes of text that are cut into words at once.
SLICE = 1 << 16
COUNT_SCHEMA = "bucket int, n long"


def word_slices(text: memoryview) -> Iterator[list[bytes]]:
    """The words of a text, some at a time: letters, digits and characters beyond ASCII, A-Z lower-cased."""
    at, whole = 0, len(text)
    line = bytes(text).translate(WORD_BYTES)
    while at < whole:
        end = line.find(b" ", at + SLICE)
        end = whole if end < 0 else end
        words = line[at:end].split()
        if words:
            yield words
        at = end


def bucket_counts(text: memoryview) -> tuple[np.ndarray, int]:
    """How many runs of one to three words fall into each bucket, and the number of words.

    A CRC goes on where it stopped: the hash of a run is that of the run before it, continued by one more word.
    """
    counts, n, last_one, last_two = np.zeros(BUCKETS, np.int64), 0, [], []
    for words in word_slices(text):
        size, more = len(words), [b" " + w for w in words]
        one = [*map(crc32, words)]
        start = last_one + one[:-1]
        two = [*map(crc32, more[size - len(start):], start)]
        start = last_two + two[:-1]
        three = [*map(crc32, more[size - len(start):], start)]
        counts += np.bincount(np.array(one + two + three, np.uint32) % BUCKETS, minlength=BUCKETS)
        n, last_one, last_two = n + size, one[-1:], two[-1:]
    return counts, n


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket and task, whatever the number of texts."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in utf8_texts(column_of(batch, "text")):
            total += bucket_counts(text)[0]
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])


def corpus_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features per bucket over all texts; one number per bucket reaches the driver."""
    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_summed, COUNT_SCHEMA)
    total = np.zeros(BUCKETS, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[bucket] = n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target to source per bucket, rounded down."""
    of, to = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log(float(t + 1) * of / (float(s + 1) * to)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Planes of one bit per value, the lowest first, each packed to words of 64 bits."""
    places = np.arange(max(1, int(values.max(initial=0)).bit_length()))
    bits = np.packbits((values >> places[:, None] & 1).astype(np.uint8), axis=1, bitorder="little")
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)


def signed_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes of the positive and of the negative values, and what a bit of each is worth."""
    up, down = bit_planes(np.maximum(values, 0)), bit_planes(np.maximum(-values, 0))
    worth = [1 << k for k in range(len(up))] + [-(1 << k) for k in range(len(down))]
    return np.concatenate([up, down]), np.array(worth, np.int64)


def weigh(counts: np.ndarray, planes: np.ndarray, worth: np.ndarray) -> int:
    """The sum of counts times gains, from the planes of both."""
    own = bit_planes(counts)
    met = np.bitwise_count(own[:, None, :] & planes[None, :, :]).sum(axis=2, dtype=np.int64)
    return int((1 << np.arange(len(own), dtype=np.int64)) @ (met @ worth))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from the first 32 bits of a hash of the id; a null id counts as empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every row; a null text has no words and weighs nothing.

    Texts are read once and hashed where they lie; the planes of the gains are some 40 KB.
    """
    planes, worth = signed_planes(gain)
    kind = dict(docs.dtypes)[id_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in utf8_texts(column_of(batch, "text")):
                counts, n = bucket_counts(text)
                rows.append((n, int(counts.sum()), weigh(counts, planes, worth) if n else 0))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    weighed = texts.mapInArrow(work, f"doc_id {kind}, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document, with ``rank`` for those drawn.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn, rounded down: those of
    the highest scores, ties to the smaller id, a null id last. Null, empty and blank texts have no features, weigh 0
    and are never drawn; a repeated row is one more document and has a place of its own. Texts of any length are cut
    into words slice by slice. Without target texts the target is even over all buckets. Of extra columns none is
    read. An empty table gives an empty result.
    """
    gain = gains(corpus_counts(docs, text_col), corpus_counts(target, target_text_col))
    rows = as_written(importance_weights(docs, gain, id_col, text_col).withColumn("__row", F.monotonically_increasing_id()), "weights")
    able = rows.filter(F.col("n_words") >= least_words)
    draw = percent * able.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("__row").asc()]
    out = ["doc_id", "n_features", "weight", "score"]
    placed = with_places(able.select(*out, "__row"), order, draw).select(*out, F.col("place").alias("rank"))
    return placed.unionByName(rows.filter(F.col("n_words") < least_words).select(*out, F.lit(None).cast("long").alias("rank")))
