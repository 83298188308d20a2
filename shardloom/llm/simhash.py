"""Near duplicates by SimHash, joined by meeting in the middle.

Two fingerprints that differ in at most four bits both reach some 64-bit value by flipping at most two bits
each. Every distinct fingerprint therefore stands for its 2,081 variants within two bits, and fingerprints that
share a variant are linked. The variants are not shuffled as rows: the parities of a few groups of bit
positions name a bucket, a fingerprint goes once to each bucket that any of its variants falls into, and the
bucket's task spells out the variants that belong there. A shared variant links its fingerprints as a star, so
a large group of near copies gives links in proportion to its size and not all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import by_batch, column_of, folded_bytes
from shardloom.llm.components import components
from shardloom.session import as_written

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
#: Distinct fingerprints per bucket that the number of buckets aims at, and variants a task sorts at once.
PER_BUCKET = 1_000
LEAST_BITS, MOST_BITS = 8, 24
AT_ONCE = 1 << 22
STEP = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a case-folded text: a bit is set when it is set in over half of the shingle hashes.

    Shingles count as often as they occur. A text of fewer words is one shingle, one without words is zero.
    """
    words = text.split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        run = b"".join([digest(line[a:b], seed) for a, b in zip(starts[at:at + STEP], ends[at:at + STEP])])
        ones += np.unpackbits(np.frombuffer(run, np.uint8).reshape(-1, 64 // 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                 seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)`` per row; the 64 bits are held as a signed integer."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        run, bounds = folded_bytes(column_of(batch, "text"))
        bounds = bounds.tolist()
        fps = np.array([fingerprint(run[a:b], shingle, seed) for a, b in zip(bounds, bounds[1:])], np.uint64)
        return {"doc_id": column_of(batch, "doc_id"), "fp": pa.array(fps.view(np.int64))}

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        by_batch(make, ["doc_id", "fp"]), f"doc_id {dict(docs.dtypes)[id_col]}, fp bigint")


def position_groups(bits: int) -> np.ndarray:
    """Masks that deal the 64 positions round ``bits`` groups; the parity of each is one bit of the bucket."""
    return np.array([sum(1 << p for p in range(g, 64, bits)) for g in range(bits)], np.uint64)


@lru_cache(maxsize=4)
def flips(bits: int, radius: int, width: int = 64) -> dict[int, np.ndarray]:
    """All masks of up to ``radius // 2`` of the lowest ``width`` bits, by how they change the bucket."""
    by: dict[int, list[int]] = {}
    for k in range(radius // 2 + 1):
        for places in combinations(range(width), k):
            change = 0
            for p in places:
                change ^= 1 << (p % bits)
            by.setdefault(change, []).append(sum(1 << p for p in places))
    return {change: np.array(masks, np.uint64) for change, masks in by.items()}


def bucket_of(fps: np.ndarray, bits: int) -> np.ndarray:
    parities = np.bitwise_count(fps[:, None] & position_groups(bits)[None, :]).astype(np.int64) & 1
    return (parities << np.arange(bits)).sum(axis=1)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of ``n`` indexes by the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def meeting_in_bucket(fps: np.ndarray, bucket: int, bits: int, radius: int = RADIUS,
                      width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indexes of the sorted ``fps`` within the radius: a star for every variant of one bucket.

    Variants are sorted in slices of about ``AT_ONCE``, cut by a mixed hash of the variant.
    """
    change = bucket_of(fps, bits) ^ bucket
    table = flips(bits, radius, width)
    kinds = [(np.flatnonzero(change == c), table[c]) for c in np.unique(change).tolist() if c in table]
    total = sum(len(rows) * len(masks) for rows, masks in kinds)
    slices = max(1, -(-total // AT_ONCE))
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in range(slices):
        variants, owners = [], []
        for rows, masks in kinds:
            for at in range(0, len(rows), max(1, AT_ONCE // len(masks))):
                part = rows[at:at + max(1, AT_ONCE // len(masks))]
                v = (fps[part][:, None] ^ masks[None, :]).ravel()
                o = np.repeat(part, len(masks))
                if slices > 1:
                    here = (v * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(slices) == s
                    v, o = v[here], o[here]
                variants.append(v)
                owners.append(o)
        v, o = np.concatenate(variants), np.concatenate(owners)
        order = np.argsort(v)
        v, o = v[order], o[order]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(v)]]))
        several = sizes > 1
        head = np.repeat(o[first[several]], sizes[several])
        members = o[np.repeat(several, sizes)]
        near = (np.bitwise_count(fps[head] ^ fps[members]) <= radius) & (head != members)
        pair = np.unique(head[near] * len(fps) + members[near])
        a.append(pair // max(1, len(fps)))
        b.append(pair % max(1, len(fps)))
    return np.concatenate(a), np.concatenate(b)


def linked_in_bucket(fps: np.ndarray, bucket: int, bits: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links found at the variants of one bucket, as ``(fingerprint, smallest it is connected to there)``."""
    fps = np.unique(fps)
    root = _roots(len(fps), *meeting_in_bucket(fps, bucket, bits, radius))
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[moved], fps[root[moved]]


def bucket_bits(n: int, per_bucket: int = PER_BUCKET) -> int:
    """Bits of the bucket for so many distinct fingerprints."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, n) / per_bucket))))


def ball_links(fps: DataFrame, radius: int = RADIUS, bits: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the fingerprints within ``radius`` bits of each other.

    ``fps`` has distinct values of ``fp``.
    """
    bits = bits or bucket_bits(fps.count())

    def work(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        values = rows.column("fp").to_numpy().view(np.uint64)
        a, b = linked_in_bucket(values, key[0].as_py(), bits, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return _sent(fps, bits, radius).groupBy("bucket").applyInArrow(work, "a bigint, b bigint")


def ball_pairs(fps: DataFrame, radius: int, width: int, per_bucket: int) -> DataFrame:
    """Pairs ``(a, b)`` of rows of ``(fp, row, root)`` whose values differ in at most ``radius`` of the lowest ``width`` bits.

    Values of ``fp`` are distinct and go by the name ``row`` gives them, so that no pair has to look it up. Unlike the
    links of ``ball_links`` every pair lies within the radius; of those that meet at one variant one is paired with all
    others, so a value makes at most one pair for each of its variants, however many are close to it. Values of one
    ``root`` (null: none) are known to belong together and make no pair.
    """
    bits = bucket_bits(fps.count(), per_bucket)

    def work(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        values, at = np.unique(rows.column("fp").to_numpy().view(np.uint64), return_index=True)
        root, row = rows.column("root").fill_null(-1).to_numpy()[at], rows.column("row").to_numpy()[at]
        a, b = meeting_in_bucket(values, key[0].as_py(), bits, radius, width)
        new = (root[a] != root[b]) | (root[a] < 0)
        return pa.table({"a": row[a[new]], "b": row[b[new]]})

    return _sent(fps, bits, radius, width, ["row", "root"]).groupBy("bucket").applyInArrow(work, "a bigint, b bigint")


def _sent(fps: DataFrame, bits: int, radius: int, width: int = 64, more: Sequence[str] = ()) -> DataFrame:
    """``(fp, bucket)`` and further columns: every fingerprint once for each bucket that one of its variants falls into."""
    changes = F.array(*[F.lit(c) for c in sorted(flips(bits, radius, width))])
    groups = position_groups(bits).view(np.int64).tolist()
    own = sum((F.shiftleft(F.bit_count(F.col("fp").bitwiseAND(F.lit(g))) % 2, i) for i, g in enumerate(groups)), F.lit(0))
    return fps.select("fp", *more, own.cast("int").alias("own")).select(
        "fp", *more, F.explode(changes).alias("change"), "own").select(
        "fp", *more, F.col("own").bitwiseXOR(F.col("change")).alias("bucket"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                    seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id that can be reached by links of at most ``radius`` differing bits,
    the row itself included; rows of one fingerprint are linked. Null, empty and blank texts have fingerprint
    zero and are linked like any others. A null id is never the smallest unless no other is reached; repeated
    rows stay; other columns of ``docs`` are not read; an empty table gives an empty result. Exact for an even
    ``radius``.
    """
    if radius % 2:
        raise ValueError("the radius is split in two halves and must be even")
    rows = as_written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    distinct = as_written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    linked = components(ball_links(distinct.select("fp"), radius))
    roots = as_written(distinct.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), "roots")
    smallest = as_written(roots.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    # Written, so that the last join exchanges both sides and a hot fingerprint can be split.
    by_fp = as_written(roots.join(smallest, "root").select("fp", "component_id"), "components")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id")
