"""Exact duplicates by content-defined chunk recipes.

Every text is cut where its own bytes say so, chunks become identifiers that are verified against their
SHA-256, and two texts are equal when their ordered lists of identifiers are. A text is read once; what moves
is a few bytes for every two kilobytes of it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import by_batch, column_of, folded_bytes
from shardloom.session import as_written

#: A cut follows eight bytes whose mixed value has this many leading zero bits: one in 2,048 positions.
CUT_BITS = 11
LEAST, MOST = 512, 16_384
MIX = np.uint64(0x9E3779B97F4A7C15)
SLICE = 1 << 21


def cut_candidates(run: bytes, bits: int = CUT_BITS) -> np.ndarray:
    """Ends of all eight-byte windows that ask for a cut."""
    found, n = [np.empty(0, np.int64)], len(run) - 7
    for at in range(0, n, SLICE):
        windows = np.ndarray((min(SLICE, n - at),), "<u8", run, at, (1,))
        found.append(np.flatnonzero(windows * MIX >> np.uint64(64 - bits) == 0) + at + 8)
    return np.concatenate(found)


def chunk_ends(start: int, end: int, candidates, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of one text: candidates at least ``least`` bytes apart, forced cuts after ``most``."""
    ends, last = [], start
    for at in candidates:
        while at - last > most:
            last += most
            ends.append(last)
        if at - last >= least:
            ends.append(int(at))
            last = at
    while end - last > most:
        last += most
        ends.append(last)
    if last < end or not ends:
        ends.append(end)
    return ends


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _recipes(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    run, bounds = folded_bytes(column_of(batch, "text"))
    candidates = cut_candidates(run)
    lows = np.searchsorted(candidates, bounds[:-1] + 8)
    highs = np.searchsorted(candidates, bounds[1:], side="right")
    digests, keys, shas = [], [], []
    for start, end, low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), lows, highs):
        parts, last = [], start
        for at in chunk_ends(start, end, candidates[low:high].tolist()):
            parts.append(run[last:at])
            last = at
        digests.append(hashlib.sha256(run[start:end]).hexdigest())
        keys.append([_signed(xxhash.xxh64_intdigest(p)) for p in parts])
        shas.append([hashlib.sha256(p).digest() for p in parts])
    return {"doc_id": column_of(batch, "doc_id"), "text_sha256": pa.array(digests, pa.string()),
            "keys": pa.array(keys, pa.list_(pa.int64())), "shas": pa.array(shas, pa.list_(pa.binary()))}


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, SHA-256 of the normalised text, and key and SHA-256 of every chunk in order."""
    out = ["doc_id", "text_sha256", "keys", "shas"]
    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        by_batch(_recipes, out), f"doc_id {kind}, text_sha256 string, keys array<bigint>, shas array<binary>")


def chunk_identifiers(occurrences: DataFrame) -> DataFrame:
    """``(key, sha, variant)`` for every distinct chunk: chunks that share a key but differ get other variants."""
    distinct = occurrences.groupBy("key", "sha").agg(F.count(F.lit(1)).alias("uses"))
    return distinct.withColumn("variant", F.row_number().over(Window.partitionBy("key").orderBy("sha")))


def with_recipes(rows: DataFrame) -> DataFrame:
    """``(uid, doc_id, text_sha256, recipe)``: the ordered list of verified chunk identifiers per row."""
    occurrences = rows.select("uid", F.posexplode(F.arrays_zip("keys", "shas")).alias("pos", "c")).select(
        "uid", "pos", F.col("c.keys").alias("key"), F.col("c.shas").alias("sha"))
    lists = (
        occurrences.join(chunk_identifiers(occurrences), ["key", "sha"])
        .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("pos", "key", "variant"))).alias("parts"))
        .select("uid", F.transform("parts", lambda p: F.struct(p["key"].alias("key"), p["variant"].alias("variant")))
                .alias("recipe"))
    )
    return rows.select("uid", "doc_id", "text_sha256").join(lists, "uid")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``.

    Texts are equal when identical after lower-casing A-Z; the largest id of a group stays. A null text equals
    an empty one. Rows that repeat an id are counted one by one and stay or go together; a null id is below all
    others, and a group of null ids only is kept. Other columns of ``docs`` are not read. An empty table gives
    an empty result.
    """
    rows = as_written(
        chunked(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "recipes")
    recipes = as_written(with_recipes(rows), "recipe-lists")
    # Written, so that the join below exchanges both sides and a hot recipe can be split.
    groups = as_written(recipes.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    return recipes.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", F.size("recipe").cast("long").alias("n_chunks"))
