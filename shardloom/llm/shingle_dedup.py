"""Near duplicates by the similarity of their shingle sets, for the pipeline.

A text has several short fingerprints, each bit of which comes from the smallest of its shingles under another
hash: two texts disagree in a bit in half of the share of shingles they do not have in common. Fingerprints that
meet in the middle, as in ``simhash``, propose pairs of texts; the shingle sets of every proposed pair are
compared, and only those similar enough are linked.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import by_batch, column_of, utf8_texts
from shardloom.llm.components import components
from shardloom.llm.simhash import ball_pairs
from shardloom.session import as_written

SHINGLE_WORDS = 5
#: Texts are near duplicates from this Jaccard similarity of their shingle sets on, ``PART / OF``.
PART, OF = 4, 5
#: Fingerprints per text, their bits, and how many bits may differ: at similarity 0.8 a bit differs by odds of 0.1,
#: one fingerprint meets in 29 % of pairs and one of 16 in 99.5 %.
TABLES, WIDTH, RADIUS = 16, 36, 2
#: Tables that are searched before the others.
FIRST_TABLES = 4
#: Pairs that differ in more than this share of all bits are at less than about 0.6 and are not compared.
FAR_BITS = TABLES * WIDTH // 5
PER_BUCKET = 20_000
STEP = 4_096
#: Bytes of text that are cut into words at once.
SLICE = 1 << 18
_BLANK = re.compile(rb"[ \t-\r]")
_DRAW = np.random.default_rng(42)
MULTIPLY = _DRAW.integers(0, 1 << 32, TABLES * WIDTH, np.uint32) | np.uint32(1)
FLIP = _DRAW.integers(0, 1 << 32, TABLES * WIDTH, np.uint32)


def shingle_hashes(text: bytes, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a case-folded text; one of fewer words is one shingle.

    The text is worked through slice by slice, so that besides the hashes only a slice of it is held as words.
    """
    found, last, at = [], [], 0
    digest = xxhash.xxh64_digest
    while at < len(text):
        end = _BLANK.search(text, at + SLICE)
        end = end.start() if end else len(text)
        words = last + text[at:end].split()
        at = end
        if len(words) < shingle:
            last = words
            continue
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words], dtype=np.int64) - 1
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        hashed = b"".join([digest(line[a:b]) for a, b in zip(starts, ends[shingle - 1:].tolist())])
        found.append(np.unique(np.frombuffer(hashed, ">u8").astype(np.uint64)))
        last = words[1 - shingle:]
    return np.unique(np.concatenate(found)) if found else np.frombuffer(digest(b" ".join(last)), ">u8").astype(np.uint64)


def min_fingerprints(hashes: np.ndarray) -> np.ndarray:
    """One value per table: its number above ``WIDTH`` bits, each a bit of the smallest hash."""
    low, least = hashes.astype(np.uint32), np.full(TABLES * WIDTH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), STEP):
        np.minimum(least, ((low[at:at + STEP, None] * MULTIPLY) ^ FLIP).min(axis=0), out=least)
    bits = (least >> np.uint32(2) & np.uint32(1)).astype(np.int64).reshape(TABLES, WIDTH)
    return (bits << np.arange(WIDTH)).sum(axis=1) + (np.arange(TABLES) << WIDTH)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of hashes have a Jaccard similarity of at least ``PART / OF``."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= PART * (len(a) + len(b) - both)


def _signatures(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    same, fps = [], []
    for text in utf8_texts(column_of(batch, "text")):
        text = bytes(text).lower()
        same.append(hashlib.sha256(b" ".join(text.split())).digest())
        fps.append(min_fingerprints(shingle_hashes(text)))
    return {"row": column_of(batch, "row"), "doc_id": column_of(batch, "doc_id"), "same": pa.array(same, pa.binary()),
            "fps": pa.array(fps, pa.list_(pa.int64()))}


def _compared(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """Pair by pair: two sets of hashes are held at a time."""
    sets = lambda name: (shingle_hashes(bytes(t).lower()) for t in utf8_texts(column_of(batch, name)))
    return {"a": column_of(batch, "a"), "b": column_of(batch, "b"),
            "alike": pa.array([alike(x, y) for x, y in zip(sets("ta"), sets("tb"))], pa.bool_())}


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs of rows whose shingle sets are similar enough."""
    both = pairs.join(texts.select(F.col("row").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("row").alias("b"), F.col("text").alias("tb")), "b")
    found = both.select("a", "b", "ta", "tb").mapInArrow(by_batch(_compared, ["a", "b", "alike"]), "a bigint, b bigint, alike boolean")
    return as_written(found.filter("alike").select("a", "b"), "verified")


def candidate_pairs(classes: DataFrame, first: int, upto: int, tried: DataFrame | None = None) -> DataFrame:
    """Pairs ``a < b`` of rows of ``(row, root, fps)`` with close fingerprints in the tables from ``first`` on, written.

    Rows of one root are known to belong together and make no pair, so that a large group of near copies, once it is
    linked by some tables, does not come up again in every other. Nor do the pairs of ``tried``.
    """
    values = as_written(classes.select("row", "root", F.explode(F.slice("fps", first + 1, upto - first)).alias("fp")), "values")
    same = F.when(F.min("root") == F.max("root"), F.min("root"))
    heads = as_written(values.groupBy("fp").agg(F.min("row").alias("head"), F.min_by("root", "row").alias("head_root"),
                                                same.alias("root"), F.count(F.lit(1)).alias("n")), "heads")
    met = ball_pairs(heads.select("fp", F.col("head").alias("row"), "root"), RADIUS, WIDTH, PER_BUCKET)
    shared = as_written(heads.filter("n > 1 and root is null").select("fp", "head", "head_root"), "shared")
    met = met.union(values.join(shared, "fp").filter("root != head_root").select("head", "row"))
    pairs = met.toDF("x", "y").filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    pairs = as_written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "met")
    fps = lambda name: classes.select(F.col("row").alias(name), F.col("fps").alias(f"f{name}"))
    apart = F.aggregate(F.zip_with("fa", "fb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return as_written(pairs.join(fps("a"), "a").join(fps("b"), "b").filter(apart <= FAR_BITS).select("a", "b"), "candidates")


def linked(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``(node, root)`` of all rows of ``(row, fps)`` that are linked to others.

    The first tables link most of what belongs together; the others are searched for what is still apart, without the
    pairs that were compared before.
    """
    edges, roots, tried = None, None, None
    for first, upto in ((0, FIRST_TABLES), (FIRST_TABLES, TABLES)):
        known = classes.withColumn("root", F.col("row")) if roots is None else classes.join(
            roots, F.col("row") == F.col("node"), "left").select("row", "fps", F.coalesce("root", "row").alias("root"))
        pairs = candidate_pairs(as_written(known.select("row", "root", "fps"), "known"), first, upto, tried)
        # One pair for every row first; those that it has connected need no comparison.
        one = as_written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "one")
        found = _verified(one, texts)
        edges = found if edges is None else edges.union(found)
        roots = as_written(components(edges), "roots")
        root = lambda name, roots=roots: roots.select(F.col("node").alias(name), F.col("root").alias(f"r{name}"))
        open_ = as_written(pairs.join(one, ["a", "b"], "left_anti").join(root("a"), "a", "left").join(root("b"), "b", "left").filter(
            F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"), "open")
        edges = edges.union(_verified(open_, texts))
        roots = as_written(components(edges), "roots")
        tried = pairs
    return roots


def similar_rows(rows: DataFrame, row: str = "__row", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, keep)`` per row of a written table with a unique number: of near duplicates one row stays.

    Texts are near duplicates when the Jaccard similarity of their sets of five-word shingles (case-folded, split
    at blanks) is 0.8 or more, and so are texts linked over others. The smallest id stays, a null id only where
    there is no other, and of rows of one id the first. Texts of equal words, blank ones among them, are one.
    """
    texts = rows.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = as_written(texts.mapInArrow(
        by_batch(_signatures, ["row", "doc_id", "same", "fps"]),
        f"row bigint, doc_id {dict(rows.dtypes)[id_col]}, same binary, fps array<bigint>"), "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    classes = as_written(signed.groupBy("same").agg(F.min(order).alias("o"), F.any_value("fps").alias("fps")).select(
        F.col("o.row").alias("row"), F.col("o.doc_id").alias("doc_id"), "fps"), "classes")
    roots = linked(classes.select("row", "fps"), texts)
    named = as_written(roots.join(classes.select("row", "doc_id"), F.col("node") == F.col("row")).select("root", "doc_id", "row"), "named")
    first = named.groupBy("root").agg(F.min(order).alias("o")).select(F.col("o.row").alias("row"))
    gone = named.select("row").join(first, "row", "left_anti")
    kept = as_written(classes.select("row").join(gone, "row", "left_anti").withColumn("keep", F.lit(True)), "kept")
    return signed.select("row").join(kept, "row", "left").select("row", F.coalesce("keep", F.lit(False)).alias("keep"))
