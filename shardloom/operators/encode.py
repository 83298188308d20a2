"""Encoding documents with learned merges, and decoding ids."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from shardloom.functions.alphabet import ID_OF_BYTE, byte_ids, coded, framed, special_to_code
from shardloom.functions.text import byte_token_count, segments
from shardloom.session import as_written, discard, file_uri
from shardloom.spec import BOS_ID, EOS_ID, SPECIAL_TOKENS, UINT16_LIMIT

MERGE_LIMIT = UINT16_LIMIT
#: Buckets of a word dictionary, and words of a block of documents that meets it.
BUCKETS = 32
BLOCK_WORDS = 500_000
#: Words whose ids are laid out at once.
GATHER = 1 << 16
#: Words that are merged at once, and tokens from which on a word is merged by itself.
MERGED_AT_ONCE, LONG_WORD = 1 << 16, 256
NO_RANK = 1 << 30
BYTE_IDS = np.array([ID_OF_BYTE[b] for b in range(256)], np.int64)


def merge_rules(merges: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """The merge table as a lookup; its size is bounded by the id range and checked."""
    rows = merges.limit(MERGE_LIMIT + 1).collect()
    if len(rows) > MERGE_LIMIT:
        raise ValueError(f"more than {MERGE_LIMIT} merges")
    return {(r["left_id"], r["right_id"]): (r["rank"], r["new_id"]) for r in rows}


def apply_merges(ids: list[int], rules: dict) -> list[int]:
    """Merge the lowest-ranked adjacent pair, leftmost first, until none is left."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ids = list(ids)

    def rule(i: int):
        j = after[i]
        return rules.get((ids[i], ids[j])) if j < n else None

    queue = [(r[0], i, r[1]) for i in range(n - 1) if (r := rules.get((ids[i], ids[i + 1])))]
    heapq.heapify(queue)
    while queue:
        rank, i, new = heapq.heappop(queue)
        now = rule(i) if ids[i] >= 0 else None
        if now is None or now != (rank, new):
            continue
        gone = after[i]
        ids[i], ids[gone], after[i] = new, -1, after[gone]
        if after[gone] < n:
            before[after[gone]] = i
        for k in (before[i], i):
            if k >= 0 and (r := rule(k)):
                heapq.heappush(queue, (r[0], k, r[1]))
    return [t for t in ids if t >= 0]


class MergeTable:
    """The merge rules as arrays, for many words at once."""

    def __init__(self, rules: dict) -> None:
        self.rules = rules
        keys = np.array([left << 32 | right for left, right in rules], np.int64)
        by, values = np.argsort(keys), np.array(list(rules.values()), np.int64).reshape(-1, 2)
        self.keys, self.ranks, self.news = keys[by], values[by, 0], values[by, 1]

    def found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and new id of each pair; a pair without a rule has ``NO_RANK``."""
        if not len(self.keys):
            return np.full(len(left), NO_RANK), left
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK), self.news[at]

    def merged(self, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(pool, starts, sizes)``: the ids of every word, as by ``apply_merges``, from the tokens of all words.

        Some words at a time, so that beside the ids only those few are held.
        """
        starts, sizes, pool, filled = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), [np.empty(0, np.int32)], 0
        ends = np.cumsum(lengths)
        for low in range(0, len(lengths), MERGED_AT_ONCE):
            own = lengths[low:low + MERGED_AT_ONCE]
            first = int(ends[low] - own[0])
            for words, kept, ids in self._rounds(tokens[first:first + int(own.sum())], own):
                starts[low + words], sizes[low + words] = filled + np.cumsum(kept) - kept, kept
                pool.append(ids.astype(np.int32))
                filled += len(ids)
        return np.concatenate(pool), starts, sizes

    def _rounds(self, tok: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words as they are done: which, their numbers of ids, and these ids.

        A round merges in every word the leftmost of its pairs of the lowest rank. Long words, which would take many
        rounds, go one by one.
        """
        bounds = np.cumsum(lengths) - lengths
        for word in np.flatnonzero(lengths >= LONG_WORD).tolist():
            ids = apply_merges(tok[bounds[word]:bounds[word] + lengths[word]].tolist(), self.rules)
            yield np.array([word]), np.array([len(ids)]), np.array(ids)
        words = np.flatnonzero((lengths > 0) & (lengths < LONG_WORD))
        tok = tok[np.repeat((lengths > 0) & (lengths < LONG_WORD), lengths)]
        sizes, rank = lengths[words], np.full(len(tok), NO_RANK)
        if not len(words):
            return
        last = np.cumsum(sizes) - 1
        inner = np.ones(len(tok), np.bool_)
        inner[last] = False
        at = np.flatnonzero(inner)
        rank[at] = self.found(tok[at], tok[at + 1])[0]
        while True:
            first = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), first)
            open_ = least >> 32 < NO_RANK
            held = np.repeat(open_, sizes)
            yield words[~open_], sizes[~open_], tok[~held]
            if not open_.any():
                return
            # Places in what is left of the words that go on.
            at = (least[open_] & 0xFFFFFFFF) - (np.cumsum(np.where(open_, 0, sizes)))[open_]
            words, sizes, tok, rank = words[open_], sizes[open_], tok[held], rank[held]
            tok[at] = self.found(tok[at], tok[at + 1])[1]
            stay = np.ones(len(tok), np.bool_)
            stay[at + 1] = False
            tok, rank, sizes, at = tok[stay], rank[stay], sizes - 1, at - np.arange(len(at))
            first = np.cumsum(sizes) - sizes
            rank[at] = NO_RANK
            for pair in (at[at > first] - 1, at[at < first + sizes - 1]):
                rank[pair] = self.found(tok[pair], tok[pair + 1])[0]


def _word_start_ids(word: Column) -> Column:
    """Coded start of a word: one special id, or its bytes."""
    return F.coalesce(special_to_code(word), coded(word))


def word_ids(sym: Column, merges: DataFrame) -> Column:
    """Ids of coded words, computed in Arrow batches. Meant for distinct words."""
    rules = merges.sparkSession.sparkContext.broadcast(merge_rules(merges))

    @F.arrow_udf("array<int>")
    def run(syms: pa.Array) -> pa.Array:
        texts = syms.to_pylist()
        tokens = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64) - 1
        pool, starts, sizes = MergeTable(rules.value).merged(tokens, np.array([len(x) for x in texts], np.int64))
        each = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32)), pa.array(np.arange(len(texts), dtype=np.int32)))
        return _lists(*laid_out(each, sizes, starts, pool))

    return run(sym)


class WordDictionary:
    """Words with their ids under one merge table, kept in a folder as a table bucketed by word.

    Runs share the folder and add the words it does not have, so that a word is merged once per tokenizer. Joins by word
    read the buckets in place: the dictionary is never exchanged. One run at a time may add words.
    """

    SCHEMA = "word string, ids array<int>"

    def __init__(self, spark: SparkSession, folder: str, merges: DataFrame, allow_special: bool = True, buckets: int = BUCKETS) -> None:
        self.spark, self.merges, self.allow_special = spark, merges, allow_special
        rules = merges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("rank", "left_id", "right_id", "new_id"))).first()
        key = f"{rules[0]}_{(rules[1] or 0) & (1 << 64) - 1:016x}_{'special' if allow_special else 'plain'}_{buckets}"
        self.path = f"{file_uri(spark, folder)}/words_{key}"
        self.name = f"words_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"
        # The catalog may forget the table between sessions; its files and their buckets stay.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.SCHEMA}) USING parquet CLUSTERED BY (word) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def extend(self, found: DataFrame) -> int:
        """Add the words of ``found`` that are new, merged in Arrow batches; how many they were."""
        new = as_written(found.select("word").distinct().join(self.table(), "word", "left_anti"), "new-words")
        n = new.count()
        if n:
            code = _word_start_ids(F.col("word")) if self.allow_special else coded(F.col("word"))
            new.select("word", word_ids(code, self.merges).alias("ids")).write.insertInto(self.name)
        discard(new)
        return n


def word_blocks(docs: DataFrame, keys: list[str], allow_special: bool = True, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents as numbers of words, in blocks of some ``block_words`` words, written.

    Rows with ``codes`` are documents: each number is a place in the ``words`` of their block, which is a row of its own.
    """
    kinds = dict(docs.dtypes)
    fields = docs.select(*keys).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(fields)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            lists, at = batch.column(batch.num_columns - 1), 0
            offsets = lists.offsets.to_numpy().astype(np.int64)
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + block_words, side="right")) - 1)
                own = lists.slice(at, end - at).flatten().dictionary_encode()
                bounds = pa.array((offsets[at:end + 1] - offsets[at]).astype(np.int32))
                codes = pa.ListArray.from_arrays(bounds, own.indices.cast(pa.int32()))
                n, block = end - at, block + 1
                none = [pa.nulls(1, t.type) for t in types]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n), *[batch.column(k).slice(at, n) for k in range(len(keys))], codes, pa.nulls(n, pa.list_(pa.string()))],
                    names=["block", *keys, "codes", "words"])
                yield pa.RecordBatch.from_arrays([pa.array([block]), *none, pa.nulls(1, codes.type), pa.array([own.dictionary.to_pylist()], pa.list_(pa.string()))],
                                                 names=["block", *keys, "codes", "words"])
                at = end

    cut = docs.select(*keys, segments(F.col("text"), allow_special).alias("segments"))
    schema = ", ".join(["block long", *[f"`{k}` {kinds[k]}" for k in keys], "codes array<int>, words array<string>"])
    return as_written(cut.mapInArrow(work, schema), "blocks")


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))


def gathered(lists: pa.Array, entries: list[list[int]]) -> pa.Array:
    """Lists of numbers of entries as lists of what the entries hold, see ``laid_out``."""
    sizes = np.array([len(e) for e in entries], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    pool = np.fromiter(chain.from_iterable(entries), dtype=np.int32, count=int(sizes.sum()))
    return _lists(*laid_out(lists, sizes, starts, pool))


def laid_out(lists: pa.Array, sizes: np.ndarray, starts: np.ndarray, pool: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the entries of all lists hold, one after the other, and the offsets of the lists in it.

    Places of ids are worked out for ``GATHER`` numbers at a time: beside the ids only a few bytes per number are held.
    """
    at = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.zeros(len(at) + 1, dtype=np.int64)
    np.cumsum(sizes[at], out=ends[1:])
    out = np.empty(int(ends[-1]), dtype=pool.dtype)
    for low in range(0, len(at), GATHER):
        own, first = at[low:low + GATHER], ends[low:low + GATHER + 1]
        here = np.repeat(starts[own] - first[:len(own)], sizes[own]) + np.arange(first[0], first[-1])
        out[first[0]:first[-1]] = pool[here]
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return out, ends[offsets - offsets[0]].astype(np.int32)


def encode_by_dictionary(docs: DataFrame, keys: list[str], words: WordDictionary, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add ``ids`` to the documents from a dictionary that is first extended by their new words.

    A word meets the dictionary once for every block of documents and not once for every occurrence; documents are
    exchanged once, as numbers, to the ids of their block. Empty documents have no ids.
    """
    blocks = word_blocks(docs, keys, words.allow_special, block_words)
    used = blocks.filter("words is not null").select(F.col("block").alias("at"), F.posexplode("words").alias("code", "word"))
    words.extend(used)
    found = used.join(words.table(), "word").select("at", "code", "ids")
    kinds = dict(docs.dtypes)

    def gather(texts: pa.Table, entries: pa.Table) -> pa.Table:
        texts, entries = texts.combine_chunks(), entries.combine_chunks()
        none = pa.array([], pa.list_(pa.int32()))
        codes = texts.column("codes").chunk(0) if texts.num_rows else none
        own = entries.column("ids").chunk(0) if entries.num_rows else none
        at, bounds = entries.column("code").to_numpy(), own.offsets.to_numpy().astype(np.int64)
        starts, sizes = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        starts[at], sizes[at] = bounds[:-1], np.diff(bounds)
        ids = _lists(*laid_out(codes, sizes, starts, own.values.to_numpy(zero_copy_only=False)))
        return pa.table({**{k: texts.column(k) for k in keys}, "ids": ids})

    texts = blocks.filter("codes is not null").select("block", *keys, "codes")
    return texts.groupBy("block").cogroup(found.groupBy("at")).applyInArrow(
        gather, ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "ids array<int>"]))


def encode_in_place(docs: DataFrame, merges: DataFrame, allow_special: bool = True) -> DataFrame:
    """Add ``ids`` without any shuffle.

    The text is cut into words by Spark; per Arrow batch, only distinct words are merged, many at once, and the ids of
    the batch are gathered by index. Nothing is kept from one batch to the next.
    """
    rules = merges.sparkSession.sparkContext.broadcast(merge_rules(merges))
    tables: list[MergeTable] = []

    @F.arrow_udf("array<int>")
    def run(lists: pa.Array) -> pa.Array:
        if not tables:
            tables.append(MergeTable(rules.value))
        batch = lists.flatten().dictionary_encode()
        offsets = lists.offsets.to_numpy().astype(np.int64)
        codes = pa.ListArray.from_arrays(pa.array((offsets - offsets[0]).astype(np.int32)), batch.indices)
        return _lists(*_ids_of_lists(codes, batch.dictionary, tables[0], allow_special))

    return docs.withColumn("ids", run(segments(F.col("text"), allow_special)))


def _ids_of_lists(codes: pa.ListArray, words: pa.Array, table: MergeTable, allow_special: bool) -> tuple[np.ndarray, np.ndarray]:
    """The ids of lists of places in ``words``, one after the other, and the offsets of the lists in them."""
    held = words.cast(pa.large_string())
    bounds = np.frombuffer(held.buffers()[1], np.int64)[held.offset:held.offset + len(held) + 1] if len(held) else np.zeros(1, np.int64)
    data = np.frombuffer(held.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    pool, starts, sizes = table.merged(BYTE_IDS[data], np.diff(bounds))
    if allow_special:
        special = pc.index_in(held, value_set=pa.array(SPECIAL_TOKENS, pa.large_string())).fill_null(-1).to_numpy(zero_copy_only=False)
        there = np.flatnonzero(special >= 0)
        starts[there], sizes[there] = len(pool) + special[there], 1
        pool = np.concatenate([pool, np.arange(len(SPECIAL_TOKENS), dtype=np.int32)])
    return laid_out(codes, sizes, starts, pool)


def encode_bytes(docs: DataFrame, allow_special: bool = True) -> DataFrame:
    """Add ``ids`` under the merge-free vocabulary, by column expressions alone."""
    return docs.withColumn("ids", byte_ids(F.col("text"), allow_special))


def count_bytes(docs: DataFrame, allow_special: bool = True) -> DataFrame:
    """Add ``n_tokens``, framed, without building the ids."""
    return docs.withColumn("n_tokens", byte_token_count(F.col("text"), allow_special) + 2)


def frame(docs: DataFrame) -> DataFrame:
    """Drop documents without ids and put begin and end markers around the others.

    A document has no ids if and only if its text is empty; testing the text keeps the optimizer from encoding
    once for the filter and once more for the result.
    """
    some = F.col("text") != "" if "text" in docs.columns else F.size("ids") > 0
    out = docs.filter(some).withColumn("ids", framed(F.col("ids")))
    return out.withColumn("n_tokens", F.size("ids").cast("long"))


def pack(tokens: np.ndarray) -> bytes:
    """Tokens as their number and their low and high bytes, compressed."""
    planes = tokens.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()
    return len(tokens).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(pa.decompress(data[4:], 2 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(2, n).T).view("<u2").ravel()


def packed(ids: Column) -> Column:
    """Id arrays as compressed 16-bit tokens, in which form they are kept and exchanged."""
    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        offsets, values = lists.offsets.to_numpy(), lists.values.fill_null(0).to_numpy()
        own = values[offsets[0]:offsets[-1]]
        if len(own) and (own.min() < 0 or own.max() >= UINT16_LIMIT):
            raise ValueError("token id outside 0..65535")
        return pa.array([pack(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())

    return run(ids)


def unpacked(lists: Column) -> Column:
    """The ids of arrays of packed ones, joined."""
    @F.arrow_udf("array<int>")
    def run(lists: pa.Array) -> pa.Array:
        offsets, held = lists.offsets.to_numpy(), lists.values.to_pylist()
        pieces = [unpack(data) for data in held[offsets[0]:offsets[-1]]]
        ends = np.cumsum([0, *map(len, pieces)])[offsets - offsets[0]]
        return _lists(np.concatenate([np.empty(0, np.int32), *pieces]).astype(np.int32), ends.astype(np.int32))

    return run(lists)


def checked_uint16(ids: Column) -> Column:
    """The ids, or an error if one does not fit 16 unsigned bits."""
    bad = F.exists(ids, lambda t: (t < 0) | (t >= UINT16_LIMIT))
    return F.when(bad, F.raise_error(F.lit("token id outside 0..65535"))).otherwise(ids)


def vocab_spellings(vocab: DataFrame) -> list[bytes]:
    """The bytes of every vocabulary entry, by id; its size is checked."""
    rows = vocab.limit(UINT16_LIMIT + 1).collect()
    if len(rows) > UINT16_LIMIT:
        raise ValueError(f"more than {UINT16_LIMIT} vocabulary entries")
    by_id = {r["id"]: bytes.fromhex(r["token_hex"]) for r in rows}
    return [by_id.get(i, b"") for i in range(max(by_id) + 1)]


def decode_ids(ids: Column, spellings: list[bytes], skip_markers: bool = False) -> Column:
    """The text of an id array. Bytes that are no valid UTF-8 become the replacement character."""
    if skip_markers:
        ids = F.filter(ids, lambda t: ~t.isin(BOS_ID, EOS_ID))
    sizes = np.array([len(s) for s in spellings], dtype=np.int64)
    starts, pool = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(spellings), np.uint8)

    @F.arrow_udf("binary")
    def spelled(lists: pa.Array) -> pa.Array:
        found = pc.min_max(lists.flatten()).as_py()
        if found["min"] is not None and (found["min"] < 0 or found["max"] >= len(sizes)):
            raise ValueError("token id outside the vocabulary")
        if not len(lists):
            return pa.array([], pa.binary())
        out, ends = laid_out(lists, sizes, starts, pool)
        texts = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(out)])
        return pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.binary())) if lists.null_count else texts

    return F.make_valid_utf8(spelled(ids).cast("string"))


def roundtrip(docs: DataFrame, spellings: list[bytes]) -> DataFrame:
    """Documents and mismatches per source after encoding and decoding."""
    same = F.col("text").eqNullSafe(decode_ids(F.col("ids"), spellings))
    return docs.groupBy("mix_source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(~same).alias("n_mismatch")
    )
