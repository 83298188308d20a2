"""Learning byte-pair merges, and the vocabulary table.

The corpus is read once, for word counts. Everything after runs on distinct words, dealt over parts that hold them as
packed arrays of tokens, see ``word_parts``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.alphabet import BYTES_IN_ID_ORDER, MAX_CODED_ID, coded
from shardloom.functions.text import words
from shardloom.operators.word_parts import SCHEMA as PARTS
from shardloom.operators.word_parts import TYPES as PART_TYPES
from shardloom.operators.word_parts import Run, WordPart
from shardloom.session import as_written, discard
from shardloom.spec import BASE_VOCAB, SPECIAL_TOKENS

MERGE_SCHEMA = "rank int, left_id int, right_id int, new_id int"
VOCAB_SCHEMA = "id int, token_hex string, is_special boolean"

#: Most merges of a round, rounds between written states, leading pairs counted at once, and words of a part.
CANDIDATES = 512
CHECKPOINT_ROUNDS, FIRST_ROUNDS = 24, 5
FRONT = 8192
PART_WORDS = 100_000


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each byte-level word occurs; special literals are not isolated here."""
    return docs.select(F.explode(words(F.col("text"))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("freq")
    )


def coded_words(counts: DataFrame) -> DataFrame:
    return counts.select(coded(F.col("word")).alias("sym"), "freq")


def pair_counts(state: DataFrame) -> DataFrame:
    """Weighted counts ``(pair, n)`` of adjacent tokens over all words: ``pair`` is a coded string of length two."""
    pairs = F.when(F.length("sym") > 1, F.regexp_extract_all("sym", F.lit("(?s)(?=(..))"), F.lit(1))).otherwise(
        F.array().cast("array<string>"))
    return state.select(F.explode(pairs).alias("pair"), "freq").groupBy("pair").agg(F.sum("freq").alias("n"))


class Merges:
    """The learned merges on the driver, at most one per vocabulary entry."""

    def __init__(self) -> None:
        self.rounds = 0
        self.rows: list[tuple[int, int, int, int]] = []
        self.spelled = {BASE_VOCAB - 256 + i: bytes([b]) for i, b in enumerate(BYTES_IN_ID_ORDER)}
        self.ids = {v: k for k, v in self.spelled.items()}

    @property
    def vocab_size(self) -> int:
        return len(SPECIAL_TOKENS) + len(self.spelled)

    def add(self, left: int, right: int) -> tuple[int, bool]:
        """Record a merge; two pairs that spell the same bytes share the first one's id."""
        spelling = self.spelled[left] + self.spelled[right]
        known = spelling in self.ids
        new = self.ids.get(spelling, self.vocab_size)
        if not known:
            self.spelled[new] = spelling
            self.ids[spelling] = new
        self.rows.append((len(self.rows), left, right, new))
        return new, known

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, MERGE_SCHEMA)

    def vocab(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t.encode().hex().upper(), True) for i, t in enumerate(SPECIAL_TOKENS)]
        rows += [(i, s.hex().upper(), False) for i, s in sorted(self.spelled.items())]
        return spark.createDataFrame(rows, VOCAB_SCHEMA)


def _parts(counts: DataFrame, words: int) -> DataFrame:
    """The words of each part as a row of arrays, written; parts are dealt by hash and hold about ``words`` words."""
    spark = counts.sparkSession
    state = as_written(coded_words(counts).filter(F.length("sym") > 1), "words")
    n = max(spark.sparkContext.defaultParallelism, ceil(state.count() / words))

    def build(table: pa.Table) -> pa.Table:
        syms = table.column("sym").to_pylist()
        tokens = np.frombuffer("".join(syms).encode("utf-32-le"), np.uint32) - 1
        made = WordPart.of_words(tokens, np.array([len(x) for x in syms]), table.column("freq").to_numpy())
        return pa.Table.from_pylist([{"part": table.column("part")[0].as_py()} | made.write()], PART_TYPES)

    dealt = state.withColumn("part", F.pmod(F.xxhash64("sym"), F.lit(n)).cast("int"))
    # By range, so that every part gets a task of its own.
    parts = as_written(dealt.repartitionByRange(n, "part").groupBy("part").applyInArrow(build, PARTS), "parts")
    discard(state)
    return parts


def _front(parts: DataFrame, limit: int) -> list:
    """The most frequent pairs ``(key, n)`` over all parts; ties go to the smaller left id, then the smaller right id."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = WordPart.read(row).counts()
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    found = parts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return found.orderBy(F.desc("n"), "key").limit(limit).collect()


def _changes(parts: DataFrame, runs: list[Run], watched: np.ndarray) -> DataFrame:
    """``(key, delta)``: how the last run changes the watched pairs and those of its new tokens, after the runs before it.

    A task goes through the runs since the parts were written, so that a lost one is simply run again. It looks once
    for the words that the runs may change and leaves the others alone.
    """
    first = runs[-1][0][2]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = WordPart.read(row)
                words = words.only(words.touched(runs))
                for run in runs[:-1]:
                    words.merge(run, count=False)
                keys, deltas = words.merge(runs[-1])
                told = (keys >> 32 >= first) | ((keys & 0xFFFFFFFF) >= first) | np.isin(keys, watched, assume_unique=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys[told]), pa.array(deltas[told])], names=["key", "delta"])

    return parts.mapInArrow(work, "key long, delta long").groupBy("key").agg(F.sum("delta").alias("delta"))


def _merged(parts: DataFrame, runs: list[Run]) -> DataFrame:
    """The parts after the runs, written, without words that are one token by now."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                part = WordPart.read(row)
                words, others = part.only(touched := part.touched(runs)), part.only(~touched)
                for run in runs:
                    words.merge(run, count=False)
                words.drop_whole()
                rows.append({"part": row["part"]} | words.joined(others).write())
            yield from pa.Table.from_pylist(rows, PART_TYPES).to_batches()

    return as_written(parts.mapInArrow(work, PARTS), "parts")


class Front:
    """The leading pairs with their exact counts, on the driver.

    No pair outside has a higher count than ``least``, nor the same count and a key below ``last``: counts only fall,
    and a pair that a merge creates is told with its count.
    """

    def __init__(self, rows: list, limit: int) -> None:
        self.counts = {r["key"]: r["n"] for r in rows}
        full = len(rows) == limit
        self.least, self.last = (rows[-1]["n"], rows[-1]["key"]) if full else (0, -1)
        self.queue = [(-n, key) for key, n in self.counts.items()]
        heapq.heapify(self.queue)

    def change(self, key: int, delta: int) -> None:
        n = self.counts.get(key, 0) + delta
        if n >= max(1, self.least):
            self.counts[key] = n
            heapq.heappush(self.queue, (-n, key))
        else:
            self.counts.pop(key, None)

    def run(self, most: int) -> list[tuple[int, int]]:
        """The leading pairs that a strictly sequential trainer would merge next, in this order.

        A pair overlaps an earlier one of the run if it starts with the token that one ends in, or ends in the one it
        starts with; at the first that does, the run ends. Counts of the others stand. A pair that a merge of the run
        creates is at most as frequent as a pair overlapping that merge, so it comes after the whole run, and at
        equal counts as well, since its new id is the highest.
        """
        taken, lefts, rights = [], set(), set()
        while self.queue and len(taken) < most:
            n, key = self.queue[0]
            if self.counts.get(key) != -n:
                heapq.heappop(self.queue)
                continue
            left, right = key >> 32, key & 0xFFFFFFFF
            if (n, key) > (-self.least, self.last) or left in rights or right in lefts:
                break
            heapq.heappop(self.queue)
            del self.counts[key]
            taken.append((left, right))
            lefts.add(left)
            rights.add(right)
        return taken


def replayed(rounds: int, most: int) -> int:
    """Rounds to replay before the parts are written: few at first, when merges change most words, later up to ``most``."""
    return min(most, max(FIRST_ROUNDS, rounds // 8))


def train_merges(counts: DataFrame, vocab_size: int | None = None, max_merges: int | None = None, candidates: int = CANDIDATES,
                 checkpoint_rounds: int = CHECKPOINT_ROUNDS, front: int = FRONT, part_words: int = PART_WORDS) -> Merges:
    """Learn merges from word counts until the vocabulary is full or no pair is left.

    The distinct words are dealt over parts of bounded size. The leading pairs of all parts are counted once; a round
    merges as many of them as a sequential trainer would take before it had to count again (``candidates=1`` merges
    one at a time; both give the same merges) and recounts only around their places. Only changes of leading pairs
    and new pairs as frequent as they are come back. When the leading pairs are used up they are counted anew.
    """
    if vocab_size is not None and vocab_size - 1 > MAX_CODED_ID:
        raise ValueError(f"vocabularies are limited to {MAX_CODED_ID + 1} entries")
    merges = Merges()
    done = lambda: (
        (vocab_size is not None and merges.vocab_size >= vocab_size)
        or (max_merges is not None and len(merges.rows) >= max_merges)
    )
    parts, ahead = _parts(counts, part_words).persist(), None
    runs: list[Run] = []
    while not done():
        run = ahead.run(candidates) if ahead else []
        if not run:
            if runs:
                parts, runs = _renewed(parts, runs), []
            ahead = Front(_front(parts, front), front)
            run = ahead.run(candidates)
            if not run:
                break
        steps, known = [], False
        for left, right in run:
            new, known = merges.add(left, right)
            steps.append((left, right, new))
            if known or done():
                break
        merges.rounds += 1
        runs.append(steps)
        if done():
            break
        if known:  # a token that was there before gained pairs: counts outside the leading ones may have risen
            ahead = None
            continue
        told = _changes(parts, runs, np.array(sorted(ahead.counts), np.int64))
        for row in told.filter((F.col("delta") >= ahead.least) | (F.col("delta") < 0)).collect():
            ahead.change(row["key"], row["delta"])
        if len(ahead.counts) > 4 * front:
            ahead = None
        if len(runs) >= replayed(merges.rounds, checkpoint_rounds):
            parts, runs = _renewed(parts, runs), []
    parts.unpersist()
    discard(parts)
    return merges


def _renewed(parts: DataFrame, runs: list[Run]) -> DataFrame:
    after = _merged(parts, runs).persist()
    parts.unpersist()
    discard(parts)
    return after


def byte_vocab(spark: SparkSession) -> DataFrame:
    """The vocabulary before any merge: special tokens, then all bytes."""
    return Merges().vocab(spark)


def save_tokenizer(merges: Merges, spark: SparkSession, path: str) -> None:
    merges.vocab(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    merges.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")


def load_tokenizer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(vocab, merges)`` as saved."""
    return (
        spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab"),
        spark.read.schema(MERGE_SCHEMA).parquet(f"{path}/merges"),
    )
