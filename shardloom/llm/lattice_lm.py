"""Language-model scores by a subword lattice.

The pieces of an existing vocabulary lay a lattice over every word; a forward recursion in log space adds up the
probability of all its segmentations. The vocabulary's own scores are the prior of the piece weights and counts
over the training texts sharpen them. Words of the training texts are one more arc each: what absolute
discounting takes from their counts is the share of the lattice.

Counts of frequent words - at most ``HOT_SHARE`` of them by construction - are sent to all tasks. All other
words travel once per document in packed rows to the bucket of their hash, meet their counts there, and only
sums come back.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import column_of, folded_bytes
from shardloom.session import as_written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words with at least this part of all training tokens are frequent.
HOT_SHARE = 65_536
#: Training tokens per bucket of the other words, and distinct words a counting task holds.
PER_BUCKET = 2_000_000
COUNTED_AT_ONCE = 400_000
SPACE = "▁"
LOG10 = math.log(10)


def add_logs(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum([math.exp(t - top) for t in terms]))


class Lattice:
    """Marginal log probability (natural) of words under weighted pieces, and the pieces' spelling in bytes."""

    def __init__(self, weights: dict[str, float], byte_weights: list[float]) -> None:
        self.table: dict[str, float | None] = {}
        for piece, w in weights.items():
            for end in range(1, len(piece)):
                self.table.setdefault(piece[:end], None)
            self.table[piece] = w
        self.byte_weights = byte_weights

    def log_prob(self, word: str) -> float:
        """Forward recursion over the word with its leading space mark."""
        line = SPACE + word
        n, table = len(line), self.table
        arriving: list[list[float]] = [[] for _ in range(n + 1)]
        arriving[0].append(0.0)
        for i in range(n):
            terms = arriving[i]
            if not terms:
                continue
            at = terms[0] if len(terms) == 1 else add_logs(terms)
            arriving[i] = ()
            if (single := table.get(line[i])) is None:
                single = sum([self.byte_weights[b] for b in line[i].encode()])
                arriving[i + 1].append(at + single)
            for j in range(i + 1, n + 1):
                w = table.get(line[i:j], False)
                if w is False:
                    break
                if w is not None:
                    arriving[j].append(at + w)
        return add_logs(arriving[n])


@dataclass
class PieceModel:
    """The vocabulary as text pieces and bytes, with the prior that its scores give."""

    proto: bytes
    text: dict[str, int] = field(default_factory=dict)
    byte: list[int] = field(default_factory=list)
    prior: np.ndarray | None = None

    @classmethod
    def read(cls, path: str = VOCABULARY) -> PieceModel:
        with open(path, "rb") as f:
            proto = f.read()
        own, made = sentencepiece.SentencePieceProcessor(model_proto=proto), cls(proto)
        scores, bytes_of = np.zeros(len(own)), {}
        for i in range(len(own)):
            if own.is_byte(i):
                bytes_of[int(own.id_to_piece(i)[3:5], 16)] = i
            elif not (own.is_control(i) or own.is_unknown(i) or own.is_unused(i)):
                made.text[own.id_to_piece(i)] = i
                scores[i] = own.get_score(i)
        made.byte = [bytes_of[b] for b in range(256)]
        # Scores fall with the place in the vocabulary; the prior of a piece is one over its place.
        places = np.zeros(len(own))
        for place, i in enumerate(sorted(made.text.values(), key=lambda i: (-scores[i], i))):
            places[i] = 1 / (place + 3)
        places[made.byte] = 1 / (len(made.text) + 3)
        made.prior = places / places.sum()
        return made

    def lattice(self, counts: dict[int, int]) -> Lattice:
        """Piece weights from counts and the prior, which counts as much as one occurrence per piece."""
        seen = np.zeros(len(self.prior))
        for i, c in counts.items():
            seen[i] = c
        seen[self.prior == 0] = 0
        strength = float(len(self.text))
        p = (seen + strength * self.prior) / (seen.sum() + strength)
        return Lattice({t: math.log(p[i]) for t, i in self.text.items()}, [math.log(p[i]) for i in self.byte])


@dataclass(frozen=True)
class WordStats:
    """Training totals: tokens, distinct tokens, ends, and the discount taken from every count."""

    tokens: int
    distinct: int
    ends: int
    discount: float

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def score(self, c: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """log10 of the word's probability from its count and the lattice's natural log probability."""
        if not self.tokens:
            return (lattice + math.log(0.5)) / LOG10
        escape = math.log(self.discount * self.distinct / self.tokens)
        own = np.log(np.maximum(c - self.discount, 1e-300) / self.tokens)
        return np.where(c > 0, np.logaddexp(own, escape + lattice), escape + lattice) / LOG10

    @property
    def end_score(self) -> float:
        return math.log10((self.ends - self.discount) / self.tokens) if self.ends else math.log10(0.5)


def count_words(texts: DataFrame) -> DataFrame:
    """``(word, c)`` over all texts of ``text``; the null word counts the texts themselves."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = Counter(), 0

        def made() -> pa.RecordBatch:
            words = pa.array([*found, None], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array([*found.values(), n], pa.int64())], names=["word", "c"])

        for batch in batches:
            run, bounds = folded_bytes(column_of(batch, "text"))
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                found.update(run[a:b].split())
            n += batch.num_rows
            if len(found) > COUNTED_AT_ONCE:
                yield made()
                found, n = Counter(), 0
        if n:
            yield made()

    return texts.select("text").mapInArrow(work, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def piece_counts(words: DataFrame, model: PieceModel) -> dict[int, int]:
    """How often the vocabulary's own segmentation of the distinct words uses each piece; one entry per piece.

    Every word counts once: the lattice has the mass of words that are new, and these resemble the many rare
    words, not the few frequent ones.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sentencepiece.SentencePieceProcessor(model_proto=model.proto)
        sums = np.zeros(len(own), np.int64)
        for batch in batches:
            ids = own.encode(column_of(batch, "word").to_pylist(), num_threads=1)
            flat = np.fromiter((i for x in ids for i in x), np.int64)
            sums += np.bincount(flat, minlength=len(sums))
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["piece", "c"])

    rows = words.select("word").mapInArrow(work, "piece bigint, c bigint").groupBy("piece").agg(F.sum("c").alias("c"))
    return {r["piece"]: r["c"] for r in rows.collect()}


PACKED = ("batch bigint, bucket int, words binary, at binary, times binary, "
          "n_tokens binary, n_known binary, base binary, score binary, held_out binary")


def _pack(docs: DataFrame, stats: WordStats, hot: dict[bytes, tuple[int, float, float]], buckets: int, kind: str) -> DataFrame:
    """Per batch of documents: one row with their sums over frequent words, one per bucket with the other words."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)
    names = [c.split()[0] for c in PACKED.split(", ")] + ["ids"]
    end_base = float(stats.base(np.array(float(stats.ends))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            run, bounds = folded_bytes(column_of(batch, "text"))
            bounds = bounds.tolist()
            tokens, known, base, score = np.ones(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            rest: dict[int, tuple[list, list, list]] = {}
            for i in range(n):
                words = run[bounds[i]:bounds[i + 1]].split()
                tokens[i] += len(words)
                k, b, s = int(stats.ends > 0), end_base, stats.end_score
                for w, times in Counter(words).items():
                    h = frequent.get(w)
                    if h is not None:
                        k += times
                        b += times * h[1]
                        s += times * h[2]
                    else:
                        key = zlib.crc32(w) % buckets
                        lists = rest.get(key)
                        if lists is None:
                            lists = rest[key] = ([], [], [])
                        lists[0].append(w)
                        lists[1].append(i)
                        lists[2].append(times)
                known[i], base[i], score[i] = k, b, s
            first = column_of(batch, "uid")[0].as_py()
            ids = column_of(batch, "doc_id")
            rows = [(first, None, None, None, None, tokens.tobytes(), known.tobytes(), base.tobytes(), score.tobytes(),
                     np.array(column_of(batch, "held_out").to_pylist(), np.bool_).tobytes(), ids.to_pylist())]
            for key, (words, at, times) in sorted(rest.items()):
                rows.append((first, key, b" ".join(words), np.array(at, np.int32).tobytes(),
                             np.array(times, np.int32).tobytes(), None, None, None, None, None, None))
            kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 8 + [pa.list_(ids.type)]
            for a in range(0, len(rows), 256):
                cols = zip(*rows[a:a + 256])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return docs.mapInArrow(work, f"{PACKED}, ids array<{kind}>")


def _meet(packed: DataFrame, words: DataFrame, stats: WordStats, lattice: Lattice) -> DataFrame:
    """Per batch and bucket, the sums of its words over the documents of the batch."""
    sent = packed.sparkSession.sparkContext.broadcast(lattice)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        counts = dict(zip(right.column("word").to_pylist(), right.column("c").to_pylist()))
        lattice, met = sent.value, {}
        c_of, lattice_of = [], []
        out: dict[str, list] = {k: [] for k in ("batch", "at", "n_known", "base", "score")}
        for batch, text, at, times in zip(*[left.column(c) for c in ("batch", "words", "at", "times")]):
            index = []
            for w in text.as_py().decode().split(" "):
                i = met.get(w)
                if i is None:
                    i = met[w] = len(c_of)
                    c_of.append(counts.get(w, 0))
                    lattice_of.append(lattice.log_prob(w))
                index.append(i)
            index = np.array(index)
            c, lat = np.array(c_of, float)[index], np.array(lattice_of)[index]
            times = np.frombuffer(times.as_py(), np.int32)
            docs, place = np.unique(np.frombuffer(at.as_py(), np.int32), return_inverse=True)
            sums = [np.bincount(place, times * v, len(docs)) for v in ((c > 0), stats.base(c), stats.score(c, lat))]
            out["batch"].append(batch.as_py())
            out["at"].append(docs.tobytes())
            out["n_known"].append(sums[0].astype(np.int64).tobytes())
            out["base"].append(sums[1].tobytes())
            out["score"].append(sums[2].tobytes())
        kinds = [pa.int64()] + [pa.binary()] * 4
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    rows = packed.filter("bucket is not null").select("bucket", "batch", "words", "at", "times")
    return rows.groupBy("bucket").cogroup(words.select("bucket", "word", "c").groupBy("bucket")).applyInArrow(
        work, "batch bigint, at binary, n_known binary, base binary, score binary")


def _add_up(packed: DataFrame, sums: DataFrame, stats: WordStats, kind: str) -> DataFrame:
    """One row per document from its batch's row and the sums that came back."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        get = lambda c, t: np.frombuffer(left.column(c)[0].as_py(), t).copy()
        tokens, known, base, score = get("n_tokens", np.int64), get("n_known", np.int64), get("base", float), get("score", float)
        parts = sorted(zip(*[right.column(c).to_pylist() for c in ("at", "n_known", "base", "score")]))
        for at, k, b, s in parts:  # in one order, so that reruns add alike
            at = np.frombuffer(at, np.int32)
            known[at] += np.frombuffer(k, np.int64)
            base[at] += np.frombuffer(b, float)
            score[at] += np.frombuffer(s, float)
        ids = left.column("ids").combine_chunks().flatten()
        return pa.table({"doc_id": ids, "held_out": pa.array(get("held_out", np.bool_)), "n_tokens": tokens, "n_known": known,
                         "train_tokens": np.full(len(tokens), stats.tokens), "base_score": base, "score": score})

    rows = packed.filter("bucket is null").select("batch", "ids", "n_tokens", "n_known", "base", "score", "held_out")
    return rows.groupBy("batch").cogroup(sums.groupBy("batch")).applyInArrow(
        work, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double")


def lattice_scores(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
                   vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held_out`` is a column of ``docs``; rows where it is not true train the model. Texts have A-Z lower-cased
    and are read as words and an end. ``score`` is the model's log10 probability of the text, ``base_score`` that
    of smoothed word counts. Null and empty texts are an end alone; repeated rows repeat, and train repeatedly;
    other columns are not read; without training rows the pieces have the vocabulary's own weights; an empty
    table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"), F.monotonically_increasing_id().alias("uid"))
    counts = as_written(count_words(rows.filter(~F.col("held_out"))), "word-counts")
    t = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.col("word").isNull(), F.col("c"))).alias("ends"),
                   F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    stats = WordStats(t["n"] or 0, t["v"], t["ends"] or 0, max(0.1, min(0.9, t["n1"] / max(1, t["n1"] + 2 * t["n2"]))))
    words = counts.filter("word is not null")
    model = PieceModel.read(vocabulary)
    lattice = model.lattice(piece_counts(words, model))
    top = words.filter(F.col("c") * HOT_SHARE >= stats.tokens).collect()
    c = np.array([float(r["c"]) for r in top])
    values = zip(stats.base(c), stats.score(c, np.array([lattice.log_prob(r["word"]) for r in top]))) if top else ()
    hot = {r["word"].encode(): (r["c"], float(b), float(s)) for r, (b, s) in zip(top, values)}
    buckets = max(8, stats.tokens // PER_BUCKET)
    packed = as_written(_pack(rows, stats, hot, buckets, kind), "packed-words")
    rare = words.filter(F.col("c") * HOT_SHARE < stats.tokens).withColumn("bucket", (F.crc32("word") % buckets).cast("int"))
    sums = as_written(_meet(packed, rare, stats, lattice), "word-sums")
    return _add_up(packed, sums, stats, kind)
