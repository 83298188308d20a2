"""Benchmark decontamination by a generalised suffix automaton over words.

The automaton holds every run of words of every item. Reading a document word by word, it tells the length of
the longest run ending there that occurs in an item; where this reaches the window length, or a short item ends
as a whole, the words are hit.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import by_batch, column_of, kept_rows, with_few, words_of
from shardloom.operators.prefix import exclusive_fold
from shardloom.session import as_written

WINDOW = 13
#: Words of items in one automaton (about 300 bytes each); longer item tables make several automata, and an item
#: is never longer than one of them.
BLOCK_WORDS = 200_000


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items of every window.

    ``whole[s]`` has the lengths of the short items that words read into state ``s`` may end with.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.items: dict[tuple, set[str]] = {}
        wholes: dict[int, set[int]] = {}
        for name, words in items:
            if not words:
                continue
            last = 0
            for w in words:
                last = self._extend(last, w)
            for at in range(max(1, len(words) - window + 1)):
                self.items.setdefault(tuple(words[at:at + window]), set()).add(name)
        for name, words in items:
            if 0 < len(words) < window:
                state = 0
                for w in words:
                    state = self.step[state][w]
                wholes.setdefault(state, set()).add(len(words))
        self.whole: list[tuple[int, ...]] = [()] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.size.__getitem__):
            own = tuple(sorted(wholes.get(state, ())))
            self.whole[state] = self.whole[self.link[state]] + own

    def _clone(self, p: int, q: int, w: bytes) -> int:
        self.step.append(dict(self.step[q]))
        self.link.append(self.link[q])
        self.size.append(self.size[p] + 1)
        made = len(self.step) - 1
        self.link[q] = made
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = made
            p = self.link[p]
        return made

    def _extend(self, last: int, w: bytes) -> int:
        q = self.step[last].get(w)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._clone(last, q, w)
        self.step.append({})
        self.link.append(0)
        self.size.append(self.size[last] + 1)
        now, p = len(self.step) - 1, last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = now
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[now] = q if self.size[q] == self.size[p] + 1 else self._clone(p, q, w)
        return now

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans ``(start, end)`` in words, merged, and the items whose windows occur."""
        step, link, size, whole, window = self.step, self.link, self.size, self.whole, self.window
        spans: list[list[int]] = []
        names: set[str] = set()
        state = length = 0
        root = step[0]
        for at, w in enumerate(words):
            to = step[state].get(w)
            if to is None:
                if not state:
                    continue
                if w not in root:
                    state = length = 0
                    continue
                while to is None:
                    state = link[state]
                    length = size[state]
                    to = step[state].get(w)
            state = to
            length += 1
            if length >= window:
                reach = length
                names |= self.items.get(tuple(words[at - window + 1:at + 1]), set())
            elif whole[state]:
                reach = 0
            else:
                continue
            for k in whole[state]:
                if k <= length:
                    reach = max(reach, k)
                    names |= self.items[tuple(words[at - k + 1:at + 1])]
            if reach:
                start = at - reach + 1
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, at + 1])
        return [(a, b) for a, b in spans], names


def item_pieces(items: DataFrame, id_col: str, text_col: str, window: int, most: int) -> DataFrame:
    """``(i, words, key, n)``: the words of every item, long items as runs of at most ``most`` words, written.

    Runs of one item overlap by all but one word of a window, so that every window lies within one of them.
    """
    def cut(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        names, pieces = [], []
        for name, text in zip(column_of(batch, "i").to_pylist(), column_of(batch, "t").to_pylist()):
            words, step = words_of(text or ""), max(1, most - window + 1)
            for at in range(0, max(1, len(words) - window + 1), step):
                names.append(name or "")
                pieces.append(b" ".join(words[at:at + step + window - 1]))
        return {"i": pa.array(names, pa.string()), "words": pa.array(pieces, pa.binary())}

    rows = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    found = rows.mapInArrow(by_batch(cut, ["i", "words"]), "i string, words binary").filter(F.length("words") > 0)
    n = F.length("words") - F.length(F.regexp_replace(F.decode("words", "ISO-8859-1"), " ", "")) + 1
    return as_written(found.withColumn("n", n.cast("long")).withColumn("key", F.monotonically_increasing_id()).withColumn("all", F.lit(0)), "items")


def automata(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> DataFrame:
    """``(block, automaton)``: one automaton, as bytes, for every ``block_words`` words of items, built in tasks and written."""
    pieces = item_pieces(items, id_col, text_col, window, block_words)
    blocks = exclusive_fold(pieces, "n", ["all"], "key", "before").withColumn("block", F.expr(f"coalesce(before, 0) div {block_words}"))

    def build(table: pa.Table) -> pa.Table:
        rows = zip(table.column("i").to_pylist(), table.column("words").to_pylist())
        made = ItemAutomaton([(name, words.split()) for name, words in rows], window)
        return pa.table({"block": table.column("block").slice(0, 1), "automaton": pa.array([pickle.dumps(made, pickle.HIGHEST_PROTOCOL)], pa.binary())})

    dealt = as_written(blocks.select("block", "i", "words"), "item-blocks")
    return as_written(dealt.groupBy("block").applyInArrow(build, "block long, automaton binary"), "automata")


@dataclass(frozen=True)
class Limits:
    """A document is contaminated when words are hit and they are at least this share of its words."""

    part: int = 1
    of: int = 20


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what follows them up to the next word; the rest stays as it is."""
    raw = text.encode()
    gone = {i for a, b in spans for i in range(a, b)}
    clean, out, last, at = raw.translate(_SPACED), bytearray(), 0, 0
    for i, w in enumerate(clean.split()):
        at = clean.index(w, at)
        if i in gone:
            if i - 1 not in gone:
                out += raw[last:at]
            last = at + len(w)
        elif i - 1 in gone:
            last = at
        at += len(w)
    return (bytes(out) + raw[last:]).decode()


_SPACED = bytes(b if b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, limits: Limits = Limits(),
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans``.

    ``spans`` are the hit spans, start and end in words from 0. Null and empty texts have no words and are not
    contaminated; items without words hit nothing; of repeated items, or items of one id, the id counts once.
    Null item ids count as an empty string. Other columns are not read; an empty table gives an empty result. Texts
    and items may be of any length: a long item is cut to overlapping runs. Documents never shuffle while the items fit
    one automaton of ``block_words`` words; more items make several, built in tasks. The documents are then written
    once with a row key, all automata go over them in one job, and what they hit is joined by the key.
    """
    spark: SparkSession = docs.sparkSession
    out = ["doc_id", "uid", "n_words", "starts", "ends", "names"]
    schema = (f"doc_id {dict(docs.dtypes)[id_col]}, uid bigint, n_words bigint, starts array<bigint>, "
              "ends array<bigint>, names array<string>")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("uid"))
    built = automata(items, item_id, item_text, window, block_words)
    order = [r["block"] for r in built.select("block").orderBy("block").collect()]
    if len(order) > 1:
        # Every block looks at all documents: the keys must not depend on how each of them splits the documents.
        rows = as_written(rows, "keyed-documents")
    parts = []
    for block in order or [None]:
        # One block at a time passes through the driver; its size is that of ``block_words`` words.
        sent = None if block is None else spark.sparkContext.broadcast(built.filter(F.col("block") == block).first()["automaton"])

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            automaton = pickle.loads(sent.value) if sent else ItemAutomaton([], window)

            def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
                n, starts, ends, names = [], [], [], []
                for text in column_of(batch, "text"):
                    words = words_of(text.as_py() or "")
                    spans, found = automaton.scan(words)
                    n.append(len(words))
                    starts.append([a for a, _ in spans])
                    ends.append([b for _, b in spans])
                    names.append(sorted(found))
                longs = pa.list_(pa.int64())
                return {"doc_id": column_of(batch, "doc_id"), "uid": column_of(batch, "uid"), "n_words": pa.array(n, pa.int64()),
                        "starts": pa.array(starts, longs), "ends": pa.array(ends, longs),
                        "names": pa.array(names, pa.list_(pa.string()))}

            return by_batch(make, out)(batches)

        parts.append(rows.mapInArrow(work, schema))
    pieces = parts[0]
    if len(parts) > 1:
        # All blocks run in one job; a document has a row for every block that hits it, and one of its own.
        hits = reduce(DataFrame.unionByName, [p.filter(F.size("names") > 0).select("uid", "starts", "ends", "names") for p in parts])
        met = as_written(hits.groupBy("uid").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "names")]), "hits")
        none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
        sizes = parts[0].select("doc_id", "uid", "n_words")
        pieces = sizes.join(met, "uid", "left").select("doc_id", "uid", "n_words", none("starts", "bigint"), none("ends", "bigint"), none("names", "string"))
    return pieces.mapInArrow(by_batch(_digests(limits), RESULT), f"doc_id {dict(docs.dtypes)[id_col]}, {RESULT_TYPES}")


def decontaminated(rows: DataFrame, items: DataFrame, key: str, text_col: str = "text", size_col: str | None = None,
                   limits: Limits = Limits(), **settings) -> DataFrame:
    """The rows without what they share with the items; ``key`` tells the rows apart.

    Rows beyond the limits go; from the others the hit spans are cut in place, and the rest of the text, with its
    spaces and signs, stays. ``size_col`` is set to the new length of a text that was cut. Rows without hits, null and
    empty texts among them, come back as they are; so do other columns. The columns keep their order.
    """
    found = as_written(contamination(rows, items, key, text_col, limits=limits, **settings).select(
        F.col("doc_id").alias("__of"), "contaminated", "spans").filter(F.size("spans") > 0), "found")
    some = found.filter("not contaminated").select("__of", F.col("spans.start").alias("__starts"), F.col("spans.end").alias("__ends"))
    clean = kept_rows(rows, found.select(F.col("__of").alias(key), F.lit(False).alias("keep")), key)
    kinds, names = dict(rows.dtypes), rows.columns

    def cut(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        spans = zip(column_of(batch, "__starts").to_pylist(), column_of(batch, "__ends").to_pylist())
        texts = [without_spans(t, list(zip(*s))) for t, s in zip(column_of(batch, text_col).to_pylist(), spans)]
        return {c: column_of(batch, c) for c in names} | {text_col: pa.array(texts, pa.string())}

    touched = with_few(rows.withColumn("__of", F.col(key)), some, ["__of"])
    rest = touched.mapInArrow(by_batch(cut, names), ", ".join(f"`{c}` {kinds[c]}" for c in names))
    if size_col:
        rest = rest.withColumn(size_col, F.length(text_col).cast(kinds[size_col]))
    return clean.unionByName(rest)


RESULT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
RESULT_TYPES = ("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
                "spans array<struct<start: bigint, end: bigint>>")


def _digests(limits: Limits):
    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        hit, n_items, shas, bad, spans = [], [], [], [], []
        n_words = column_of(batch, "n_words")
        for n, starts, ends, names in zip(n_words.to_pylist(), column_of(batch, "starts").to_pylist(),
                                          column_of(batch, "ends").to_pylist(), column_of(batch, "names").to_pylist()):
            merged, found = _merged(zip(starts, ends)), sorted(set(names))
            covered = sum(b - a for a, b in merged)
            hit.append(covered)
            n_items.append(len(found))
            shas.append(hashlib.sha256(",".join(found).encode()).hexdigest())
            bad.append(covered > 0 and limits.of * covered >= limits.part * n)
            spans.append([{"start": a, "end": b} for a, b in merged])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return {"doc_id": column_of(batch, "doc_id"), "n_words": n_words, "n_hit": pa.array(hit, pa.int64()),
                "n_items": pa.array(n_items, pa.int64()), "items_sha256": pa.array(shas, pa.string()),
                "contaminated": pa.array(bad, pa.bool_()), "spans": pa.array(spans, kind)}

    return make
