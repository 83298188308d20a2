import os
import random
import tracemalloc
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardloom.functions.alphabet import ID_OF_BYTE
from shardloom.operators import encode as en
from shardloom.operators import vocab as vo
from shardloom.operators import word_parts as wp
from shardloom.plans import fixture as fx
from shardloom.session import as_written, scratch_path
from shardloom.spec import SPECIAL_TOKENS
from tests.test_text import TEXTS, reference_tokenizer

SF = "/root/testdata/sf0.001"


def library(texts, vocab_size):
    tk, tok = reference_tokenizer()
    trainer = tk.trainers.BpeTrainer(vocab_size=vocab_size, special_tokens=list(SPECIAL_TOKENS), show_progress=False,
                                     initial_alphabet=tk.pre_tokenizers.ByteLevel.alphabet())
    tok.train_from_iterator(texts, trainer)
    return tok


def test_merges_and_ids_equal_the_library(spark):
    docs = as_written(fx.corpus(spark, SF, 21), "docs")
    texts = [r["text"] for r in docs.orderBy("source_ord", "ord").collect()]
    tok = library(texts, 263 + 150)
    counts = as_written(vo.word_counts(docs), "counts")
    merges = vo.train_merges(counts, vocab_size=263 + 150)
    vocab = {s: i for i, s in merges.spelled.items()}
    assert tok.get_vocab_size() == merges.vocab_size
    alphabet = {i: t for t, i in tok.get_vocab().items()}
    spelled = {i: tok.decoder.decode([alphabet[i]]) for i in sorted(vocab.values())[256:]}
    assert {i: merges.spelled[i].decode(errors="replace") for i in spelled} == spelled

    table = merges.table(spark)
    extra = spark.createDataFrame([("extra", 9, i, t) for i, t in enumerate(TEXTS)], docs.schema)
    both = docs.unionByName(extra)
    want = {(r["mix_source"], r["ord"]): tok.encode(r["text"], add_special_tokens=False).ids for r in both.collect()}
    keys = ["mix_source", "ord"]
    placed = {(r["mix_source"], r["ord"]): r["ids"] for r in en.encode_in_place(both, table).collect()}
    assert placed == want
    for some in ("false", "ord % 2 = 0"):
        words = en.WordDictionary(spark, scratch_path(spark, "dict"), table, buckets=4)
        if some != "false":
            en.encode_by_dictionary(both.filter(some), keys, words, block_words=300).count()
        before = words.table().count()
        encoded = en.encode_by_dictionary(both, keys, words, block_words=1000)
        assert {(r["mix_source"], r["ord"]): r["ids"] for r in encoded.collect()} == want
        assert words.table().count() == words.table().select("word").distinct().count() > before
        # Another session finds the words in the folder; a second run merges none, and the dictionary is not exchanged.
        spark.sql(f"DROP TABLE {words.name}")
        again = en.WordDictionary(spark, os.path.dirname(words.path), table, buckets=4)
        assert again.extend(en.word_blocks(both, keys).select(F.explode("words").alias("word"))) == 0
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = both.select(F.col("text").alias("word")).join(again.table(), "word")._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert en.roundtrip(en.encode_in_place(both, table), en.vocab_spellings(merges.vocab(spark))).agg(
        F.sum("n_mismatch")).first()[0] == 0


def test_batched_rounds_equal_single_merges(spark):
    rows = [("low", 5), ("lower", 2), ("newest", 6), ("widest", 3), ("aaaa", 4), ("aaa", 3), ("abab", 2)]
    counts = spark.createDataFrame(rows, "word string, freq long")
    one = vo.train_merges(counts, max_merges=14, candidates=1, checkpoint_rounds=3)
    many = vo.train_merges(counts, max_merges=14, candidates=64, checkpoint_rounds=2)
    assert one.rows == many.rows


def plain_trainer(counts, n):
    """One merge at a time over all words: the highest count, ties to the smaller left id, then right id."""
    words, merges = [([ID_OF_BYTE[b] for b in w.encode()], f) for w, f in counts], vo.Merges()
    pairs, at = Counter(), defaultdict(set)
    for k, (w, f) in enumerate(words):
        for p in zip(w, w[1:]):
            pairs[p] += f
            at[p].add(k)
    while len(merges.rows) < n and pairs:
        best = min(pairs, key=lambda p: (-pairs[p], p))
        new, _ = merges.add(*best)
        for k in at.pop(best):
            w, f = words[k]
            for p in zip(w, w[1:]):
                pairs[p] -= f
                if not pairs[p]:
                    del pairs[p]
            out = []
            for t in w:
                if out and out[-1] == best[0] and t == best[1]:
                    out[-1] = new
                    if best[0] == best[1]:
                        out.append(None)
                else:
                    out.append(t)
            out = [t for t in out if t is not None]
            words[k] = out, f
            for p in zip(out, out[1:]):
                pairs[p] += f
                at[p].add(k)
    return merges.rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 6)), min_size=1, max_size=12, unique_by=lambda x: x[0]),
       st.integers(1, 5))
def test_a_part_counts_as_its_words_do(words, seed):
    """Runs of pairs that do not overlap, merged at once, against merging word by word."""
    tokens = [[ord(c) for c in w] for w, _ in words]
    part = wp.WordPart.of_words(np.array([t for w in tokens for t in w]), np.array([len(w) for w in tokens]), np.array([f for _, f in words]))
    rng, total = random.Random(seed), Counter(dict(zip(*(x.tolist() for x in part.counts()))))
    for new in (300, 302, 304):
        a, b = rng.choices([97, 98, 99, 300], k=2)
        run = [(a, b, new)] if new not in (a, b) else [(97, 97, new)]
        c, d = rng.choices([97, 98, 99, 300], k=2)
        if new not in (a, b, c, d) and (c, d) != (a, b) and c not in (a, b) and d not in (a, b):
            run.append((c, d, new + 1))
        keys, deltas = part.merge(run)
        total.update(dict(zip(keys.tolist(), deltas.tolist())))
        for x, y, z in run:
            for w in tokens:
                i = 0
                while i < len(w) - 1:
                    if (w[i], w[i + 1]) == (x, y):
                        w[i:i + 2] = [z]
                    i += 1
        want = Counter()
        for w, (_, f) in zip(tokens, words):
            for p in zip(w, w[1:]):
                want[wp.key_of(*p)] += f
        assert want == +total and want == Counter(dict(zip(*(x.tolist() for x in part.counts()))))
        if new == 302:
            part.drop_whole()
            assert want == Counter(dict(zip(*(x.tolist() for x in part.counts()))))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abcd", min_size=1, max_size=9), st.integers(1, 6)), min_size=1, max_size=12))
def test_runs_leave_words_without_their_pairs_alone(words):
    """Runs over the split part against runs over the whole one; no word without a pair of a run is gone through."""
    of = lambda ws: wp.WordPart.of_words(np.array([ord(c) for w, _ in ws for c in w]), np.array([len(w) for w, _ in ws]), np.array([f for _, f in ws]))
    lists = lambda part: sorted(zip((tuple(x.tolist()) for x in np.split(part.tok, np.flatnonzero(part.tok == wp.MARK))[1:-1]), part.freq.tolist()))
    runs = [[(97, 98, 300), (99, 99, 301)], [(300, 97, 302)], [(302, 301, 303), (98, 98, 304)]]
    whole, which = of(words), of(words).touched(runs)
    touched, others = whole.only(which), whole.only(~which)
    assert len(touched.freq) == sum(any(p in w for p in ("ab", "cc", "bb")) for w, _ in words) and len(touched.freq) + len(others.freq) == len(words)
    for run in runs:
        want, got = whole.merge(run), touched.merge(run)
        assert all((a == b).all() for a, b in zip(want, got))
    assert lists(whole) == lists(touched.joined(others))


def test_thousands_of_merges_equal_a_plain_trainer(spark):
    docs = as_written(fx.corpus(spark, SF, 21).filter("ord % 4 = 0"), "docs")
    counts = as_written(vo.word_counts(docs), "counts")
    want = plain_trainer([tuple(r) for r in counts.collect()], 3000)
    got = vo.train_merges(counts, max_merges=3000, front=700, part_words=500)
    assert got.rows == want and got.rounds < 1000
    assert vo.train_merges(counts, max_merges=120, candidates=1, checkpoint_rounds=7).rows == want[:120]


def test_whole_vocabulary_of_small_tables(spark, tmp_path):
    """The registered query on tables that run out of pairs, against the plain trainer."""
    from shardloom.plans.queries import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(12)
    docs.withColumn("text", F.substring("text", 1, 300)).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/conversations.parquet").filter("conv_id < 2").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    counts = [tuple(r) for r in vo.word_counts(fx.corpus(spark, str(tmp_path), 21)).collect()]
    want = plain_trainer(counts, 40_000)
    got = {r["id"]: r for r in QUERIES["bpe_vocabulary"](spark, str(tmp_path)).collect()}
    spelled, first = {i: (i < 7, None) for i in range(263)}, {}
    for rank, left, right, new in want:
        first.setdefault(new, rank)
    assert {i: (r["is_special"], r["rank"]) for i, r in got.items()} == spelled | {i: (False, k) for i, k in first.items()}
    for rank, left, right, new in want:
        if first[new] == rank:
            assert got[new]["token_hex"] == got[left]["token_hex"] + got[right]["token_hex"]


def test_training_stops_without_pairs(spark):
    counts = spark.createDataFrame([("ab", 1)], "word string, freq long")
    merges = vo.train_merges(counts, vocab_size=1000)
    assert len(merges.rows) == 1 and merges.vocab_size == 264


def test_tokenizer_tables_survive_a_write(spark, tmp_path):
    merges = vo.train_merges(spark.createDataFrame([("abc", 3)], "word string, freq long"), max_merges=2)
    vo.save_tokenizer(merges, spark, str(tmp_path))
    vocab, table = vo.load_tokenizer(spark, str(tmp_path))
    assert vocab.count() == 265 and sorted(map(tuple, table.collect())) == merges.rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(7, 9), max_size=30))
def test_merging_equals_repeated_lowest_rank(ids):
    rules = {(7, 8): (0, 263), (7, 7): (1, 264), (263, 263): (2, 265), (264, 8): (3, 266), (9, 263): (4, 267)}

    def slow(seq):
        while True:
            best = min((rules[p][0], i) for i, p in enumerate(zip(seq, seq[1:])) if p in rules) if any(
                p in rules for p in zip(seq, seq[1:])) else None
            if best is None:
                return seq
            i = best[1]
            seq = seq[:i] + [rules[(seq[i], seq[i + 1])][1]] + seq[i + 2:]

    assert en.apply_merges(ids, rules) == slow(list(ids))


def test_gathered_ids_take_little_memory_beside_themselves():
    """Two million words of eight ids: 64 MB of ids; the lists start behind rows that are not theirs."""
    codes = np.arange(2_000_010, dtype=np.int32) % 5
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 2_000_011, 10, dtype=np.int32)), pa.array(codes)).slice(1)
    entries = [[k] * (6 + k) for k in range(5)]
    tracemalloc.start()
    try:
        got = en.gathered(lists, entries)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    want = [t for k in [0, 1, 2, 3, 4] * 2 for t in entries[k]]
    assert len(got) == 200_000 and got[0].as_py() == got[-1].as_py() == want and len(got.flatten()) == 16_000_000
    assert peak < 130_000_000
    assert en.gathered(pa.array([[], [0, 1]], pa.list_(pa.int32())), [[], [7, 8]]).to_pylist() == [[], [7, 8]]


def test_early_rounds_are_replayed_less_and_merges_stay(spark, monkeypatch):
    """The first rounds change most words and are not gone through again 24 times; the merges do not depend on it."""
    counts = spark.createDataFrame([("".join(p), 1 + k % 7) for k, p in enumerate(product("abcde", repeat=4))], "word string, freq long").cache()
    lengths, real = [], vo._changes

    def seen(parts, runs, watched):
        lengths.append(len(runs))
        return real(parts, runs, watched)

    monkeypatch.setattr(vo, "_changes", seen)
    learned = vo.train_merges(counts, max_merges=14, candidates=1)
    assert len(lengths) > 10 and max(lengths) == vo.FIRST_ROUNDS
    assert learned.rows == vo.train_merges(counts, max_merges=14, candidates=1, checkpoint_rounds=1).rows
    assert [vo.replayed(r, 24) for r in (0, 40, 80, 400)] == [5, 5, 10, 24]
