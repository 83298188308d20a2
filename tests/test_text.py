import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardloom.functions.alphabet import ID_OF_BYTE, byte_ids
from shardloom.functions.text import long_enough, render_chat, segments, words
from shardloom.operators import encode as en
from shardloom.operators.vocab import byte_vocab
from shardloom.sources.readers import filter_language, messages_from_turns, project_text
from shardloom.spec import SPECIAL_TOKENS, SourceSpec, parse_mixture


def column(spark, values, expr, schema="text string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_length_boundaries(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    values = [letters[:19], letters[:20], letters[:21], "\t\n " + letters[:18] + "  \x1c",
              "  " + letters[:20] + "\n", "a" + " " * 18 + "b", "a" + " " * 40, None, "", " " * 50, "é" * 20, "\U0001f600" * 19]
    python = [bool(v) and len(v.strip()) >= 20 for v in values]
    assert column(spark, values, long_enough(F.col("text"), 20)) == python
    strict = [bool(v) and len(v.strip()) > 20 for v in values]
    assert column(spark, values, long_enough(F.col("text"), 21)) == strict


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=20, max_size=40))
def test_length_any_text(spark, values):
    assert column(spark, values, long_enough(F.col("text"), 20)) == [len(v.strip()) >= 20 for v in values]


def test_chat(spark):
    chats = [
        [("user", "hi"), ("tool", "x"), ("assistant", "yo")],
        [(None, "no role"), ("system", None)],
        [("tool", "only")], [], None,
    ]
    want = ["<|user|>\nhi\n<|assistant|>\nyo", "<|user|>\nno role\n<|system|>\n", "", "", ""]
    got = column(spark, chats, render_chat(F.col("m")), "m array<struct<role: string, content: string>>")
    assert got == want


def test_turn_order_with_gaps(spark):
    turns = spark.createDataFrame([(1, 7, "user", "c"), (1, 0, "user", "a"), (1, 3, "assistant", "b")],
                                  "conv_id long, turn long, role string, text string")
    got = messages_from_turns(turns).select(render_chat(F.col("messages"))).first()[0]
    assert got == "<|user|>\na\n<|assistant|>\nb\n<|user|>\nc"


def test_language_and_field(spark):
    df = spark.createDataFrame([(1, "x", "fr"), (2, None, "fr"), (3, "y", None)], "ord long, text string, lang string")
    kept = project_text(filter_language(df, "fr"), "text").orderBy("ord").collect()
    assert [tuple(r) for r in kept] == [(1, "x"), (2, "")]
    assert filter_language(df, None).count() == 3


def test_mixture_config():
    mix = parse_mixture({"sources": {"a": {"dataset": "d", "config": "c", "weight": 3, "chat_format": "x"},
                                     "b": {"dataset": "e", "config": None, "weight": 1}},
                         "validation": {"fraction": 0.1}}, key="doc_id")
    assert [s.location for s in mix.sources] == ["d/c", "e"] and mix.val_fraction == 0.1
    with pytest.raises(ValueError):
        type(mix)((SourceSpec("a", "d"),)).require_weights()


TEXTS = ["a  b", "a\n\nb", "trail   ", "don't we'll I'D", "x</s>y<|user|>\nhi", "<|user|>", "<<s>>", "!!<|user|>!!",
         "tab\t\ttab", "é à ü 你好 12३4", "\U0001f600\U0001f468‍\U0001f469", "a \n<|assistant|>  b", "<unk><pad>", ""]


def reference_tokenizer():
    tk = pytest.importorskip("tokenizers")
    tok = tk.Tokenizer(tk.models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = tk.pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = tk.decoders.ByteLevel()
    return tk, tok


def test_words_and_ids_equal_the_library(spark):
    tk, tok = reference_tokenizer()
    trainer = tk.trainers.BpeTrainer(vocab_size=263, special_tokens=list(SPECIAL_TOKENS), show_progress=False,
                                     initial_alphabet=tk.pre_tokenizers.ByteLevel.alphabet())
    tok.train_from_iterator(["x"], trainer)
    pre = [[t[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(t)] for t in TEXTS]
    assert column(spark, TEXTS, words(F.col("text"))) == pre
    ids = [tok.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert column(spark, TEXTS, byte_ids(F.col("text"))) == ids
    counts = column(spark, TEXTS, en.byte_token_count(F.col("text")))
    assert counts == [len(i) for i in ids]
    plain = [[ID_OF_BYTE[b] for b in t.encode()] for t in TEXTS]
    assert column(spark, TEXTS, byte_ids(F.col("text"), allow_special=False)) == plain


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=20, max_size=40))
def test_roundtrip_any_text(spark, values):
    spellings = en.vocab_spellings(byte_vocab(spark))
    assert column(spark, values, en.decode_ids(byte_ids(F.col("text")), spellings)) == values
    assert column(spark, values, F.array_join(segments(F.col("text")), "")) == values


def test_invalid_utf8_is_replaced(spark):
    spellings = en.vocab_spellings(byte_vocab(spark))
    df = spark.createDataFrame([([1, ID_OF_BYTE[0xC3], ID_OF_BYTE[65], 2],)], "ids array<int>")
    assert df.select(en.decode_ids(F.col("ids"), spellings, skip_markers=True)).first()[0] == "�A"


def test_uint16_guard(spark):
    df = spark.createDataFrame([([1, 70000],)], "ids array<int>")
    with pytest.raises(Exception, match="outside"):
        df.select(en.checked_uint16(F.col("ids"))).collect()


def test_decoding_goes_by_batches(spark):
    """No token is a step of a lambda; null and empty lists stay apart, ids that are no entry are refused."""
    spellings = [b"", b"<s>", b"</s>", b"ab", "\u00e9".encode(), b"\xc3"]
    df = spark.createDataFrame([(0, [3, 4, 3]), (1, None), (2, []), (3, [1, 5, 2]), (4, [0, 0, 4])], "k int, ids array<int>")
    out = df.select("k", en.decode_ids(F.col("ids"), spellings).alias("t"))
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["k"]: r["t"] for r in out.collect()} == {0: "ab\u00e9ab", 1: None, 2: "", 3: "<s>\ufffd</s>", 4: "\u00e9"}
    for bad in (-1, 6):
        with pytest.raises(Exception, match="outside the vocabulary"):
            spark.range(1).select(en.decode_ids(F.array(F.lit(bad)), spellings)).collect()


def test_byte_ids_go_by_batches(spark):
    """No byte is a step of a lambda; nulls stay, and only texts with a literal have special ids."""
    df = spark.createDataFrame([(0, "a<s>\u00f8</s>"), (1, None), (2, ""), (3, "<|user"), (4, "\u00e9" * 70_000)], "k int, text string")
    out = df.select("k", byte_ids(F.col("text")).alias("ids"), byte_ids(F.col("text"), False).alias("plain"),
                    byte_ids(F.expr("cast(x'61F8' as string)")).alias("raw"))
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    of = lambda t: None if t is None else [ID_OF_BYTE[b] for b in t.encode()]
    got = {r["k"]: r for r in out.collect()}
    assert got[0]["ids"] == [*of("a"), 1, *of("\u00f8"), 2] and got[0]["plain"] == of("a<s>\u00f8</s>")
    assert all(got[r["k"]]["ids"] == got[r["k"]]["plain"] == of(r["text"]) for r in df.collect()[1:])
    assert {tuple(r["raw"]) for r in got.values()} == {(ID_OF_BYTE[0x61], ID_OF_BYTE[0xF8])}


def test_words_merged_at_once_equal_words_merged_one_by_one():
    """Overlapping pairs, equal ranks, shared new ids, empty and long words, and more words than are merged at once."""
    rng = np.random.default_rng(0)
    for trial in range(30):
        rules = {(int(rng.integers(9)), int(rng.integers(9))): (rank // (1 + trial % 2), int(rng.integers(4, 9))) for rank in range(trial)}
        lengths = np.append(rng.integers(0, 9, 300), [en.LONG_WORD - 1, en.LONG_WORD, 0, 3 * en.LONG_WORD])
        if trial == 7:
            lengths = np.append(lengths, rng.integers(0, 3, en.MERGED_AT_ONCE))
        tokens, ends = rng.integers(0, 4, lengths.sum()), np.cumsum(lengths)
        pool, starts, sizes = en.MergeTable(rules).merged(tokens, lengths)
        for first, end, at, n in zip(ends - lengths, ends, starts, sizes):
            assert pool[at:at + n].tolist() == en.apply_merges(tokens[first:end].tolist(), rules)


def test_special_words_beside_plain_ones(spark):
    """A literal is one id where special tokens are allowed, also when a task has only such words or none."""
    rules = spark.createDataFrame([(0, 263, 264, 265)], "rank int, left_id int, right_id int, new_id int")
    docs = spark.createDataFrame([(0, "a<s>b</s>"), (1, "<pad>"), (2, "")], "ord long, text string").coalesce(1)
    for allow in (True, False):
        got = {r["ord"]: list(r["ids"]) for r in en.encode_in_place(docs, rules, allow).collect()}
        plain = lambda t: [en.ID_OF_BYTE[b] for b in t.encode()]
        assert got[0] == ([*plain("a"), 1, *plain("b"), 2] if allow else plain("a<s>b</s>"))
        assert got[1] == ([3] if allow else plain("<pad>")) and got[2] == []
