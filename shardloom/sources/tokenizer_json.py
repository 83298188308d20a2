"""The published one-file form of a tokenizer, as plain JSON."""

from __future__ import annotations

import json

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from shardloom.functions.alphabet import BYTES_IN_ID_ORDER
from shardloom.operators.vocab import MERGE_SCHEMA, VOCAB_SCHEMA, Merges
from shardloom.session import file_uri
from shardloom.spec import BOS_ID, EOS_ID, SPECIAL_TOKENS

#: Printable bytes stand for themselves, the others for the code points from 256 on, in ascending order.
_PRINTABLE = BYTES_IN_ID_ORDER[:188]
CHAR_OF_BYTE = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(BYTES_IN_ID_ORDER[188:])}
BYTE_OF_CHAR = {c: b for b, c in CHAR_OF_BYTE.items()}

#: Fixed values of the format.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_ADDED = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": SPECIAL_TOKENS[0], "continuing_subword_prefix": None, "end_of_word_suffix": None,
          "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}

#: Framing by the reader of the file: begin marker, text, end marker.
_FRAME = {
    "type": "TemplateProcessing",
    "single": [{"SpecialToken": {"id": SPECIAL_TOKENS[BOS_ID], "type_id": 0}}, {"Sequence": {"id": "A", "type_id": 0}},
               {"SpecialToken": {"id": SPECIAL_TOKENS[EOS_ID], "type_id": 0}}],
    "pair": [{"Sequence": {"id": "A", "type_id": 0}}, {"Sequence": {"id": "B", "type_id": 1}}],
    "special_tokens": {SPECIAL_TOKENS[i]: {"id": SPECIAL_TOKENS[i], "ids": [i], "tokens": [SPECIAL_TOKENS[i]]} for i in (BOS_ID, EOS_ID)},
}


def shown(spelling: bytes) -> str:
    return "".join(CHAR_OF_BYTE[b] for b in spelling)


def tokenizer_document(merges: Merges) -> dict:
    vocab = {t: i for i, t in enumerate(SPECIAL_TOKENS)} | {shown(s): i for i, s in sorted(merges.spelled.items())}
    pairs = [[shown(merges.spelled[left]), shown(merges.spelled[right])] for _, left, right, _ in merges.rows]
    return {"version": "1.0", "truncation": None, "padding": None,
            "added_tokens": [{"id": i, "content": t, **_ADDED} for i, t in enumerate(SPECIAL_TOKENS)], "normalizer": None,
            "pre_tokenizer": _BYTE_LEVEL, "post_processor": _FRAME, "decoder": _BYTE_LEVEL, "model": {**_MODEL, "vocab": vocab, "merges": pairs}}


def write_tokenizer_json(spark: SparkSession, merges: Merges, path: str) -> None:
    store, name = pyarrow.fs.FileSystem.from_uri(file_uri(spark, path))
    with store.open_output_stream(name) as out:
        out.write(json.dumps(tokenizer_document(merges), ensure_ascii=False).encode())


def parse_tokenizer(document: dict) -> tuple[list[tuple], list[tuple]]:
    """Rows of the vocabulary and of the merges; merges may be pairs or two tokens in one string."""
    ids, special = document["model"]["vocab"], {a["content"] for a in document.get("added_tokens", []) if a["special"]}
    ids = ids | {a["content"]: a["id"] for a in document.get("added_tokens", [])}
    spelled = lambda t: t.encode() if t in special else bytes(BYTE_OF_CHAR[c] for c in t)
    vocab = [(i, spelled(t).hex().upper(), t in special) for t, i in sorted(ids.items(), key=lambda x: x[1])]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in document["model"]["merges"]]
    return vocab, [(rank, ids[a], ids[b], ids[a + b]) for rank, (a, b) in enumerate(pairs)]


def read_tokenizer_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(vocab, merges)`` tables of a published tokenizer file, wherever Spark can read it."""
    vocab, merges = parse_tokenizer(json.loads(spark.read.text(path, wholetext=True).first()[0]))
    return spark.createDataFrame(vocab, VOCAB_SCHEMA), spark.createDataFrame(merges, MERGE_SCHEMA)
