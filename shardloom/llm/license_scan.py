"""Licence scan: identifier tags and notice phrases by Aho-Corasick, expressions by a shunting yard.

The words of a text are joined by single blanks and run once through an automaton of all phrases. Where the
identifier tag is found, the expression after it is read from the raw line and evaluated with ``and``, ``or`` and
``with``.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import by_batch, column_of, words_of

#: Phrases whose places are counted.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notices, by their words.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4": "cc-by",
    "cc0 1 0": "cc0",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
#: How freely a text under the licence may be used, from 0 to 1.
FREEDOM = {
    "mit": 1.0, "apache-2": 1.0, "bsd": 1.0, "isc": 1.0, "unlicense": 1.0, "cc0": 1.0, "cc-by": 0.9, "mpl-2": 0.7,
    "lgpl": 0.6, "cc-by-sa": 0.5, "gpl-2": 0.4, "gpl-3": 0.4, "cc-by-nd": 0.3, "agpl-3": 0.3, "cc-by-nc": 0.2,
    "all-rights-reserved": 0.0,
}
UNKNOWN = 0.5
#: What an exception adds to the freedom of the licence it is attached to.
EXCEPTION = 0.2
BINDING = {"with": 3, "and": 2, "or": 1}


def label_of(identifier: str) -> str:
    """The label of a licence identifier: versions are cut to their first number, suffixes dropped."""
    name = re.sub(r"-(only|or-later)$", "", identifier.lower().rstrip("+"))
    name = re.sub(r"^(bsd)-.*", r"\1", name)
    name = re.sub(r"^(lgpl|cc-by(?:-nc|-sa|-nd)?|cc0)-[0-9.]+$", r"\1", name)
    return re.sub(r"^(.*-[0-9]+)(\.[0-9]+)*$", r"\1", name)


_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+-]*)")


def expression_tokens(text: str, at: int = 0) -> list[str]:
    """The longest run from ``at`` on that reads as an expression on one line; open brackets are closed at its end."""
    out: list[str] = []
    depth, operand = 0, True
    while m := _TOKEN.match(text, at):
        t, at = m[1], m.end()
        low = t.lower()
        if operand and t == "(":
            depth += 1
        elif operand and t[0].isalnum() and low not in BINDING:
            t, operand = t.rstrip(".-"), False
        elif not operand and t == ")" and depth:
            depth -= 1
        elif not operand and low in BINDING:
            t, operand = low, True
        else:
            break
        out.append(t)
    while out and (out[-1] in BINDING or out[-1] == "("):
        depth -= out.pop() == "("
    return out + [")"] * depth


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting yard: ``with`` binds before ``and``, ``and`` before ``or``."""
    out, stack = [], []
    for t in tokens:
        if t == "(":
            stack.append(t)
        elif t == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if stack:
                stack.pop()
        elif t in BINDING:
            while stack and stack[-1] != "(" and BINDING[stack[-1]] >= BINDING[t]:
                out.append(stack.pop())
            stack.append(t)
        else:
            out.append(t)
    return out + [t for t in reversed(stack) if t != "("]


def evaluate(tokens: list[str]) -> tuple[float, set[str]] | None:
    """Freedom and labels of an expression: ``or`` is the freer side, ``and`` the stricter, ``with`` adds a little."""
    values: list[tuple[float, set[str]]] = []
    for t in to_postfix(tokens):
        if t not in BINDING:
            label = label_of(t)
            values.append((FREEDOM.get(label, UNKNOWN), {label}))
            continue
        (x, a), (y, b) = values[-2:]
        joined = {"with": (min(1.0, x + EXCEPTION), a), "and": (min(x, y), a | b), "or": (max(x, y), a | b)}[t]
        values[-2:] = [joined]
    return values[0] if values else None


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        made.add_word(f" {phrase} ", phrase)
    made.make_automaton()
    return made


_TAGGED = re.compile(r"spdx[^A-Za-z0-9\x80-\U0010ffff]+license[^A-Za-z0-9\x80-\U0010ffff]+identifier[ \t]*:?", re.I)


def scan_text(text: str, phrases: ahocorasick.Automaton) -> dict:
    """All findings of one text; ``places`` are ``(word, label)`` of the base phrases."""
    words = words_of(text)
    line = " " + b" ".join(words).decode() + " "
    places, base, notices, named, values, tagged = [], set(), set(), set(), [], False
    upto = read = 0  # words that end before the last base phrase does, and how far they are counted
    for end, phrase in phrases.iter(line):
        if phrase in BASE:
            upto, read = upto + line.count(" ", read, end), end
            places.append((upto - phrase.count(" ") - 1, BASE[phrase]))
            base.add(BASE[phrase])
        elif phrase == TAG:
            tagged = True
        else:
            notices.add(NOTICES[phrase])
    if tagged:
        for m in _TAGGED.finditer(text):
            if found := evaluate(expression_tokens(text, m.end())):
                values.append(found[0])
                named |= found[1]
    freedom = [FREEDOM[x] for x in base | notices] + values
    return {"n_words": len(words), "places": places, "base": base, "labels": base | notices | named,
            "score": min(freedom) if freedom else UNKNOWN}


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the freedom of the strictest finding: a notice, or a whole tagged expression, which stands for
    its own identifiers; 0.5 where nothing is found. Null and empty texts have no words and no findings;
    repeated rows repeat; other columns are not read; an empty table gives an empty result. The time taken is in
    proportion to the text, however long it is and however many phrases it holds. Nothing is shuffled.
    """
    state: list = []
    out = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if not state:
            state.append(automaton())
        found = [scan_text(t.as_py() or "", state[0]) for t in column_of(batch, "text")]
        starts = [[w for w, _ in f["places"]] for f in found]
        longs = lambda values: pa.array(values, pa.int64())
        return {"doc_id": column_of(batch, "doc_id"), "n_words": longs([f["n_words"] for f in found]),
                "n_base": longs([len(s) for s in starts]), "first_word": longs([min(s, default=None) for s in starts]),
                "last_word": longs([max(s, default=None) for s in starts]),
                "base_labels": pa.array([",".join(sorted(f["base"])) for f in found], pa.string()),
                "labels": pa.array([",".join(sorted(f["labels"])) for f in found], pa.string()),
                "score": pa.array([f["score"] for f in found], pa.float64())}

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        by_batch(make, out), f"doc_id {dict(docs.dtypes)[id_col]}, n_words bigint, n_base bigint, first_word bigint, "
        "last_word bigint, base_labels string, labels string, score double")
