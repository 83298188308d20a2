"""Column builders for text: stripping, chat rendering, splitting into words, special literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardloom.spec import CHAT_ROLES, SPECIAL_TOKENS

# Fixed value: the published byte-level word pattern.
WORD_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SPECIAL_PATTERN = "|".join(t.replace("|", r"\|") for t in SPECIAL_TOKENS)


def long_enough(text: Column, min_chars: int) -> Column:
    """True for texts of at least ``min_chars`` (2 or more) code points after stripping; null gives false.

    Looks for two non-blank characters far enough apart, which the first few characters mostly settle.
    """
    solid = r"[^\s\x1c-\x1f]"
    return F.coalesce(text.rlike(f"(?sU){solid}.{{{min_chars - 2},}}?{solid}"), F.lit(False))


def render_chat(messages: Column) -> Column:
    """``<|role|>\\ncontent`` for each known role, joined by line ends.

    A missing role reads as ``user`` and missing content as empty; other roles are left out.
    """
    role = lambda m: F.coalesce(m["role"], F.lit("user"))
    known = F.filter(messages, lambda m: role(m).isin(*CHAT_ROLES))
    parts = F.transform(
        known, lambda m: F.concat(F.lit("<|"), role(m), F.lit("|>\n"), F.coalesce(m["content"], F.lit("")))
    )
    return F.coalesce(F.array_join(parts, "\n"), F.lit(""))


def words(text: Column) -> Column:
    """The byte-level words of a text; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def segments(text: Column, allow_special: bool = True) -> Column:
    """Words of a text with every special literal kept whole (``allow_special``) or read as plain text."""
    plain = words(text)
    if not allow_special:
        return plain
    cut = F.split(text, f"(?={SPECIAL_PATTERN})|(?<={SPECIAL_PATTERN})")
    isolated = F.flatten(
        F.transform(cut, lambda s: F.when(s.isin(*SPECIAL_TOKENS), F.array(s)).otherwise(words(s)))
    )
    return F.when(F.contains(text, F.lit("<")), isolated).otherwise(plain)


def byte_token_count(text: Column, allow_special: bool = True) -> Column:
    """Tokens of a text under the merge-free vocabulary, without begin and end markers."""
    if not allow_special:
        return F.octet_length(text).cast("long")
    collapsed = F.when(
        F.contains(text, F.lit("<")), F.regexp_replace(text, SPECIAL_PATTERN, "~")
    ).otherwise(text)
    return F.octet_length(collapsed).cast("long")
