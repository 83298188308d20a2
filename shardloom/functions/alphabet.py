"""The byte alphabet, and words written with one code point per token.

Token ids stay below the surrogate range, so a sequence of ids can be held as a string whose n-th code
point is the n-th id plus one (a zero code point would mean "delete" to ``translate``). Binary string
order is then id order, and a merge is a plain string replacement.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from shardloom.spec import BOS_ID, BYTE_BASE, EOS_ID, SPECIAL_TOKENS

MAX_CODED_ID = 0xD7FE


def code_point(token_id: int) -> str:
    return chr(token_id + 1)


def _visible_first() -> list[int]:
    """All bytes in id order: printable ones ascending, then the others ascending."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = set(printable)
    return printable + [b for b in range(256) if b not in shown]


BYTES_IN_ID_ORDER = _visible_first()
ID_OF_BYTE = {b: BYTE_BASE + i for i, b in enumerate(BYTES_IN_ID_ORDER)}

_LATIN = "".join(map(chr, range(256)))
_CODED = "".join(code_point(ID_OF_BYTE[b]) for b in range(256))


def coded(text: Column) -> Column:
    """UTF-8 bytes of ``text`` as a string of byte-token code points."""
    return F.translate(F.decode(text.cast("binary"), "ISO-8859-1"), _LATIN, _CODED)


def special_to_code(text: Column) -> Column:
    """The coded form of a special literal; null for every other string."""
    out = F.lit(None).cast("string")
    for i, token in enumerate(SPECIAL_TOKENS):
        out = F.when(text == token, F.lit(code_point(i))).otherwise(out)
    return out


def byte_ids(text: Column, allow_special: bool = True) -> Column:
    """Ids of a text under the merge-free vocabulary.

    Special literals are first set to single bytes that no UTF-8 text contains (0xF8 + position),
    so that one translation yields special and byte ids alike.
    """
    if not allow_special:
        return _ids_of_bytes(text.cast("binary"), F.lit(False))
    marked = F.contains(text, F.lit("<"))
    latin = F.decode(text.cast("binary"), "ISO-8859-1")
    for i, token in enumerate(SPECIAL_TOKENS):
        latin = F.replace(latin, F.lit(token), F.lit(chr(0xF8 + i)))
    return _ids_of_bytes(F.when(marked, F.encode(latin, "ISO-8859-1")).otherwise(text.cast("binary")), marked)


def _ids_of_bytes(data: Column, marked: Column) -> Column:
    """One id per byte, looked up for a batch at once; where ``marked``, bytes from 0xF8 on are special ids."""
    plain = np.array([ID_OF_BYTE[b] for b in range(256)], np.int32)
    special = plain.copy()
    special[0xF8:0xF8 + len(SPECIAL_TOKENS)] = range(len(SPECIAL_TOKENS))

    @F.arrow_udf("array<int>")
    def looked_up(texts: pa.Array, marks: pa.Array) -> pa.Array:
        _, places, content = texts.buffers()
        if not len(texts) or places is None:
            return pa.nulls(len(texts), pa.list_(pa.int32()))
        offsets = np.frombuffer(places, np.int32)[texts.offset:texts.offset + len(texts) + 1]
        held = np.frombuffer(content or b"", np.uint8)[offsets[0]:offsets[-1]]
        ids, ends = plain[held], offsets - offsets[0]
        high = np.flatnonzero(held >= 0xF8)
        if len(high):
            own = marks.fill_null(False).to_numpy(zero_copy_only=False)[np.searchsorted(ends, high, side="right") - 1]
            ids[high[own]] = special[held[high[own]]]
        mask = texts.is_null() if texts.null_count else None
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids), mask=mask)

    return looked_up(data, marked)


def framed(ids: Column) -> Column:
    """Begin marker, ids, end marker."""
    return F.concat(F.array(F.lit(BOS_ID)), ids, F.array(F.lit(EOS_ID)))
