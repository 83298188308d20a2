"""The distinct words of one part of a corpus as packed tokens.

All words of a part lie one after the other in one array of 16-bit tokens with a mark before, between and behind them. One
comparison of this array finds the places of all pairs that a round merges; only these places and the pairs around
them are worked on further. Several rounds are gone through on the words alone that hold a pair of any of them. (An inverted index from pairs to places took ten times the bytes, and carrying it from
round to round cost more than finding the places.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SCHEMA = "part int, tok binary, freq binary"
TYPES = pa.schema([("part", pa.int32()), ("tok", pa.binary()), ("freq", pa.binary())])
#: Merges ``(left, right, new)`` of pairs that do not overlap one another.
Run = list[tuple[int, int, int]]
#: Stands between words; ids stay below the surrogate range and so below it.
MARK = np.uint16(0xFFFF)


def key_of(left, right):
    """Both ids in one number, ordered by the left and then the right id."""
    return left << 32 | right


def summed(keys: np.ndarray, deltas: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One sum per distinct key."""
    if not len(keys):
        return keys, deltas
    by = np.argsort(keys, kind="stable")
    keys, deltas = keys[by], deltas[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(deltas, first)


class WordPart:
    def __init__(self, tok: np.ndarray, freq: np.ndarray) -> None:
        self.tok, self.freq = tok, freq

    @classmethod
    def of_words(cls, tokens: np.ndarray, lengths: np.ndarray, freqs: np.ndarray) -> WordPart:
        """From the tokens of all words one after the other."""
        starts = np.cumsum(lengths) - lengths
        return cls(np.append(np.insert(tokens.astype(np.uint16), starts, MARK), MARK), freqs.astype(np.int64))

    @classmethod
    def read(cls, row: dict) -> WordPart:
        return cls(np.frombuffer(row["tok"], np.uint16), np.frombuffer(row["freq"], np.int64))

    def write(self) -> dict:
        return {"tok": self.tok.tobytes(), "freq": self.freq.tobytes()}

    def weights(self, places: np.ndarray) -> np.ndarray:
        """How often the word around each place occurs."""
        return self.freq[np.searchsorted(np.flatnonzero(self.tok == MARK), places) - 1]

    def keys_at(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places that start a pair, and its key."""
        left, right = self.tok[starts], self.tok[starts + 1]
        there = (left != MARK) & (right != MARK)
        return starts[there], key_of(left[there].astype(np.int64), right[there].astype(np.int64))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Every pair and how often it occurs."""
        starts, keys = self.keys_at(np.arange(len(self.tok) - 1))
        return summed(keys, self.weights(starts))

    def touched(self, runs: list[Run]) -> np.ndarray:
        """Which words some of the runs may change.

        The first merge in a word joins two tokens that the word has before all runs, so a word without any pair of any
        run stays as it is.
        """
        found, _ = self.starts_of(np.unique([key_of(a, b) for run in runs for a, b, _ in run]))
        words = np.zeros(len(self.freq), np.bool_)
        words[np.searchsorted(np.flatnonzero(self.tok == MARK), found) - 1] = True
        return words

    def only(self, words: np.ndarray) -> WordPart:
        """The chosen words, copied."""
        marks = np.flatnonzero(self.tok == MARK)
        starts, sizes = marks[:-1][words], np.diff(marks)[words]
        tokens = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return WordPart(np.append(self.tok[tokens], MARK), self.freq[words])

    def joined(self, other: WordPart) -> WordPart:
        return WordPart(np.concatenate([self.tok[:-1], other.tok]), np.concatenate([self.freq, other.freq]))

    def starts_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where one of the pairs starts, ascending, and its place in ``keys``, which are sorted."""
        left, right = np.zeros(1 << 16, np.bool_), np.zeros(1 << 16, np.bool_)
        left[keys >> 32], right[keys & 0xFFFF] = True, True
        at = np.flatnonzero(left[self.tok[:-1]])
        at, found = self.keys_at(at[right[self.tok[at + 1]]])
        which = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        there = keys[which] == found
        return at[there], which[there]

    def places_of(self, run: Run) -> tuple[np.ndarray, np.ndarray]:
        """Where a pair of the run starts, ascending, and which; no two places overlap."""
        keys = np.array([key_of(a, b) for a, b, _ in run], np.int64)
        by = np.argsort(keys)
        at, which = self.starts_of(keys[by])
        which = by[which]
        # A run of one token: every second of the places that follow one another.
        first = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(which) != 0)])
        since = np.arange(len(at)) - np.maximum.accumulate(np.where(first[:len(at)], np.arange(len(at)), 0))
        return at[since % 2 == 0], which[since % 2 == 0]

    def merge(self, run: Run, count: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Merge the pairs of a run at once; where counted, what each pair around them loses or gains."""
        at, which = self.places_of(run)
        lost = won = weight = more = np.empty(0, np.int64)
        if len(at):
            if count:
                starts, lost = self.keys_at(np.unique(np.concatenate([at - 1, at, at + 1])))
                weight = self.weights(starts)
            tok, stay = self.tok.copy(), np.ones(len(self.tok), np.bool_)
            tok[at], stay[at + 1] = np.array([z for _, _, z in run], np.uint16)[which], False
            self.tok = tok[stay]
            if count:
                at = at - np.arange(len(at))
                starts, won = self.keys_at(np.unique(np.concatenate([at - 1, at])))
                more = self.weights(starts)
        return summed(np.concatenate([lost, won]), np.concatenate([-weight, more]))

    def drop_whole(self) -> None:
        """Leave out words of a single token."""
        marks = np.flatnonzero(self.tok == MARK)
        done = np.diff(marks) == 2
        stay = np.ones(len(self.tok), np.bool_)
        stay[marks[:-1][done]] = stay[marks[:-1][done] + 1] = False
        self.tok, self.freq = self.tok[stay], self.freq[~done]
