"""Token ids of whole texts by a public byte-level BPE tokenizer.

The tokenizer cuts a text into pieces (a word with its space, a number, a run of signs or of white space)
and encodes each piece by itself. Most pieces are repeats, so the cuts are made on whole slices at once,
and the library encodes only pieces that a worker has not met lately. Pieces are told apart by two independent
64-bit hashes; where one agrees and the other does not, the slice goes to the library as it is. Character classes are
asked of the library's own cutter and ids of its model, which takes a piece in the byte-level alphabet, so the ids equal
``Tokenizer.encode``; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np

from skyloom.llm.text import mix64, placed, second

MAX_CACHED = 1 << 18  # pieces a worker remembers: some 45 bytes each, and as many again while new ones are put in
STRETCH = 1 << 17  # up to twice as many bytes are worked at once: each takes some sixty more meanwhile
LOW_CHARS = 0x3000  # characters with their hashed values at hand
_LETTER, _NUMBER, _SPACE, _OTHER, _UNKNOWN = 1, 2, 3, 0, 9
#: fixed values: the endings that the cutter takes off with an apostrophe
_ONE_LETTER = "stmd"
_TWO_LETTERS = ("re", "ve", "ll")
#: fixed values: the byte-level alphabet; printable bytes of Latin-1 stand for themselves, the others follow from 256 on
_SELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = np.empty(256, np.uint16)
_ALPHABET[_SELF] = _SELF
_ALPHABET[np.setdiff1d(np.arange(256), _SELF)] = np.arange(256, 512 - len(_SELF))


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.classes = np.full(0x110000, _UNKNOWN, np.uint8)
        self.values = self._hashed(np.arange(LOW_CHARS))
        self.forget()

    def forget(self) -> None:
        self.keys, self.checks, self.at = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.uint32)

    def _class_of(self, char: str) -> int:
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for probe, kind in (("a", _LETTER), ("1", _NUMBER), ("!", _OTHER)):
            if len(cut(probe + char)) == 1:
                return kind
        return _SPACE

    def _classes(self, chars: np.ndarray) -> np.ndarray:
        kinds = self.classes[chars]
        if (kinds == _UNKNOWN).any():
            for code in np.unique(chars[kinds == _UNKNOWN]).tolist():
                self.classes[code] = self._class_of(chr(code))
            kinds = self.classes[chars]
        return kinds

    @staticmethod
    def _hashed(chars: np.ndarray) -> np.ndarray:
        return mix64(chars.astype(np.uint64) + np.uint64(77))

    def _values(self, chars: np.ndarray) -> np.ndarray:
        values = self.values[np.minimum(chars, LOW_CHARS - 1)]
        high = np.flatnonzero(chars >= LOW_CHARS)
        values[high] = self._hashed(chars[high])
        return values

    def cuts(self, chars: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Where pieces start. ``firsts``: positions of the first characters of the texts."""
        n = len(chars)
        kind = self._classes(chars)
        begin = np.ones(n, bool)
        begin[1:] = kind[1:] != kind[:-1]
        begin[firsts] = True
        fresh = np.zeros(n + 1, bool)  # a text begins here
        fresh[firsts] = True
        fresh[n] = True
        space = kind == _SPACE
        # the last white space before something else is cut off; a plain space goes with what follows
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~fresh[1:n]
        begin |= last
        joined = np.zeros(n, bool)
        joined[1:] = last[:-1] & (chars[:-1] == 32)
        begin &= ~joined
        marks = np.flatnonzero(begin & (chars == 39))
        marks = marks[marks + 1 < n]
        marks = marks[~fresh[marks + 1]]
        if len(marks):
            follow = chars[marks + 1]
            third = chars[np.minimum(marks + 2, n - 1)]
            two = np.zeros(len(marks), bool)
            for pair in _TWO_LETTERS:
                two |= (follow == ord(pair[0])) & (third == ord(pair[1]))
            two &= ~fresh[np.minimum(marks + 2, n)]
            one = np.isin(follow, [ord(x) for x in _ONE_LETTER])
            begin[marks[one | two] + 1] = False
            begin[marks[two & ~one] + 2] = False
            ends = np.where(one, marks + 2, marks + 3)[one | two]
            begin[ends[ends < n]] = True
        return np.flatnonzero(begin)

    def _ask(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of them each piece ``data[starts[i]:ends[i]]`` has), by the library's model."""
        letters = _ALPHABET[data].astype("<u2").tobytes().decode("utf-16-le")
        ids, upto, tokenize = array("I"), array("q", [0]), self.model.tokenize
        for a, b in zip(starts.tolist(), ends.tolist()):
            ids.extend([token.id for token in tokenize(letters[a:b])])
            upto.append(len(ids))
        return np.array(ids, np.uint32), np.diff(np.array(upto, np.int64))

    def _learn(self, keys: np.ndarray, checks: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Put in pieces with sorted ``keys``."""
        place = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, place, len(self.ids) + np.cumsum(sizes) - sizes)
        self.keys, self.checks = np.insert(self.keys, place, keys), np.insert(self.checks, place, checks)
        self.sizes, self.ids = np.insert(self.sizes, place, sizes), np.concatenate([self.ids, flat])

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        leads = (data & 0xC0) != 0x80  # first bytes of characters
        heads = np.concatenate([[0], np.cumsum(leads)])[offsets]
        starts = self.cuts(chars, np.unique(heads[:-1][heads[:-1] < len(chars)]))
        first = np.flatnonzero(leads)[starts]  # first bytes of the pieces
        sizes = np.diff(np.append(starts, len(chars)))
        inside = np.arange(len(chars)) - np.repeat(starts, sizes)
        terms = placed(self._values(chars), inside)
        hashes, checks = (mix64(np.add.reduceat(x, starts) + sizes.astype(np.uint64)) for x in (terms, second(terms)))
        keys, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > MAX_CACHED:
            self.forget()
        at, known = self._find(keys)
        if (checks != checks[where][inverse]).any() or (self.checks[at[known]] != checks[where[known]]).any():
            ids, counts = self._ask(data, first, np.append(first[1:], len(data)))
            return ids, np.append(0, np.cumsum(counts))[np.searchsorted(starts, heads)]
        if not known.all():
            new = where[~known]
            self._learn(keys[~known], checks[new], *self._ask(data, first[new], np.append(first, len(data))[new + 1]))
            at, _ = self._find(keys)
        at = at[inverse]
        lengths = self.sizes[at]
        total = np.cumsum(lengths)
        ids = self.ids[np.arange(int(total[-1])) + np.repeat(self.at[at] - (total - lengths), lengths)]
        return ids, np.append(0, total)[np.searchsorted(starts, heads)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the texts ``data[offsets[i]:offsets[i+1]]``; long texts are worked in stretches."""
        if len(data) <= 2 * STRETCH:
            return self._encode(data, offsets)
        # a piece always ends between a character and a plain space after it
        safe = np.flatnonzero((data[1:] == 32) & (data[:-1] > 32) & (data[:-1] < 127)) + 1
        wanted = np.arange(STRETCH, len(data), STRETCH)
        cuts = safe[np.minimum(np.searchsorted(safe, wanted), len(safe) - 1)] if len(safe) else safe
        edges = np.unique(np.concatenate([offsets, cuts]))
        ids, counts = [], [np.zeros(1, np.int64)]
        groups = np.unique(np.concatenate([[0], np.searchsorted(edges, np.append(cuts, len(data)))]))
        for a, b in zip(groups[:-1].tolist(), groups[1:].tolist()):
            got, bounds = self._encode(data[edges[a]:edges[b]], edges[a:b + 1] - edges[a])
            ids.append(got)
            counts.append(np.diff(bounds))
        totals = np.cumsum(np.concatenate(counts))
        return np.concatenate(ids), totals[np.searchsorted(edges, offsets)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids with ``end_id`` behind them."""
    n = len(bounds) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(bounds))] = ids
    return out, bounds + np.arange(n + 1)
