"""Words and hashes of whole texts, column-wise on the bytes of Arrow batches.

A word is a maximal run of characters other than ``\\x20`` and ``\\x09-\\x0D``. All of these are single
bytes in UTF-8 and never part of a longer character, so words are found on bytes. Texts are handled in
slices of about ``SLICE_BYTES``; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
HASHED_BYTES = 1 << 17  # bytes of words hashed at once
_U = np.uint64

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values one to one."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _constants(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


_BYTE_VALUE = _constants(11, 256)
_STEP, _OTHER = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def placed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each value scattered together with its place, so that sums over places hide no arrangement."""
    return mix64(values + (at.astype(np.uint64) + _U(1)) * _STEP)


def second(scattered: np.ndarray) -> np.ndarray:
    """Other terms for a second, independent sum over the same ``placed`` values."""
    return (scattered ^ (scattered >> _U(29))) * _OTHER


@dataclass
class Words:
    """The words of a slice of texts: byte ranges in ``data``; text ``i`` has words ``first[i]:first[i+1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) for runs of rows; null texts count as empty."""
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def lower_case(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _LOWER[data]


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, between: np.ndarray = _IS_SPACE) -> Words:
    """Words of the texts; ``between`` marks the (ASCII) bytes that part them."""
    if lower:
        data = lower_case(data)
    inside = ~between[data]
    starts_here, ends_here = inside.copy(), inside.copy()
    if len(data):
        starts_here[1:] &= ~inside[:-1]
        ends_here[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        starts_here[edges] = inside[edges]
        ends_here[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(starts_here)
    ends = np.flatnonzero(ends_here) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words, pair: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of the bytes of each word; with ``pair`` two independent ones. Long runs are worked in stretches."""
    lengths = words.ends - words.starts
    upto = np.cumsum(lengths)
    out = [np.empty(len(lengths), np.uint64) for _ in range(1 + pair)]
    a = 0
    while a < len(lengths):
        done = int(upto[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(upto, done + HASHED_BYTES, "right")))
        sizes = lengths[a:b]
        before = upto[a:b] - sizes - done
        at = np.arange(int(upto[b - 1]) - done) - np.repeat(before, sizes)
        terms = placed(_BYTE_VALUE[words.data[at + np.repeat(words.starts[a:b], sizes)]], at)
        out[0][a:b] = mix64(np.add.reduceat(terms, before) + sizes.astype(np.uint64))
        if pair:
            out[1][a:b] = mix64(np.add.reduceat(second(terms), before) + sizes.astype(np.uint64))
        a = b
    return (out[0], out[1]) if pair else out[0]


def gram_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of every ``k`` consecutive entries; entry ``i`` stands for ``words[i:i+k]``."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    factor = _constants(100 + seed, 1)[0] | _U(1)
    # hashes of runs of 1, 2, 4, ... entries, scattered at every step, put together by the bits of k
    run, size, total, done = words, 1, None, 0
    while True:
        if k & size:
            part = run[done:done + len(words) - k + 1]
            total = mix64(part + _U(k) if total is None else total * factor + part)
            done += size
        if done == k:
            return total
        run = mix64(run[:-size] * factor + run[size:])
        size *= 2


def shingle_sets(words: Words, hashes: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds): the sorted distinct ``k``-word shingles of each text.

    A text of fewer words has its whole sequence as the only shingle; one without words has none.
    """
    counts = words.counts
    n = len(counts)
    grams = gram_hashes(hashes, k)
    owner_all = words.texts_of_words()
    whole = np.zeros(len(hashes), bool)
    if len(grams):
        whole[:len(grams)] = owner_all[:len(grams)] == owner_all[k - 1:]
    at = np.flatnonzero(whole)
    values, owner = grams[at], owner_all[at]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for size in range(1, k):
            pick = np.flatnonzero(counts[short] == size)
            if len(pick):
                lines = hashes[words.first[short[pick]][:, None] + np.arange(size)]
                value = np.zeros(len(pick), np.uint64)
                for column in lines.T:
                    value = mix64(value * _U(0x9E3779B97F4A7C15) + column + _U(size))
                extra[pick] = value
        values, owner = np.concatenate([values, extra]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(n + 1))


def sequence_hashes(words: Words, hashes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each text's whole word sequence, from the two hashes of its words."""
    counts = words.counts
    at = np.arange(len(hashes)) - np.repeat(words.first[:-1], counts)
    full, out = np.flatnonzero(counts), []
    for values, seed in ((hashes, 201), (others, 202)):
        add = _constants(seed, 1)[0]
        total = np.zeros(len(counts), np.uint64)
        if len(full):
            total[full] = np.add.reduceat(placed(values ^ add, at), words.first[:-1][full])
        out.append(mix64(total + counts.astype(np.uint64) * add))
    return out[0], out[1]


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def blocks(batches: Iterator[pa.RecordBatch], key: str, weight, limit: int) -> Iterator[pa.Table]:
    """Tables of whole key groups from batches sorted by ``key``.

    Groups are put together until ``weight(batch)`` adds up to ``limit``; a group is never split.
    """
    held: list[pa.RecordBatch] = []
    heavy = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if held:
            last = held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py()
            differs = np.flatnonzero(keys != last)
            cut = int(differs[0]) if len(differs) else batch.num_rows
        else:
            cut = 0
        if cut < batch.num_rows and held and heavy >= limit:
            if cut:
                held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held, heavy, batch = [], 0, batch.slice(cut)
        held.append(batch)
        heavy += weight(batch)
        while heavy >= limit:  # a single batch may hold many groups: let go of all but the last
            keys = held[-1].column(held[-1].schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            change = np.flatnonzero(keys != keys[-1])
            if not len(change):
                break
            cut = int(change[-1]) + 1
            tail = held[-1].slice(cut)
            held[-1] = held[-1].slice(0, cut)
            yield pa.Table.from_batches(held)
            held, heavy = [tail], weight(tail)
            if tail.num_rows == 0 or heavy >= limit:
                break
    if held:
        yield pa.Table.from_batches(held)
