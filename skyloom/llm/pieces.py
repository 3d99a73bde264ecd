"""Operator 11: SentencePiece encoding and decoding that keeps each piece's place in the original bytes.

A model's compiled character map is a double-array trie of byte strings and a list of their replacements. At every
place of a text the longest key that begins there is replaced, else one character stays; white space is joined and
escaped as the model says. All places of a slice of texts walk the trie together, and every normalised byte remembers
where its source began. The library then encodes the normalised text, and the lengths of the pieces lead through that
record back to byte spans of the original text.

Where no piece of a BPE model reaches from a word into the white space behind it, words with the white space before
them are encoded apart, so a worker asks the library once for each word that it remembers. Other models get whole
texts. Texts beyond ``STRETCH`` bytes are worked in stretches that end before a single plain space which no key crosses.

Defined cases: null and empty texts have no pieces (only the end id) and decode to an empty text; a text of any length
is worked whole; repeated rows each give their row; a null doc_id stays null; there are no ties; an empty table gives no
rows. Extra columns are left alone. Models with user-defined symbols or white space behind words are refused.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.text import list_array, slices

#: fixed values: the escaped space, and the kinds of pieces in a model file
SPACE = "▁".encode()
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
BPE = 2

MAX_WORDS, MAX_WORD_BYTES = 1 << 19, 32 << 20  # words that a worker remembers
STRETCH = 1 << 21
DECODED_IDS = 1 << 17  # ids decoded at once
_REACH = 256  # no key of a character map is longer


class CharacterMap:
    """A compiled character map: number of trie bytes, trie units, replacements that end with a zero byte."""

    def __init__(self, blob: bytes):
        size = int(np.frombuffer(blob[:4], "<u4")[0])
        self.units = np.frombuffer(blob[4:4 + size], "<u4")
        self.texts = np.frombuffer(blob[4 + size:], np.uint8)
        zeros = np.flatnonzero(self.texts == 0)
        places = np.arange(len(self.texts))
        self.lengths = zeros[np.minimum(np.searchsorted(zeros, places), len(zeros) - 1)] - places
        other = np.flatnonzero(self.texts != 0x20)
        self.spaces_ahead = other[np.minimum(np.searchsorted(other, places), len(other) - 1)] - places

    def _child(self, nodes: np.ndarray) -> np.ndarray:
        """Where the children of units begin, before the label is mixed in."""
        units = self.units[nodes]
        return ((units >> np.uint32(10)) << ((units & np.uint32(0x200)) >> np.uint32(6))).astype(np.int64)

    def longest(self, data: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, replacement) of the longest key at each of ``starts``; length 0 where there is none."""
        length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        live = np.arange(len(starts))
        base = np.full(len(starts), int(self._child(np.zeros(1, np.int64))[0]), np.int64)
        depth = 0
        while len(live):
            at = starts[live] + depth
            inside = at < limits[live]
            live, base, at = live[inside], base[inside], at[inside]
            label = data[at]
            nodes = base ^ label
            units = self.units[nodes]
            same = (units & np.uint32(0x800000FF)) == label
            live, nodes, units = live[same], nodes[same], units[same]
            base = nodes ^ self._child(nodes)
            depth += 1
            ends = (units >> np.uint32(8)) & np.uint32(1) == 1
            length[live[ends]] = depth
            value[live[ends]] = self.units[base[ends]] & np.uint32(0x7FFFFFFF)
        return length, value


class Normalizer:
    """The normalisation of a model file, with the source of every byte."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def crossed(self, data: np.ndarray, place: int) -> bool:
        """Whether a key that begins shortly before ``place`` reaches beyond it."""
        if self.map is None:
            return False
        starts = np.arange(max(place - _REACH, 0), place)
        length, _ = self.map.longest(data, starts, np.full(len(starts), len(data)))
        return bool((starts + length > place).any())

    def _elements(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(buffer, start, source, size, leading spaces) of what is read from the texts, one longest prefix after the other."""
        start = np.flatnonzero((data & 0xC0) != 0x80)
        size = np.diff(np.append(start, len(data)))
        if self.map is None:
            return np.append(data, np.uint8(0x20)), start, start, size, (data[start] == 0x20).astype(np.int64)
        length, value = self.map.longest(data, start, offsets[np.searchsorted(offsets, start, "right")])
        keep, free = np.ones(len(start), bool), 0
        for i in np.flatnonzero(length > size).tolist():
            if start[i] >= free:
                free = int(start[i] + length[i])
                keep[i + 1:np.searchsorted(start, free)] = False
        hit = length > 0
        lead = np.where(hit, self.map.spaces_ahead[value], data[start] == 0x20)
        source = np.where(hit, len(data) + value, start)
        size = np.where(hit, self.map.lengths[value], size)
        return np.concatenate([data, self.map.texts, [np.uint8(0x20)]]), start[keep], source[keep], size[keep], lead[keep]

    def __call__(self, data: np.ndarray, offsets: np.ndarray, opens: np.ndarray, closes: np.ndarray):
        """(bytes, bounds, source of each byte in its text, end of each text's source).

        ``opens`` and ``closes`` tell which stretches are the beginning or the end of a text.
        """
        n = len(offsets) - 1
        buffer, start, source, size, lead = self._elements(data, offsets)
        first = np.searchsorted(start, offsets)
        owner = np.repeat(np.arange(n), np.diff(first))
        skipped = offsets[:-1].copy()  # where the prefix of a text stands: behind leading white space
        filled = first[1:] > first[:-1]
        if self.squeeze:
            single = (size == 1) & (lead == 1)
            other = np.append(np.flatnonzero(~single), len(start))
            head = other[np.searchsorted(other, first[:-1])]
            blank = head >= first[1:]
            skipped = np.where(blank, offsets[1:], np.append(start, len(data))[head])
            filled &= ~(blank & opens)
            full = np.where(size > 0, np.arange(len(start)), -1)
            before = np.append(-1, np.maximum.accumulate(full)[:-1]) if len(full) else full
            inside = before >= first[:-1][owner]
            behind = np.where(inside, buffer[np.maximum(source + size - 1, 0)][before] == 0x20, opens[owner])
            cut = np.where(behind, np.minimum(lead, size), 0)
            source, size = source + cut, size - cut
        if self.prefix:
            where = np.flatnonzero(filled & opens)
            at = first[:-1][where]
            start, source, size, owner = (np.insert(x, at, y) for x, y in (
                (start, skipped[where]), (source, len(buffer) - 1), (size, 1), (owner, where)))
        upto = np.cumsum(size)
        out = buffer[np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(source - (upto - size), size)]
        sources, owners = np.repeat(start - offsets[:-1][owner], size), np.repeat(owner, size)
        if self.escape:
            space = out == 0x20
            width = np.where(space, len(SPACE), 1)
            places = (np.cumsum(width) - width)[space]
            out, sources, owners = (np.repeat(x, width) for x in (out, sources, owners))
            for i, byte in enumerate(SPACE):
                out[places + i] = byte
        bounds = np.searchsorted(owners, np.arange(n + 1))
        ends = np.diff(offsets)
        if self.squeeze:
            mark = np.frombuffer(SPACE if self.escape else b" ", np.uint8)
            stop, open_ends = bounds[1:].copy(), np.flatnonzero(closes)
            while len(open_ends):
                long = stop[open_ends] - bounds[:-1][open_ends] >= len(mark)
                open_ends = open_ends[long]
                tail = out[stop[open_ends][:, None] + np.arange(-len(mark), 0)] == mark
                open_ends = open_ends[tail.all(axis=1)]
                stop[open_ends] -= len(mark)
                ends[open_ends] = sources[stop[open_ends]]
            keep = np.arange(len(out)) < stop[owners]
            out, sources, bounds = out[keep], sources[keep], np.append(0, np.cumsum(stop - bounds[:-1]))
        return out, bounds, sources, ends


class Pieces:
    """Encodes and decodes as the library does with the same model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        model = model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.treat_whitespace_as_suffix or any(p.type == USER_DEFINED for p in model.pieces):
            raise ValueError("models with user-defined symbols or white space behind words are not supported")
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.end_id = self.decoder.eos_id()
        self.normalize = Normalizer(model.normalizer_spec)
        # white space first, then other characters: words of such pieces are encoded apart
        mark = SPACE.decode()
        self.by_word = (model.trainer_spec.model_type == BPE and model.trainer_spec.byte_fallback and self.normalize.prefix and self.normalize.escape
                        and not any(mark in p.piece.lstrip(mark) for p in model.pieces if p.type == NORMAL))
        self.opens_word = np.array([p.type == NORMAL and p.piece.startswith(mark) for p in model.pieces])
        self.lengths = np.array([{NORMAL: len(p.piece.encode()), BYTE: 1}.get(p.type, 0) for p in model.pieces], np.int64)
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), -1)
        spec = model.normalizer_spec
        spec.Clear()
        spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = "identity", False, False, False
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.index_bytes = 0
        self.at, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.widths = np.empty(0, np.int32), np.empty(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        found = self.library.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((x for one in found for x in one), np.int32, int(sizes.sum()))
        widths = self.lengths[ids]
        if (ids == self.unknown).any():  # an unknown piece is as long as what it stands for
            surfaces = self.library.encode(texts, out_type=str, num_threads=1)
            widths = np.fromiter((len(p.encode()) for one in surfaces for p in one), np.int64, len(ids))
        for i, word in enumerate(words, len(self.index)):
            self.index[word] = i
            self.index_bytes += len(word)
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids, self.widths = np.concatenate([self.ids, ids]), np.concatenate([self.widths, widths])

    def _words(self, out: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where words begin: at white space behind something else, and at every text."""
        begins = bounds[:-1][bounds[1:] > bounds[:-1]]
        if not self.by_word:
            return begins
        marks = np.flatnonzero(out == SPACE[0])
        marks = marks[marks + 2 < len(out)]
        marks = marks[(out[marks + 1] == SPACE[1]) & (out[marks + 2] == SPACE[2])]
        again = np.append(False, np.diff(marks) == len(SPACE)) if len(marks) else np.empty(0, bool)
        return np.unique(np.concatenate([begins, marks[~again]]))

    def _encode(self, data: np.ndarray, offsets: np.ndarray, opens: np.ndarray, closes: np.ndarray):
        """(ids, bounds, begins, ends) of stretches; spans are bytes of the stretch."""
        out, bounds, sources, stops = self.normalize(data, offsets, opens, closes)
        starts = self._words(out, bounds)
        raw = out.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), np.append(starts[1:], len(out)).tolist())]
        if len(self.index) > MAX_WORDS or self.index_bytes > MAX_WORD_BYTES:
            self.forget()
        new = list(dict.fromkeys(w for w in words if w not in self.index))
        if new:
            self._learn(new)
        which = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        counts = self.sizes[which]
        total = np.cumsum(counts)
        at = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(self.at[which] - (total - counts), counts)
        ids, widths = self.ids[at], self.widths[at]
        upto = np.cumsum(widths)
        token_bounds = np.append(0, total)[np.searchsorted(starts, bounds)]
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(token_bounds))
        ahead = upto == bounds[1:][owner]
        ends = np.where(ahead, stops[owner], np.append(sources, 0)[np.where(ahead, len(sources), upto)])
        return ids, token_bounds, sources[upto - widths], ends

    def _stretches(self, data: np.ndarray, a: int, b: int) -> list[int]:
        """Places inside the long text ``data[a:b]`` where it may be cut."""
        text = data[a:b]
        plain = np.zeros(256, bool)
        plain[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
        safe = np.flatnonzero((text[1:-1] == 32) & plain[text[:-2]] & plain[text[2:]]) + 1
        cuts, at = [], 0
        while (at := int(np.searchsorted(safe, (cuts[-1] if cuts else 0) + STRETCH))) < len(safe):
            while at < len(safe) and self.normalize.crossed(text[:safe[at] + _REACH], int(safe[at])):
                at += 1
            if at == len(safe):
                break
            cuts.append(int(safe[at]))
        return [a + c for c in cuts]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """(ids, bounds, begins, ends) of the texts ``data[offsets[i]:offsets[i+1]]``; spans are bytes of the text."""
        n = len(offsets) - 1
        if len(data) <= 2 * STRETCH or not self.by_word:
            return self._encode(data, offsets, np.ones(n, bool), np.ones(n, bool))
        cuts = [c for i in np.flatnonzero(np.diff(offsets) > STRETCH).tolist() for c in self._stretches(data, int(offsets[i]), int(offsets[i + 1]))]
        edges = np.sort(np.concatenate([offsets, np.array(cuts, np.int64)]))
        opens, closes = np.ones(len(edges) - 1, bool), np.ones(len(edges) - 1, bool)
        inner = np.searchsorted(edges, np.array(cuts, np.int64))
        opens[inner], closes[inner - 1] = False, False
        parts, counts, a = [], [], 0
        while a < len(edges) - 1:
            b = max(a + 1, int(np.searchsorted(edges, edges[a] + STRETCH, "right")) - 1)
            ids, bounds, begins, ends = self._encode(data[edges[a]:edges[b]], edges[a:b + 1] - edges[a], opens[a:b], closes[a:b])
            text = np.searchsorted(offsets, edges[a:b], "right") - 1
            shift = np.repeat(edges[a:b] - offsets[np.minimum(text, n - 1)], np.diff(bounds))
            parts.append((ids, begins + shift, ends + shift))
            counts.append(np.diff(bounds))
            a = b
        heads = np.arange(n) + np.searchsorted(np.array(cuts, np.int64), offsets[:-1])
        ids, begins, ends = (np.concatenate(x) for x in zip(*parts))
        return ids, np.append(0, np.cumsum(np.add.reduceat(np.concatenate(counts), heads))), begins, ends

    def decode(self, ids: np.ndarray) -> str:
        """The library's text for ``ids``; long lists are decoded in stretches that begin with a word."""
        if len(ids) <= DECODED_IDS or not (self.by_word and not self.normalize.squeeze):
            return self.decoder.decode(ids.tolist())
        opens = np.flatnonzero(self.opens_word[ids])
        at = np.unique(opens[np.minimum(np.searchsorted(opens, np.arange(DECODED_IDS, len(ids), DECODED_IDS)), len(opens) - 1)]) if len(opens) else opens
        cuts = [0, *at[at > 0].tolist(), len(ids)]
        # the library takes one space off the first word of a list
        return " ".join(self.decoder.decode(ids[a:b].tolist()) for a, b in zip(cuts, cuts[1:]))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encoded_slices(texts: pa.Array, model: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(from row, to row, ids, bounds, begins, ends) with the end id behind each text, for runs of rows."""
    coder = pieces(model)
    for row, end, data, offsets in slices(texts):
        ids, bounds, begins, ends = coder.encode(data, offsets)
        stop = np.diff(offsets)
        ids, begins, ends = (np.insert(x, bounds[1:], y) for x, y in ((ids, coder.end_id), (begins, stop), (ends, stop)))
        yield row, end, ids, bounds + np.arange(len(bounds)), begins, ends


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (the end id last), begins, ends (the pieces' bytes in the text) for every row of ``docs`` (doc_id, text)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, ids, bounds, begins, ends in encoded_slices(batch.column(1), model):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, end - row), list_array(ids, bounds, pa.int32()),
                    list_array(begins, bounds, pa.int64()), list_array(ends, bounds, pa.int64()),
                ], names=["doc_id", "ids", "begins", "ends"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>, begins array<long>, ends array<long>")


def decoded(tokens: DataFrame, model: str) -> DataFrame:
    """doc_id, text for every row of ``tokens`` (doc_id, ids)."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        coder = pieces(model)
        return pa.array([None if one is None else coder.decode(np.array(one, np.int64)) for one in lists.to_pylist()], pa.string())

    return tokens.select("doc_id", decode("ids").alias("text"))


def round_trips(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32 for every row of ``docs`` (doc_id, text).

    ``spans_crc32``: unsigned crc32 of all (begin, end) as little-endian 64-bit integers. Ids and texts are digested
    where they are made and do not travel.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in batches:
            for row, end, ids, bounds, begins, ends in encoded_slices(batch.column(1), model):
                lists = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(ids).cast(pa.large_string()))
                lines = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))
                spans = np.ascontiguousarray(np.stack([begins, ends], axis=1).astype("<i8"))
                cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, end - row), pa.array(np.diff(bounds), pa.int64()),
                    pa.array([hashlib.sha256(line.as_buffer()).hexdigest() for line in lines], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(ids[a:b]).encode()).hexdigest() for a, b in cuts], pa.string()),
                    pa.array([zlib.crc32(spans[a:b]) for a, b in cuts], pa.int64()),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")
