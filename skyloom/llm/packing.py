"""Operator 4: best-fit packing of token sequences with large-item matching.

A document is its ids and the end id. Only longer ones than ``capacity`` are cut: into full pieces, with the
rest as the first piece. Pieces above a third of the capacity are matched first, at most two to a sequence:
the longest open one goes with the longest that still fits beside it. Smaller pieces follow from the
longest down, each into the smallest gap that holds it, and open new sequences only when none does.

What decides a place is only a piece's length, so the plan is made on the counts per length (at most
``capacity`` numbers, whatever the corpus) in runs of equal sequences, and every piece then looks up its place
by its number among the pieces of its length. Those numbers come from the counts per partition and length;
no group is ever gathered.

Defined cases: null and empty texts are the end id alone; repeated rows are packed as documents of their own;
null ids are carried along; a text of any length is cut into pieces, none is left out; pieces of equal length are
interchangeable; an empty table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.text import slices
from skyloom.llm.tokens import STRETCH, encoder, with_end
from skyloom.session import store

CAPACITY = 1024
END_ID = 2


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and (with_ids) the ids of every piece.

    ``_part`` and ``_nth`` tell the partition and the piece's number among those of its length in there.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1), 2 * STRETCH):
                ids, bounds = with_end(*encoder(tokenizer).encode(data, offsets), end_id)
                sizes = np.diff(bounds)
                n_pieces = -(-sizes // capacity)
                owner = np.repeat(np.arange(end - row), n_pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                first = sizes - (n_pieces - 1) * capacity
                start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[owner], capacity)
                order = np.argsort(length, kind="stable")
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(order)) - np.searchsorted(length[order], length[order])
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                at = bounds[owner] + start
                raw = np.ascontiguousarray(ids.astype("<u4"))
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                columns = [
                    batch.column(0).slice(row, end - row).take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(owner), part, np.int32)), pa.array(nth),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "_part", "_nth"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, _part int, _nth long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, schema + ", ids array<int>" * with_ids)


class _Gaps:
    """Open sequences by the space left: gap -> runs (first sequence, number of sequences)."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def put(self, gap: int, first: int, count: int) -> None:
        if gap <= 0 or count <= 0:
            return
        if gap not in self.runs:
            insort(self.sizes, gap)
            self.runs[gap] = []
        self.runs[gap].append((first, count))

    def smallest(self, need: int) -> tuple[int, int, int] | None:
        """Take the run with the smallest gap of at least ``need``: (gap, first, count)."""
        at = bisect_left(self.sizes, need)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, count = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap]
            del self.sizes[at]
        return gap, first, count


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, from number, first sequence, pieces per sequence, offset) for ``counts`` pieces of each length.

    Piece number ``k`` of its length, ``r`` into its run, goes to sequence ``first + r // per`` at ``offset + (r % per) * length``.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    used = {length: 0 for length in counts}
    left = {length: n for length, n in counts.items() if n > 0}
    large = sorted(x for x in left if 3 * x > capacity)
    gaps, n_sequences = _Gaps(), 0

    def place(length: int, count: int, first: int, per: int, offset: int) -> None:
        runs.append((length, used[length], first, per, offset))
        used[length] += count
        left[length] -= count

    while large:
        longest = large[-1]
        if not left[longest]:
            large.pop()
            continue
        # the longest partner that fits beside it
        at = bisect_left(large, capacity - longest + 1) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        partner = large[at] if at >= 0 else None
        if partner == longest:
            pairs = left[longest] // 2
            if pairs:
                place(longest, 2 * pairs, n_sequences, 2, 0)
                gaps.put(capacity - 2 * longest, n_sequences, pairs)
                n_sequences += pairs
            if left[longest] and len(large) > 1:  # the odd one takes the next shorter partner
                lower = next((x for x in reversed(large[:at]) if left[x]), None)
                if lower is not None:
                    place(longest, 1, n_sequences, 1, 0)
                    place(lower, 1, n_sequences, 1, longest)
                    gaps.put(capacity - longest - lower, n_sequences, 1)
                    n_sequences += 1
                    continue
            partner = None
        if not left[longest]:
            continue
        count = left[longest] if partner is None else min(left[longest], left[partner])
        place(longest, count, n_sequences, 1, 0)
        if partner is not None:
            place(partner, count, n_sequences, 1, longest)
        gaps.put(capacity - longest - (partner or 0), n_sequences, count)
        n_sequences += count
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            gap, first, room = gaps.smallest(length) or (capacity, n_sequences, -(-left[length] // (capacity // length)))
            if first == n_sequences:
                n_sequences += room
            per = gap // length
            full = min(room, left[length] // per)
            if full:
                place(length, full * per, first, per, capacity - gap)
                gaps.put(gap - per * length, first, full)
            rest = min(left[length], per - 1) if full < room else 0
            if rest:
                place(length, rest, first + full, rest, capacity - gap)
                gaps.put(gap - rest * length, first + full, 1)
            gaps.put(gap, first + full + bool(rest), room - full - bool(rest))
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length, _part, _nth and any others; stored) with sequence_id and offset instead of _part and _nth."""
    counts = store(pieces.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n")))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = sorted(plan_packing(totals, capacity))
    table = np.array(runs, np.int64).reshape(-1, 5)
    # one number per (length, piece number), so that one search finds the run
    most = max(totals.values(), default=0) + 1
    keys = table[:, 0] * most + table[:, 1]
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    names = [c for c in pieces.columns if c not in ("_part", "_nth")]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_number"))
            run = np.searchsorted(keys, length * most + number, "right") - 1
            _, start, first, per, offset = table[run].T
            nth = number - start
            found = [pa.array(first + nth // per), pa.array(offset + nth % per * length)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in names] + found, names=[*names, "sequence_id", "offset"])

    numbered = pieces.join(bases, ["length", "_part"]).withColumn("_number", F.col("_nth") + F.col("_base")).select(*names, "_number")
    schema = numbered.drop("_number").schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(look_up, schema)


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of ``docs`` (doc_id, text)."""
    return pack(store(token_pieces(docs, tokenizer, capacity, end_id, with_ids)), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from pieces packed ``with_ids``; a sequence holds at most ``capacity`` pieces."""
    items = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(items, lambda x: x["ids"])).alias("ids"))
