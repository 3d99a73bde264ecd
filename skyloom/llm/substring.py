"""Operator 10: repeated passages across documents, by super-k-mers.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash of the ``GRAM``-word runs
inside it; equal windows have equal minimisers. Consecutive windows with the same minimiser, up to ``RUN`` of
them, travel as one packed string to that minimiser's bucket, where sorting the windows finds the smallest doc_id
of each sequence. These steps keep the traffic low without leaving a window out:

* copies (equal word sequences) are settled by their smallest doc_id, only that one is searched;
* only minimisers that occur in two documents can hold a repeated window;
* equal strings are one class: the windows of a string that a smaller doc_id has too are all repeated, so only the
  string of the smallest doc_id travels, and only to a minimiser with several classes;
* a bucket is dealt into as many parts as its bytes ask for. Windows are sorted in their part; those of a bucket of
  several parts are then merged by a combined grouping of their hashes, so that no task holds a whole bucket.

Words, windows and strings are told apart by pairs of independent 64-bit hashes.

Defined cases: null and empty texts have no words and lose none; a null doc_id counts as larger than every
other, two of them as equal; rows that share a doc_id never remove from each other; repeats inside one
document stay; repeated rows are searched once and each gets the result; a text of any length is worked whole, its
strings stay short; ties cannot occur, equal windows go to the smallest doc_id; an empty table gives no rows. Extra
columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.bits import maybe_in
from skyloom.llm.text import Words, blocks, find_words, gram_hashes, list_array, mix64, sequence_hashes, slices, word_hashes
from skyloom.session import store

WINDOW = 50
GRAM = 12
RUN = WINDOW  # windows in a string at most: its first and its last window then hold all of its words
PART_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
SENT_BYTES = 16 << 20  # strings put together at once
_LAST = (1 << 63) - 1
_ROW = ["at", "text_key"]


def joined_words(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): the kept words of each text joined by single spaces."""
    starts, lengths = words.starts[keep], (words.ends - words.starts)[keep] + 1
    owner = words.texts_of_words()[keep]
    before = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    at = np.arange(total) - np.repeat(before - starts, lengths)
    last = before + lengths - 1
    at[last] = 0
    out = words.data[at] if total else np.empty(0, np.uint8)
    out[last] = 32
    final = np.ones(len(owner), bool)
    if len(owner):
        final[:-1] = owner[1:] != owner[:-1]
    whole = np.ones(total, bool)
    whole[last[final]] = False
    size = np.bincount(owner, weights=lengths, minlength=len(words.first) - 1).astype(np.int64)
    size -= size > 0
    return out[whole], np.concatenate([[0], np.cumsum(size)])


def text_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    parts = [pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.StringArray.from_buffers(len(offsets) - 1, *parts)


def window_minimisers(hashes: np.ndarray) -> np.ndarray:
    """Smallest ``GRAM``-word hash inside each window; entry ``i`` is the window that starts at word ``i``."""
    grams = gram_hashes(hashes, GRAM, 3)
    span = WINDOW - GRAM + 1
    if len(grams) < span:
        return np.empty(0, np.uint64)
    size = 1
    while size * 2 <= span:
        grams = np.minimum(grams[:-size], grams[size:])
        size *= 2
    rest = span - size
    return np.minimum(grams[:-rest], grams[rest:]) if rest else grams


def window_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the window that starts at each word (the last ones reach into the next text)."""
    hashes, others = word_hashes(words, pair=True)
    return gram_hashes(hashes, WINDOW, 4), gram_hashes(others, WINDOW, 5)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in slices(batch.column(2)):
            words = find_words(data, offsets)
            hashes, others = word_hashes(words, pair=True)
            h1, h2 = sequence_hashes(words, hashes, others)
            owner = words.texts_of_words()
            minima = window_minimisers(hashes)
            at = np.flatnonzero(owner[:len(minima)] == owner[WINDOW - 1:]) if len(minima) else np.empty(0, np.int64)
            new = np.ones(len(at), bool)
            if len(at):
                new[1:] = (minima[at][1:] != minima[at][:-1]) | (at[1:] != at[:-1] + 1) | (owner[at][1:] != owner[at][:-1])
                heads = np.flatnonzero(new)
                new |= (np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))) % RUN == 0
            first = at[new]
            counts = np.diff(np.append(np.flatnonzero(new), len(at)))
            w1, w2 = gram_hashes(hashes, WINDOW, 4), gram_hashes(others, WINDOW, 5)
            last = first + counts - 1
            s1, s2 = (mix64(mix64(w[first] + counts.astype(np.uint64)) + w[last]) if len(first) else np.empty(0, np.uint64) for w in (w1, w2))
            bounds = np.searchsorted(owner[first], np.arange(end - row + 1))
            lengths = words.ends[last + WINDOW - 1] - words.starts[first]
            joined = text_array(*joined_words(words, np.ones(len(words.starts), bool)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row), pa.array(words.counts, pa.int64()),
                pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), joined,
                list_array((first - words.first[owner[first]]).astype(np.int32), bounds, pa.int32()),
                list_array(counts.astype(np.int32), bounds, pa.int32()), list_array(lengths.astype(np.int32), bounds, pa.int32()),
                *[list_array(x.view(np.int64), bounds, pa.int64()) for x in (minima[first], s1, s2)],
            ], names=["at", "text_key", "n_words", "h1", "h2", "joined", "starts", "counts", "lengths", "minima", "s1", "s2"])


def _identified(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("at"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _scanned(docs: DataFrame) -> DataFrame:
    """at (the doc_id), text_key, n_words, h1, h2, words_sha256 and the super-k-mers of every row."""
    found = _identified(docs).mapInArrow(_scan, "at long, text_key long, n_words long, h1 long, h2 long, joined string, "
                                                "starts array<int>, counts array<int>, lengths array<int>, minima array<long>, s1 array<long>, s2 array<long>")
    return found.withColumn("words_sha256", F.sha2("joined", 256)).drop("joined")


_SENT = "key long, part int, parts int, s1 long, s2 long, at long, words string"
_SETTLED = "s1 long, s2 long, at long, first int, count int, w1 long, w2 long"


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the wanted super-k-mers out of the texts. Rows: at, text_key, text, wanted, equal rows side by side."""
    done = None
    for batch in batches:
        rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        new = [r != before for r, before in zip(rows, [done, *rows])]
        done = rows[-1] if rows else done
        batch = batch.filter(pa.array(new, pa.bool_()))
        for row, end, data, offsets in slices(batch.column(2)):
            words = find_words(data, offsets)
            wanted = batch.column(3).slice(row, end - row)
            owner = np.repeat(np.arange(end - row), wanted.value_lengths().to_numpy())
            fields = wanted.flatten()
            start, count = (fields.field(i).to_numpy() for i in range(2))
            first = words.first[owner] + start
            pieces, lengths = words.starts[first], words.ends[first + count + WINDOW - 2] - words.starts[first]
            ids = batch.column(0).slice(row, end - row).to_numpy()[owner]
            turn = (np.cumsum(lengths) - lengths) // SENT_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(lengths)]
            for a, b in zip(cuts, cuts[1:]):
                to = np.cumsum(lengths[a:b])
                at = np.arange(int(lengths[a:b].sum())) - np.repeat(to - lengths[a:b] - pieces[a:b], lengths[a:b])
                yield pa.RecordBatch.from_arrays(
                    [*(fields.field(i).slice(a, b - a) for i in range(2, 7)), pa.array(ids[a:b]), text_array(data[at], np.append(0, to))],
                    names=["key", "part", "parts", "s1", "s2", "at", "words"])


def _runs(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first entry, length) of the runs of set flags under one owner."""
    hit = np.flatnonzero(flags)
    begins = np.ones(len(hit), bool)
    begins[1:] = (hit[1:] != hit[:-1] + 1) | (owner[hit][1:] != owner[hit][:-1])
    heads = np.flatnonzero(begins)
    return hit[heads], np.diff(np.append(heads, len(hit)))


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows of the strings of whole buckets, and single windows of buckets in several parts."""
    for table in blocks(batches, "bucket", lambda b: b.column("words").nbytes, BLOCK_BYTES):
        at, s1, s2, bucket, parts = (table.column(c).to_numpy() for c in ("at", "s1", "s2", "bucket", "parts"))
        owners, places, first, second = [], [], [], []
        before = 0
        for chunk in table.column("words").chunks:
            for row, _, data, offsets in slices(chunk):
                words = find_words(data, offsets)
                owner = words.texts_of_words()
                w1, w2 = window_hashes(words)
                start = np.flatnonzero(owner[:len(w1)] == owner[WINDOW - 1:]) if len(w1) else np.empty(0, np.int64)
                owners.append(owner[start] + row + before)
                places.append(start - words.first[owner[start]])
                first.append(w1[start])
                second.append(w2[start])
            before += len(chunk)
        owner, place, w1, w2 = (np.concatenate(x) for x in (owners, places, first, second))
        if not len(owner):
            continue
        order = np.lexsort((w2, w1, bucket[owner]))
        new = np.ones(len(order), bool)
        new[1:] = False
        for x in (w1, w2, bucket[owner]):
            new[1:] |= x[order][1:] != x[order][:-1]
        groups = np.flatnonzero(new)
        smallest = np.repeat(np.minimum.reduceat(at[owner[order]], groups), np.diff(np.append(groups, len(order))))
        gone = np.zeros(len(order), bool)
        gone[order] = at[owner[order]] > smallest
        whole = parts[owner] == 1
        heads, counts = _runs(gone & whole, owner)
        open_at = np.flatnonzero(~whole)
        mine = np.concatenate([owner[heads], owner[open_at]])
        none = np.ones(len(mine), bool)
        none[len(heads):] = False
        both = [np.concatenate([w[heads], w[open_at]]).view(np.int64) for w in (w1, w2)]
        yield pa.RecordBatch.from_arrays([
            pa.array(s1[mine]), pa.array(s2[mine]), pa.array(at[mine]), pa.array(np.concatenate([place[heads], place[open_at]]).astype(np.int32)),
            pa.array(np.concatenate([counts, np.ones(len(open_at), np.int64)]).astype(np.int32)), *[pa.array(w, mask=none) for w in both],
        ], names=["s1", "s2", "at", "first", "count", "w1", "w2"])


# the joins of texts are sort-merge joins at every size: their other sides grow with the documents


def _row_hash() -> Column:
    return F.xxhash64("at", "text_key")


def repeated_spans(docs: DataFrame, scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies, spans): rows whose whole text has a smaller copy, and runs of removed windows of the others.

    copies: at, text_key. spans: at, text_key, spans (array of first window and number of windows).
    """
    long_enough = scanned.filter(F.col("n_words") >= WINDOW)
    classes = long_enough.groupBy("h1", "h2").agg(F.min("at").alias("first"))
    settled = store(long_enough.select(*_ROW, "h1", "h2").join(classes, ["h1", "h2"]).select(*_ROW, (F.col("at") > F.col("first")).alias("copy")).distinct())
    rows = long_enough.join(settled.filter("not copy").drop("copy"), _ROW, "left_semi")
    grams = rows.select(*_ROW, F.explode(F.arrays_zip("starts", "counts", "lengths", "minima", "s1", "s2")).alias("s"))
    grams = grams.select(*_ROW, F.col("s.starts").alias("start"), F.col("s.counts").alias("count"), F.col("s.lengths").alias("length"),
                         F.col("s.minima").alias("key"), "s.s1", "s.s2")
    shared = store(grams.groupBy("key").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).filter("lo < hi").select("key"))
    members = store(grams.filter(maybe_in(shared, F.xxhash64("key"), F.xxhash64("key"))).join(shared.hint("merge"), "key"))
    # equal strings: the smallest doc_id stands for all of them
    strings = store(members.groupBy("key", "s1", "s2").agg(F.min(F.struct("at", "text_key", "start", "count", "length")).alias("rep")).select("key", "s1", "s2", "rep.*"))
    buckets = strings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.sum("length") / PART_BYTES).cast("int").alias("parts")).filter("n > 1")
    part = F.pmod("s1", "parts").cast("int").alias("part")
    wanted = strings.join(buckets, "key").select(*_ROW, F.struct("start", "count", "key", part, "parts", "s1", "s2").alias("w"))
    wanted = store(wanted.groupBy(*_ROW).agg(F.collect_list("w").alias("wanted")))
    texts = _identified(docs).filter(maybe_in(wanted, _row_hash(), _row_hash()))
    sent = texts.join(wanted.hint("merge"), _ROW).select(*_ROW, "text", "wanted").mapInArrow(_send, _SENT)
    dealt = sent.withColumn("bucket", F.xxhash64("key", "part")).repartition("bucket").sortWithinPartitions("bucket")
    found = store(dealt.mapInArrow(_settle, _SETTLED))
    # windows of buckets in several parts meet here
    loose = found.filter("w1 is not null")
    lowest = loose.groupBy("w1", "w2").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).filter("lo < hi").drop("hi")
    merged = loose.join(lowest, ["w1", "w2"]).filter("at > lo").select("s1", "s2", "first", "count")
    runs = found.filter("w1 is null").select("s1", "s2", "first", "count").unionByName(merged)
    placed = members.select(*_ROW, "start", "count", "s1", "s2").join(strings.select("s1", "s2", F.col("at").alias("lo")), ["s1", "s2"])
    whole = placed.filter("at > lo").select(*_ROW, "start", "count")
    some = placed.filter("at = lo").select(*_ROW, "start", "s1", "s2").join(runs, ["s1", "s2"]).select(*_ROW, (F.col("start") + F.col("first")).alias("start"), "count")
    spans = whole.unionByName(some).groupBy(*_ROW).agg(F.collect_set(F.struct("start", "count")).alias("spans"))
    return settled.filter("copy").drop("copy"), store(spans)


@F.arrow_udf(T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]))
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The words left when all words of the windows in ``spans`` are taken out, joined by single spaces."""
    removed, kept = [], []
    for row, end, data, offsets in slices(texts):
        words = find_words(data, offsets)
        mine = spans.slice(row, end - row)
        owner = np.repeat(np.arange(end - row), mine.value_lengths().fill_null(0).to_numpy())
        fields = mine.flatten()
        first = words.first[owner] + fields.field(0).to_numpy()
        edge = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + fields.field(1).to_numpy() + WINDOW - 1, -1)
        stays = np.cumsum(edge[:-1]) == 0
        removed.append(words.counts - np.bincount(words.texts_of_words()[stays], minlength=end - row))
        kept.append(text_array(*joined_words(words, stays)))
    return pa.StructArray.from_arrays([pa.array(np.concatenate(removed) if removed else [], pa.int64()), pa.concat_arrays(kept) if kept else pa.array([], pa.string())], names=["n_removed", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs`` (doc_id, text)."""
    scanned = store(_scanned(docs))
    copies, spans = repeated_spans(docs, scanned)
    state = copies.withColumn("state", F.lit("copy")).unionByName(spans.select(*_ROW, F.lit("cut").alias("state")))
    rows = scanned.select(*_ROW, "n_words", "words_sha256").join(state, _ROW, "left")
    is_copy = F.col("state") == "copy"
    plain = rows.filter(F.col("state").isNull() | is_copy).select(
        "at", "n_words", F.when(is_copy, F.col("n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(is_copy, F.sha2(F.lit(""), 256)).otherwise(F.col("words_sha256")).alias("kept_sha256"),
    )
    texts = _identified(docs).filter(maybe_in(spans, _row_hash(), _row_hash()))
    cut = texts.join(spans.hint("merge"), _ROW).select("at", _without("text", "spans").alias("w"))
    counted = cut.select("at", "w.n_removed", F.sha2("w.kept", 256).alias("kept_sha256"), F.size(F.split("w.kept", " ")).alias("left"), "w.kept")
    left = F.when(F.col("kept") == "", F.lit(0)).otherwise(F.col("left"))
    counted = counted.select("at", (F.col("n_removed") + left).alias("n_words"), "n_removed", "kept_sha256")
    out = plain.unionByName(counted)
    return out.select(F.when(F.col("at") != _LAST, F.col("at")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages cut out of the texts, all columns kept.

    A text that loses words becomes its kept words joined by single spaces (``n_chars`` follows, if there
    is such a column); other texts are not touched. A text that loses everything stays as an empty one.
    """
    copies, spans = repeated_spans(docs, store(_scanned(docs)))
    state = copies.select(*_ROW, F.lit(True).alias("_copy"), F.lit(None).cast("array<struct<start:int,count:int>>").alias("_spans"))
    state = store(state.unionByName(spans.select(*_ROW, F.lit(False).alias("_copy"), F.col("spans").alias("_spans"))))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("at"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    # only rows that may lose words are shuffled
    probed = keyed.withColumn("_doubt", maybe_in(state, _row_hash(), _row_hash()))
    same = probed.filter("not _doubt").select("_row.*")
    joined = probed.filter("_doubt").join(state.hint("merge"), _ROW, "left")
    cut = F.when(F.col("_spans").isNotNull(), F.col("_row.text").cast("string"))
    text: Column = F.when(F.col("_copy"), F.lit("")).when(F.col("_spans").isNotNull(), _without(cut, "_spans")["kept"])
    after = joined.select("_row", F.coalesce(text, F.col("_row.text")).alias("_new"), F.col("_copy").isNotNull().alias("_changed"))

    def value(name: str) -> Column:
        if name == "text":
            return F.col("_new").alias(name)
        old = F.col(f"_row.`{name}`")
        if name == "n_chars":
            return F.when(F.col("_changed"), F.length("_new").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)

    return same.unionByName(after.select(*[value(c) for c in docs.columns]))
