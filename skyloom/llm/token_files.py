"""Operator 3: token ids in Simple-8b files.

A word of 64 bits holds a 4-bit selector (the top bits) and as many ids as the selector says, the first in
the lowest bits. Selector 15 is the escape: the next word is one whole id of up to 64 bits. Ids are packed in
blocks of ``BLOCK_IDS``, each with the position of its first word, so that blocks are coded and decoded side
by side. A file ends with its tables (document ids and lengths, block positions) and a trailer that finds them.

Partitions are ranges of doc_id, sorted, and write files of at most ``FILE_IDS`` ids (or one longer document)
named in order. A file is written under a name of its own and then renamed, so a repeated task leaves the same
files. Readers take the files as Spark's ``binaryFile`` source gives them, from any file system.

Defined cases: null and empty texts have no ids but the end id; a null doc_id comes last; rows that share a
doc_id follow each other by the hash of their text; a text of any length is encoded whole and may span
files; an empty table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.text import slices
from skyloom.llm.tokens import STRETCH, encoder, with_end
from skyloom.session import scratch_root, store

END_ID = 2
BLOCK_IDS = 1024
FILE_IDS = 4 << 20
MAGIC = b"SKYIDS01"
#: fixed values: selector -> ids per word and bits per id
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2], np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30], np.int64)
ESCAPE = 15
_U = np.uint64


def _best_selectors(ids: np.ndarray) -> np.ndarray:
    """For every id the first selector that the ids from there on fit. ``ids``: one block a row, with zeros behind."""
    need = np.frexp(np.minimum(ids, _U(1 << 31)).astype(np.float64))[1].astype(np.uint8)  # bits of each id
    widest = {1: need}

    def widen(count: int) -> np.ndarray:
        """Largest need among ``count`` ids from each on, from two shorter runs that overlap."""
        if count not in widest:
            half = widen((count + 1) // 2)
            out = half.copy()
            shift = count // 2
            np.maximum(half[:, :-shift], half[:, shift:], out=out[:, :-shift])
            widest[count] = out
        return widest[count]

    best = np.full(ids.shape, ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        best[widen(int(COUNTS[s])) <= BITS[s]] = s
    return best


def pack_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block of ``BLOCK_IDS`` ids)."""
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n_blocks = -(-n // BLOCK_IDS)
    width = BLOCK_IDS + int(COUNTS[0])  # a last word may be part full, with zeros behind
    padded = np.zeros((n_blocks, width), np.uint64)
    whole = np.zeros(n_blocks * BLOCK_IDS, np.uint64)
    whole[:n] = ids
    padded[:, :BLOCK_IDS] = whole.reshape(n_blocks, BLOCK_IDS)
    best, flat = _best_selectors(padded).ravel(), padded.ravel()
    takes = np.append(COUNTS, 1)
    ends = np.arange(n_blocks) * width + np.minimum(BLOCK_IDS, n - np.arange(n_blocks) * BLOCK_IDS)
    at, cursor = np.arange(n_blocks) * width, np.zeros(n_blocks, np.int64)
    live = np.arange(n_blocks)
    steps = []
    while len(live):
        here = at[live]
        selector = best[here]
        steps.append((live, cursor[live], here, selector))
        cursor[live] += 1 + (selector == ESCAPE)
        at[live] = here + takes[selector]
        live = live[at[live] < ends[live]]
    block_at = np.cumsum(cursor) - cursor
    words = np.zeros(int(cursor.sum()), np.uint64)
    block, nth, start, selector = (np.concatenate(x) for x in zip(*steps))
    place = block_at[block] + nth
    for s in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == s)
        value = np.full(len(rows), s << 60, np.uint64)
        if s == ESCAPE:
            words[place[rows] + 1] = flat[start[rows]]
        elif BITS[s]:
            for k in range(int(COUNTS[s])):
                value |= flat[start[rows] + k] << _U(k * int(BITS[s]))
        words[place[rows]] = value
    return words, block_at


def unpack_words(words: np.ndarray, block_at: np.ndarray, n: int) -> np.ndarray:
    """The ids again. Escaped ids are whole words, so words are walked by block, all blocks at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> _U(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)  # words that an escape announces
    candidates = np.flatnonzero(selector == ESCAPE)
    if len(candidates):
        raw = _announced(selector, block_at)
    heads = np.flatnonzero(~raw)
    chosen = selector[heads]
    per = np.append(COUNTS, 1)[chosen]
    # a block's last word may be part full: cut every word at the end of its block
    block = np.searchsorted(block_at, heads, "right") - 1
    total = np.cumsum(per) - per
    first = np.searchsorted(block, np.arange(len(block_at)))
    start = total - total[first][block] + block * BLOCK_IDS
    limit = np.minimum((block + 1) * BLOCK_IDS, n)
    for s in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            out[start[rows]] = words[heads[rows] + 1]
        elif BITS[s]:
            mask = _U((1 << int(BITS[s])) - 1)
            for k in range(int(COUNTS[s])):
                rows = rows[start[rows] + k < limit[rows]]
                out[start[rows] + k] = (words[heads[rows]] >> _U(k * int(BITS[s]))) & mask
    return out


def _announced(selector: np.ndarray, block_at: np.ndarray) -> np.ndarray:
    """Words that follow an escape; a run of escape-like words alternates from its first."""
    raw = np.zeros(len(selector), bool)
    ends = np.append(block_at[1:], len(selector))
    at = block_at.copy()
    live = np.arange(len(at))
    while len(live):
        here = at[live]
        escaped = selector[here] == ESCAPE
        raw[here[escaped] + 1] = True
        at[live] += 1 + escaped
        live = live[at[live] < ends[live]]
    return raw


def file_bytes(ids: np.ndarray, doc_ids: pa.Array, counts: np.ndarray) -> bytes:
    words, block_at = pack_words(ids)
    given = np.array(doc_ids.is_valid(), np.uint8)
    sizes = np.array([len(words), len(block_at), len(ids), len(counts)], "<u8")
    tables = [block_at.astype("<u8"), doc_ids.fill_null(0).to_numpy().astype("<i8"), given, counts.astype("<u8")]
    return b"".join([MAGIC, words.astype("<u8").tobytes(), *[t.tobytes() for t in tables], sizes.tobytes(), MAGIC])


def read_file(content: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(ids, doc_ids, ids per document)."""
    if content[:8] != MAGIC or content[-8:] != MAGIC:
        raise ValueError("not a token file")
    n_words, n_blocks, n_ids, n_docs = np.frombuffer(content, "<u8", 4, len(content) - 40).astype(np.int64).tolist()
    at = 8
    parts = []
    for kind, n in (("<u8", n_words), ("<u8", n_blocks), ("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs)):
        parts.append(np.frombuffer(content, kind, n, at))
        at += parts[-1].nbytes
    words, block_at, doc_ids, given, counts = parts
    ids = unpack_words(words, block_at.astype(np.int64), n_ids)
    return ids, pa.array(doc_ids, mask=given == 0), counts.astype(np.int64)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) under ``folder`` (a URI that all executors reach); returns the list of files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        files, path = pyarrow.fs.FileSystem.from_uri(folder)
        held: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, number
            name = f"part-{part:08d}-{number:06d}.ids"
            content = file_bytes(np.concatenate([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]), np.concatenate([h[2] for h in held]))
            own = f"{path}/_writing-{name}-{uuid.uuid4().hex}"
            with files.open_output_stream(own) as out:
                out.write(content)
            files.move(own, f"{path}/{name}")
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([sum(len(h[2]) for h in held)], pa.int64())],
                                             names=["file", "n_ids", "n_docs"])
            held, size, number = [], 0, number + 1
            return row

        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1), 2 * STRETCH):
                ids, bounds = with_end(*encoder(tokenizer).encode(data, offsets), end_id)
                if held and size + len(ids) > FILE_IDS:
                    yield flush()
                held.append((ids, batch.column(0).slice(row, end - row), np.diff(bounds)))
                size += len(ids)
        if held:
            yield flush()

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order[:1]).sortWithinPartitions(*order)
    files, path = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    return store(ordered.mapInArrow(write, "file string, n_ids long, n_docs long"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, in the order of the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, doc_ids, counts = read_file(content.as_buffer().to_pybytes())
                raw = np.ascontiguousarray(ids.astype("<u4"))
                ends = np.cumsum(counts)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(counts), pa.string()), doc_ids, pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["file", "doc_id", "in_file", "n_tokens", "ids_crc32"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    found = found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    docs = store(found.mapInArrow(read, "file string, doc_id long, in_file long, n_tokens long, ids_crc32 long"))
    # one row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = docs.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(sizes, "file").select("doc_id", (F.col("base") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32")


def token_file_round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    spark = docs.sparkSession
    folder = f"{scratch_root(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(spark, folder)
