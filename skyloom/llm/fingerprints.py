"""Operator 2: MinHash fingerprints of documents, and links between near copies.

A text's shingles are its runs of five words. ``SLOTS`` universal hash permutations (odd multiplier and shift
modulo 2^32) each keep the smallest value of the set; the share of equal slots estimates the Jaccard
similarity. A fingerprint is the slots in hexadecimal, 16 bits each. For links, bands of ``ROWS`` slots are
joined and the candidates verified on their full sets.

Defined cases: null and empty texts, and texts without words, share one fingerprint; a text of fewer than five
words has its word sequence as its only shingle; rows that share a doc_id follow each other by the hash of
their text, null ids come last in that order too; a text of any length is sketched whole, ties
cannot occur, repeated rows have equal fingerprints; an empty table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.linking import SHINGLE_WORDS, components
from skyloom.llm.text import find_words, mix64, shingle_sets, slices, word_hashes

SLOTS = 128
ROWS = 4
_RNG = np.random.Generator(np.random.PCG64(202))
_SCALE = _RNG.integers(0, 1 << 31, SLOTS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _RNG.integers(0, 1 << 32, SLOTS, dtype=np.uint32)
_NULL_BUCKETS = 64


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The slots of the sets ``values[bounds[i]:bounds[i+1]]``; those of an empty set are all ones."""
    out = np.full((len(bounds) - 1, SLOTS), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        base, starts = (values >> np.uint64(32)).astype(np.uint32), bounds[full]
        for i in range(SLOTS):
            out[full, i] = np.minimum.reduceat(base * _SCALE[i] + _SHIFT[i], starts)
    return out


def text_signatures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    words = find_words(data, offsets)
    return signatures(*shingle_sets(words, word_hashes(words), SHINGLE_WORDS)).astype(np.uint16)


def min_bands(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    slots = signatures(values, bounds).astype(np.uint64).reshape(len(bounds) - 1, -1, ROWS)
    out = np.tile(np.arange(SLOTS // ROWS, dtype=np.uint64), (len(slots), 1))
    for i in range(ROWS):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + slots[:, :, i])
    return out


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: documents joined by bands and verified at a Jaccard similarity of 0.75 (words as they are)."""
    return components(docs, min_bands, lower=False)


def _hex(slots: np.ndarray) -> pa.Array:
    """Slots as fixed-width hexadecimal strings."""
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)
    chars = digits[(slots[:, :, None] >> np.array([12, 8, 4, 0], np.uint16)) & 15].reshape(len(slots), -1)
    offsets = np.arange(len(slots) + 1, dtype=np.int32) * chars.shape[1]
    return pa.StringArray.from_buffers(len(slots), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(chars)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint for every row of ``docs`` (doc_id, text)."""

    @F.arrow_udf(T.StringType())
    def sketch(texts: pa.Array) -> pa.Array:
        parts = [_hex(text_signatures(data, offsets)) for _, _, data, offsets in slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return docs.select("doc_id", sketch(F.col("text").cast("string")).alias("fingerprint"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, _bucket, _after: buckets of consecutive documents, each closed by a copy (``_after`` 1) of the row that follows.

    Buckets are ranges of doc_id between approximate quantiles; rows without an id are ranges of their texts'
    hashes behind them. Only the first row of each bucket is sent to a second one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("doc_id").filter("doc_id is not null")
    inner = ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    edges = [-float("inf"), *sorted(set(inner or [])), float("inf")]

    def bucketed(df: DataFrame) -> DataFrame:
        if len(edges) < 3:
            return df.withColumn("_bucket", F.lit(0))
        keyed = Bucketizer(splits=edges, inputCol="_key", outputCol="_b").transform(df.withColumn("_key", F.col("doc_id").cast("double")))
        return keyed.withColumn("_bucket", F.col("_b").cast("int")).drop("_key", "_b")

    def loose(df: DataFrame) -> DataFrame:
        share = F.shiftrightunsigned(F.xxhash64("text"), 58)
        return df.withColumn("_bucket", (F.lit(len(edges)) + share).cast("int"))

    # at most one row per bucket
    firsts = bucketed(ids).groupBy("_bucket").agg(F.min("doc_id").alias("doc_id")).orderBy("_bucket").collect()
    no_id = rows.filter("doc_id is null")
    rest = loose(no_id).groupBy("_bucket").agg(F.min(F.xxhash64("text")).alias("key")).orderBy("_bucket").collect()
    order = [r._bucket for r in firsts] + [r._bucket for r in rest]
    before = {b: a for a, b in zip(order, order[1:])} | ({order[0]: order[-1]} if order else {})

    def sent(df: DataFrame, leads: list, column: str) -> DataFrame:
        """Every row in its bucket, and those that lead a bucket once more at the end of the one before."""
        pairs = [(r[1], before[r._bucket]) for r in leads]
        table = F.broadcast(spark.createDataFrame(pairs, f"_lead long, _to int"))
        joined = df.join(table, F.col(column) == F.col("_lead"), "left")
        ends = F.array(F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("a")), F.struct(F.col("_to").alias("b"), F.lit(1).alias("a")))
        places = F.when(F.col("_to").isNull(), F.slice(ends, 1, 1)).otherwise(ends)
        return joined.select("doc_id", "text", F.explode(places).alias("_p")).select("doc_id", "text", F.col("_p.b").alias("_bucket"), F.col("_p.a").alias("_after"))

    out = sent(bucketed(rows.filter("doc_id is not null")), firsts, "doc_id")
    if rest:
        out = out.unionByName(sent(loose(no_id).withColumn("_hash", F.xxhash64("text")), rest, "_hash"))
    return out.repartitionById(n, F.col("_bucket")).sortWithinPartitions("_bucket", "_after", "doc_id", F.xxhash64("text"))


def _edited(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(edited texts of all but the last, code points of all): the last quarter gives way to the next text's beginning."""
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    heads = np.searchsorted(chars, offsets)
    sizes = np.diff(heads)
    where = np.append(chars, len(data))
    quarter = sizes[:-1] // 4
    keep_to = where[heads[1:-1] - quarter]
    take_to = where[heads[1:-1] + np.minimum(quarter, sizes[1:])]
    raw = data.tobytes()
    bounds = offsets.tolist()
    return [raw[a:b] + raw[c:d] for a, b, c, d in zip(bounds, keep_to.tolist(), bounds[1:], take_to.tolist())], sizes


def one_array(texts: pa.ChunkedArray) -> pa.Array:
    """All chunks as one array with 64-bit offsets, which more than 2 GB of text need."""
    parts = [chunk.cast(pa.large_string()) for chunk in texts.chunks]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.large_string())


def fingerprints_and_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of ``docs``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            table = new if held is None else pa.concat_tables([held, new])
            if table.num_rows == 0:
                continue
            held = table.slice(table.num_rows - 1)
            texts = one_array(table.column("text"))
            for row, end, _, _ in slices(texts.slice(0, len(texts) - 1)):
                data, offsets = next((d, o) for _, _, d, o in slices(texts.slice(row, end - row + 1), 1 << 62))
                edited, sizes = _edited(data, offsets)
                after = np.append(0, np.cumsum([len(e) for e in edited]))
                own = text_signatures(data, offsets)
                changed = text_signatures(np.frombuffer(b"".join(edited), np.uint8), after)
                out = pa.RecordBatch.from_arrays([
                    table.column("doc_id").slice(row, end - row).combine_chunks(), pa.array(sizes[:-1], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()), _hex(own[:-1]), _hex(changed),
                    pa.array((own[:-1] == changed).mean(axis=1)), pa.array((own[:-1] == own[1:]).mean(axis=1)),
                ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
                yield out.filter(pa.array(table.column("_after").slice(row, end - row).to_numpy() == 0))

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInArrow(compare, schema)
