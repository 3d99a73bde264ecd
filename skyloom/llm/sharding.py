"""Operator 6: a reproducible shuffle into shards by a permutation of the row numbers.

Rows are numbered from 0 in ascending doc_id order. A Feistel network over the next even power of two, walked
along its cycle until the value is a row number again, permutes the numbers without any table: place ``p`` is
slot ``p // shards`` of shard ``p % shards``, and the inverse tells which row lies at a place. The law is
``rows``: shard sizes differ by one at most.

Defined cases: a null text has no bytes; a null doc_id comes last; rows that share a doc_id are ordered by
checksum and size (equal rows are alike); a text of any length counts whole; an empty table gives no
rows. Extra columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.text import mix64
from skyloom.session import store

SHARDS = 24
ROUNDS = 6
SEED = 6
_POS_MASK = (1 << 33) - 1


class Permutation:
    """A seeded permutation of the numbers below ``n``."""

    def __init__(self, n: int, seed: int = SEED):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, ROUNDS, dtype=np.uint64)

    def _pass(self, x: np.ndarray, forth: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys if forth else self.keys[::-1]:
            if forth:
                left, right = right, left ^ (mix64(right + key) & self.mask)
            else:
                left, right = right ^ (mix64(left + key) & self.mask), left
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, forth: bool) -> np.ndarray:
        out = self._pass(x.astype(np.uint64), forth)
        while len(away := np.flatnonzero(out >= np.uint64(self.n))):
            out[away] = self._pass(out[away], forth)
        return out.astype(np.int64)

    def place_of(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, True)

    def row_at(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, False)


def numbered(rows: DataFrame, *order, name: str = "_row") -> tuple[DataFrame, int]:
    """(``rows`` numbered from 0 in ``order``, their count), by a stored range sort."""
    part_order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = store(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)))
    )
    # one row per partition
    sizes = store(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")))
    bases = sizes.select("_part", F.coalesce(F.sum("n").over(part_order), F.lit(0)).alias("_base"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    return placed.join(F.broadcast(bases), "_part").withColumn(name, F.col("_base") + F.col("_pos")).drop("_part", "_pos", "_base"), total


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (columns of these names are replaced); needs only doc_id and text."""
    checksum = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = docs.withColumns({"_crc": checksum, "_size": F.octet_length("text")})
    rows, total = numbered(keyed, F.col("doc_id").asc_nulls_last(), "_crc", "_size")
    permutation = Permutation(total, seed)

    @F.arrow_udf(T.LongType())
    def place(row: pa.Array) -> pa.Array:
        return pa.array(permutation.place_of(row.to_numpy(zero_copy_only=False)), pa.int64())

    placed = rows.withColumn("_place", place("_row"))
    return placed.withColumns({"shard": (F.col("_place") % shards).cast("int"), "slot": F.floor(F.col("_place") / shards)}).drop("_crc", "_size", "_row", "_place")


def shard_table(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; the texts themselves are not moved."""
    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
    )
    rows, total = numbered(narrow, F.col("doc_id").asc_nulls_last(), "text_crc32", "size")
    permutation = Permutation(total, seed)

    @F.arrow_udf(T.LongType())
    def place(row: pa.Array) -> pa.Array:
        return pa.array(permutation.place_of(row.to_numpy(zero_copy_only=False)), pa.int64())

    placed = rows.withColumn("_place", place("_row"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_place") % shards).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write ``docs`` as one Parquet folder per shard, rows in slot order."""
    out = sharded(docs, shards, seed)
    out.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
