"""Bit tables of a fixed size that spare large tables a shuffle.

A set of keys of any size becomes ``2 ** log_bits`` bits, combined in Spark, so the driver and the workers hold a
table of the same size whatever the input. A clear bit proves that a key is not in the set: such rows need no join. A
set bit proves nothing, those rows go on to the exact join. With too many keys for its bits the table lets every row
through, which costs traffic and never a row; more bits are a parameter.

Defined cases: an empty set lets nothing through; null keys hash like any other value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_BITS = 24  # 2 MB


def bit_table(keys: DataFrame, key: Column, log_bits: int = LOG_BITS) -> np.ndarray:
    """The bits of the 64-bit hashes ``key``, as ``2 ** (log_bits - 6)`` words."""
    slot = F.shiftrightunsigned(key, 64 - log_bits)
    slots = keys.select(slot.alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()  # at most one row per word of the table, as columns
    table = np.zeros(1 << (log_bits - 6), np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def probe(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    slot = hashes.astype(np.uint64, copy=False) >> np.uint64(64 - (len(table).bit_length() - 1 + 6))
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def maybe_in(keys: DataFrame, key: Column, probed: Column, log_bits: int = LOG_BITS) -> Column:
    """A column that is false only where the hash ``probed`` is not among the hashes ``key`` of ``keys``."""
    table = keys.sparkSession.sparkContext.broadcast(bit_table(keys, key, log_bits))

    @F.arrow_udf(T.BooleanType())
    def hit(hashes: pa.Array) -> pa.Array:
        return pa.array(probe(table.value, hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    return hit(probed)
