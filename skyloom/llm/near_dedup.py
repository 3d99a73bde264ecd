"""Operator 9: near duplicates by min-max hashing.

Every hash permutation gives two signature slots, the smallest and the largest value of a text's shingle
set, so half the permutations fill a signature. Both agree between two texts with a probability equal to
their Jaccard similarity. Bands of ``ROWS`` slots propose candidates; links are confirmed on the full sets.
A pair of similarity 0.75 is missed by all bands with a probability of (1 - 0.75^6)^48 = 8e-5.

Defined cases: null and empty texts and texts without words have no shingles and no links; a text of fewer
than five words is its whole sequence; copies are linked at once, however many; rows that share a doc_id
count as one document; a row without doc_id cannot be named: it stays alone, with a null component, and is
kept; a text of any length is compared whole; a similarity of exactly 0.75 is a link; an empty table gives no
rows. Extra columns are left alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.bits import maybe_in
from skyloom.llm.linking import components
from skyloom.llm.text import mix64
from skyloom.session import store

ROWS = 6
BANDS = 48  # half of them take the minima, half the maxima
_RNG = np.random.Generator(np.random.PCG64(909))
_SCALE = _RNG.integers(0, 1 << 31, ROWS * BANDS // 2, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _RNG.integers(0, 1 << 32, ROWS * BANDS // 2, dtype=np.uint32)


def min_max_bands(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Band hashes of the sets ``values[bounds[i]:bounds[i+1]]``, none of them empty."""
    n, starts = len(bounds) - 1, bounds[:-1]
    if n == 0:
        return np.empty((0, BANDS), np.uint64)
    base = (values >> np.uint64(32)).astype(np.uint32)
    half = BANDS // 2
    out = np.empty((n, BANDS), np.uint64)
    low, high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    for band in range(half):
        low[:], high[:] = band, band + half
        for i in range(band * ROWS, (band + 1) * ROWS):
            permuted = base * _SCALE[i] + _SHIFT[i]
            low = mix64(low * step + np.minimum.reduceat(permuted, starts))
            high = mix64(high * step + np.maximum.reduceat(permuted, starts))
        out[:, band], out[:, band + half] = low, high
    return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    found = components(docs, min_max_bands)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one document for each group, with all their columns.

    Rows that share doc_id and text stay once, as the smallest by their other columns; rows without doc_id all stay.
    """
    found = store(near_duplicates(docs))
    named = found.filter("doc_id is not null").groupBy("doc_id").agg((~F.min("kept")).alias("_gone"), (F.count(F.lit(1)) > 1).alias("_twice"))
    flags = store(named.filter("_gone or _twice").withColumnRenamed("doc_id", "_flagged"))
    # only rows whose id may be flagged are shuffled; the join is the same at every size
    doubt = maybe_in(flags, F.xxhash64("_flagged"), F.xxhash64(F.col("doc_id").cast("long")))
    probed = docs.withColumn("_doubt", doubt & F.col("doc_id").isNotNull())
    sure = probed.filter(~F.col("_doubt")).drop("_doubt")
    probed = probed.filter("_doubt").drop("_doubt")
    joined = probed.join(flags.hint("merge"), F.col("doc_id").cast("long") == F.col("_flagged"), "left").filter("not coalesce(_gone, false)")
    once = joined.filter("not coalesce(_twice, false)").select(*[F.col(f"`{c}`") for c in docs.columns])
    ordered = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    groups = joined.filter("coalesce(_twice, false)").groupBy("doc_id", "text").agg(F.min_by(row, F.struct(*ordered)).alias("_row"))
    return sure.unionByName(once).unionByName(groups.select("_row.*"))
