"""Scoring of stamp triplets with a user's model (U1) and dual properties."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score_batches(df: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], name: str = "rb") -> DataFrame:
    """Score normalized triplets ``(new, ref, sub)`` batch by batch.

    ``load`` runs once per task and returns a function from an array of shape
    (rows, height, width, 3) to one score per row.
    """
    keep = [c for c in df.columns if c not in ("new", "ref", "sub")]
    schema = df.select(*keep).schema.add(name, "double")
    # a stamp travels as one flat array
    flat = df.select(*keep, *[F.flatten(c).alias(c) for c in ("new", "ref", "sub")], F.size("new").alias("_height"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = load()
        for batch in batches:
            n, scores = batch.num_rows, np.empty(0)
            if n:
                height = batch.column("_height")[0].as_py()
                planes = [batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, height, -1) for c in ("new", "ref", "sub")]
                scores = np.asarray(predict(np.stack(planes, axis=-1)), dtype="float64").reshape(-1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores, pa.float64())], names=[*keep, name])

    return flat.mapInArrow(score, schema)
