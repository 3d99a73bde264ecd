"""Association of detections with sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.photometry import snr
from skyloom.operators.aggregates import best_detection
from skyloom.operators.cluster import cluster_dbscan, source_numbering
from skyloom.operators.ranking import update_source_position
from skyloom.operators.sky import nearest_match
from skyloom.session import store


def match_known(det: DataFrame, sources: DataFrame, radius_deg: float = K.ASSOC_RADIUS_DEG) -> DataFrame:
    """(id, source_id) of detections near a known source: the nearest, then the lowest id."""
    hits = nearest_match(det.select("id", "ra", "dec"), sources.select("id", "ra", "dec"), radius_deg, inclusive=True)
    return hits.select("id", F.col("b_id").alias("source_id"))


def associate(
    det: DataFrame, sources: DataFrame, as_of: str, radius_deg: float = K.ASSOC_RADIUS_DEG,
    rb_min: float = K.ASSOC_RB_MIN, lookback_days: int = 7, next_number: int = 1, prefix: str = "N",
) -> tuple[DataFrame, DataFrame]:
    """Assign detections to sources and make new sources from what is left.

    1. unassigned detections of the last days go to the nearest known source;
    2. each source moves to its best detection;
    3. remaining detections above ``rb_min`` are clustered;
    4. each cluster becomes a source at its best detection;
    5. every detection with a source triggers an alert.

    ``det`` carries ``rb`` and ``created_at``; returns the new detection and source
    frames (``is_new`` marks new sources). Sources come back with the signal to noise and
    id of their best detection (``best_snr``, ``best_id``); given to a later call, they
    stand for the detections that it does not see.
    """
    missing = {"best_snr": "double", "best_id": det.schema["id"].dataType}
    sources = sources.withColumns({c: F.lit(None).cast(t) for c, t in missing.items() if c not in sources.columns})
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(lookback_days))
    free = F.col("source_id").isNull()
    known = store(match_known(det.filter(free & (F.col("created_at") > since)), sources, radius_deg))
    assigned = _assign(det, known)
    moved = update_source_position(sources, assigned)
    # small projection of what may cluster; read several times below
    left = store(assigned.filter(free & (F.col("rb") > rb_min)).select("id", "ra", "dec", "flux", "fluxerr"))
    clusters = store(cluster_dbscan(left, radius_deg))
    best = best_detection(left.join(clusters, "id"), "cluster", ["id", "ra", "dec", "flux", "fluxerr"])
    named = store(source_numbering(best, next_number, prefix=prefix))
    fresh = clusters.join(named.select("cluster", F.col("name").alias("source_id")), ["cluster"]).select("id", "source_id")
    out = _assign(det, known.unionByName(fresh)).withColumn(
        "triggers_alert", F.coalesce("triggers_alert", F.lit(False)) | F.col("source_id").isNotNull()
    )
    value = F.coalesce(snr(F.col("flux"), F.col("fluxerr")), F.lit(float("-inf")))
    new = named.select(F.col("name").alias("id"), "ra", "dec", value.alias("best_snr"), F.col("id").alias("best_id"), F.lit(True).alias("is_new"))
    old = moved.select("id", "ra", "dec", "best_snr", "best_id", F.lit(False).alias("is_new"))
    return out, old.unionByName(new)


def _assign(det: DataFrame, pairs: DataFrame) -> DataFrame:
    """Fill empty ``source_id`` from (id, source_id) pairs."""
    new = pairs.select("id", F.col("source_id").alias("_new_source"))
    return det.join(new, "id", "left").select(
        *[F.coalesce("source_id", "_new_source").alias(c) if c == "source_id" else F.col(c) for c in det.columns]
    )
