"""Writers and packet frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.headers import json_encode
from skyloom.functions.naming import topic_name

# --- fixed values: head of a region file --------------------------------------
REGION_HEAD = (
    'global color=green dashlist=8 3 width=1 font="helvetica 10 normal" select=1 highlite=1 dash=0 '
    "fixed=0 edit=1 move=1 delete=1 include=1 source=1",
    "icrs",
)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header per part file."""
    df.write.csv(path, header=True)


def write_id_list(df: DataFrame, cols: list[str], path: str) -> None:
    """One id per line; all of the first column, then all of the next (one folder each)."""
    for n, col in enumerate(cols):
        df.select(F.col(col).cast("string").alias("value")).write.text(f"{path}/part={n}")


def region_lines(catalog: DataFrame, color: Column | str, ra: str = "xwin_world", dec: str = "ywin_world") -> DataFrame:
    """One display region per object; ``REGION_HEAD`` goes before them."""
    tint = F.lit(color) if isinstance(color, str) else color
    line = F.format_string("point(%s,%s) # color=%s", F.col(ra).cast("string"), F.col(dec).cast("string"), tint)
    return catalog.select(line.alias("value"))


def region_text(catalog: DataFrame, filtered: bool, ra: str = "xwin_world", dec: str = "ywin_world") -> DataFrame:
    """Blue before the cuts; green for kept and red for rejected objects after them."""
    color = F.when(F.col("goodcut").cast("int") == 1, "green").otherwise("red") if filtered else "blue"
    return region_lines(catalog, color, ra, dec)


def alert_sink(alerts: DataFrame, survey: str = "survey", product: str = "alerts") -> DataFrame:
    """A10: (topic, key, value) of alert packets: JSON keyed by object.

    ``alerts`` carries the packet columns plus ``alert_type`` and ``created_at``. The
    frame can be written with ``partitionBy("topic")`` or to a message broker.
    """
    body = [c for c in alerts.columns if c not in ("alert_type", "created_at")]
    kind = alerts.select(F.struct(*body).alias("v")).schema["v"].dataType
    return alerts.select(
        topic_name(F.col("alert_type"), F.col("created_at"), survey, product).alias("topic"),
        F.col("objectId").alias("key"),
        json_encode(F.struct(*body), kind).alias("value"),
    )


def write_topics(packets: DataFrame, path: str) -> None:
    """A10: one folder per topic."""
    packets.write.partitionBy("topic").json(path)
