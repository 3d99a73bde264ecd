"""Numbering, running values, ranks and exact quantiles that hold no hot key in one task.

Every function has one plan at every size. Numbers and running values come from a
range sort of (key, order), stored once, where a hot key simply spans partitions.
Quantiles are found by counting: approximate quantiles bracket the exact ones, and
only the distinct values in the bracket are looked at. Null keys are keys like any
other. Joins need no help here: the adaptive skew join splits hot partitions of
either side by their measured sizes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.session import store

ACCURACY = 10_000
GRID = 2000
GRID_ACCURACY = 20_000
_POS_MASK = (1 << 33) - 1


def null_safe_join(a: DataFrame, b: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """``a.join(b, keys, how)`` in which null keys meet; the keys are those of ``a``."""
    keys = list(keys)
    renamed = b.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_same_{k}"))
    return a.join(renamed, cond, how).drop(*[f"_same_{k}" for k in keys])


def range_sorted(df: DataFrame, *order: str | Column) -> DataFrame:
    """Globally sorted and stored once, with ``_part`` and the position ``_pos`` in it.

    ``order`` must end in a unique column, so that equal leading keys can be split.
    There are ``spark.sql.shuffle.partitions`` pieces at most; set it for the input.
    """
    return store(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)))
    )


def number_rows(
    df: DataFrame, *order: str | Column, name: str = "row", start: int = 0, total: str | None = None
) -> DataFrame:
    """Number all rows of a frame in ``order``.

    ``total`` adds a column with the number of rows.
    """
    rows = range_sorted(df, *order)
    # one row per partition: bounded by the partition count
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_part").agg((F.max("_pos") + 1).alias("_size")).select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        *([] if total is None else [F.sum("_size").over(Window.partitionBy()).alias(total)]),
    )
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_pos") + F.col("_offset") + F.lit(start))
        .drop("_part", "_pos", "_offset")
    )


_RUNNING = {
    "sum": (F.sum, lambda local, carry: local + F.coalesce(carry, F.lit(0))),
    "min": (F.min, lambda local, carry: F.least(local, carry)),
    "max": (F.max, lambda local, carry: F.greatest(local, carry)),
}


def running_in_group(
    df: DataFrame, keys: list[str], order: list[str | Column], running: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Running sum/min/max per key up to and including each row; ``order`` must be unique within a key.

    ``running`` maps a new column to (``sum`` | ``min`` | ``max``, value). A key is
    worked in the pieces its range sort gave it. Only the first key of a piece can
    reach in from the piece before, so the table of carried values has at most one
    row per piece.
    """
    values = {f"_v_{n}": value for n, (_, value) in running.items()}
    rows = range_sorted(df.withColumns(values), *keys, *order)
    pieces = store(rows.groupBy("_part", *keys).agg(
        F.min("_pos").alias("_first"), *[_RUNNING[how][0](f"_v_{n}").alias(f"_p_{n}") for n, (how, _) in running.items()]
    ))
    reaching = pieces.filter(F.col("_first") == 0).select(*keys).distinct()
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        null_safe_join(pieces, F.broadcast(reaching), keys, "left_semi")
        .withColumns({f"_c_{n}": _RUNNING[how][0](f"_p_{n}").over(before) for n, (how, _) in running.items()})
        .filter(F.col("_first") == 0)
        .select("_part", *keys, *[f"_c_{n}" for n in running])
    )
    upto = Window.partitionBy("_part", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"_l_{n}": _RUNNING[how][0](f"_v_{n}").over(upto) for n, (how, _) in running.items()})
    joined = null_safe_join(local, F.broadcast(carried), ["_part", *keys], "left").withColumns(
        {n: _RUNNING[how][1](F.col(f"_l_{n}"), F.col(f"_c_{n}")) for n, (how, _) in running.items()}
    )
    return joined.select(*df.columns, *running)


def number_in_group(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "row") -> DataFrame:
    """1-based row number per key; ``order`` must be unique within a key."""
    return running_in_group(df, keys, order, {name: ("sum", F.lit(1).cast("long"))})


def rank_in_group(df: DataFrame, keys: list[str], by: str, unique: str, name: str = "rank") -> DataFrame:
    """SQL ``rank()`` per key in ascending ``by``; ``unique`` only places ties for the numbering."""
    numbered = number_in_group(df, keys, [by, unique], "_row")
    firsts = numbered.groupBy(*keys, by).agg(F.min("_row").alias(name))
    return null_safe_join(numbered, firsts, [*keys, by]).drop("_row")


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float = 0.5, name: str = "median") -> DataFrame:
    """Interpolated quantile per key, ignoring null and NaN, as ``percentile`` gives it.

    ``percentile`` holds all values of a group in one task. Here approximate quantiles
    on both sides (within one ``ACCURACY``-th of the ranks) bracket the ranks wanted. Rows
    below are counted, the values inside the bracket and their next neighbours are
    counted by value: a fixed small share of the group, ties or not. Reads ``df`` twice.
    """
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    margin = 2.0 / ACCURACY
    bracket = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", F.array(F.lit(max(q - margin, 0.0)), F.lit(min(q + margin, 1.0))), ACCURACY).alias("_b"),
    ).select(*keys, "_n", F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi"))
    placed = null_safe_join(data, bracket, keys)
    # values outside count for their whole side; the nearest ones are kept for ranks next to the bracket
    inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    side = F.when(F.col("_v") < F.col("_lo"), -1).when(inside, 0).otherwise(1)
    by_value = placed.groupBy(*keys, "_n", side.alias("_side"), F.when(inside, F.col("_v")).alias("_inner")).agg(
        F.count(F.lit(1)).alias("_count"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    order = Window.partitionBy(*keys).orderBy("_side", "_inner").rowsBetween(Window.unboundedPreceding, 0)
    ranked = by_value.withColumn("_upto", F.sum("_count").over(order))
    # 0-based fractional position q*(n-1)
    at = F.lit(q) * (F.col("_n") - 1)

    def held(rank: Column) -> Column:
        """The value of a 1-based rank: below the bracket its largest, above it its least can be meant."""
        here = (rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_count"))
        return F.max(F.when(here, F.when(F.col("_side") < 0, F.col("_most")).otherwise(F.col("_least"))))

    picked = ranked.groupBy(*keys, "_n").agg(held(F.floor(at) + 1).alias("_a"), held(F.ceil(at) + 1).alias("_z"))
    low, high, share = F.col("_a"), F.col("_z"), at - F.floor(at)
    return picked.select(*keys, (low + (high - low) * share).alias(name))


def median_and_deviation(df: DataFrame, keys: list[str], value: str, median: str = "median", deviation: str = "deviation") -> DataFrame:
    """Exact median and median absolute deviation per key, ignoring null and NaN; ``df`` is read twice.

    The first scan sketches each key's distribution as ``GRID`` approximate quantiles. They
    bracket the median, and, since the deviations of the grid from the middle of that bracket
    are a sketch of the deviations, the median deviation as well. The second scan counts the
    values in the three brackets one by one (the median's, and the median less and plus the
    deviation's) and each gap between them as a whole. Both medians follow from these counts.
    """
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    grid = F.array(*[F.lit(j / GRID) for j in range(GRID + 1)])
    sketch = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", grid, GRID_ACCURACY).alias("_q"))
    # ranks off the grid, ranks that the sketch may be off, and whole rows
    slack = F.lit(2.0 / GRID + 4.0 / GRID_ACCURACY) + F.lit(3.0) / F.col("_n")
    low, high = F.floor((F.lit(0.5) - slack) * GRID).cast("int"), F.ceil((F.lit(0.5) + slack) * GRID).cast("int")
    open_end = F.lit(float("inf"))

    def bracket(values: Column) -> tuple[Column, Column]:
        return F.when(low < 0, -open_end).otherwise(F.get(values, low)), F.when(high > GRID, open_end).otherwise(F.get(values, high))

    lo, hi = bracket(F.col("_q"))
    sketch = sketch.withColumns({"_lo": lo, "_hi": hi, "_mid": F.get(F.col("_q"), F.lit(GRID // 2))})
    near, far = bracket(F.array_sort(F.transform("_q", lambda q: F.abs(q - F.col("_mid")))))
    width = F.greatest(F.col("_hi") - F.col("_mid"), F.col("_mid") - F.col("_lo"))
    sketch = sketch.withColumns({"_near": near - width, "_far": far + width})
    # one row per key
    brackets = store(sketch.select(*keys, "_n", "_lo", "_hi", "_near", "_far"))
    v = F.col("_v")
    left, right = (F.col("_lo") - F.col("_far"), F.col("_hi") - F.col("_near")), (F.col("_lo") + F.col("_near"), F.col("_hi") + F.col("_far"))
    counted = v.between(F.col("_lo"), F.col("_hi")) | v.between(*left) | v.between(*right)
    gap = F.when(v < left[0], -2).when(v < F.col("_lo"), -1).when(v < right[0], 1).otherwise(2)
    placed = null_safe_join(data, brackets, keys)
    entries = placed.groupBy(*keys, "_n", "_near", "_far", F.when(counted, 0).otherwise(gap).alias("_gap"), F.when(counted, v).alias("_inner")).agg(
        F.count(F.lit(1)).alias("_count"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    whole = Window.partitionBy(*keys)
    at = F.lit(0.5) * (F.col("_n") - 1)

    def middle(upto: Column, shown: Column, over=None) -> Column:
        """The mean of the shown values of the middle ranks, interpolated as ``percentile`` does."""
        def held(rank: Column) -> Column:
            found = F.max(F.when((rank <= upto) & (rank > upto - F.col("_count")), shown))
            return found.over(over) if over is not None else found

        first, last = held(F.floor(at) + 1), held(F.ceil(at) + 1)
        return first + (last - first) * (at - F.floor(at))

    upto = F.sum("_count").over(whole.orderBy("_least").rowsBetween(Window.unboundedPreceding, 0))
    ranked = entries.withColumn("_upto", upto)
    ranked = ranked.withColumn(median, middle(F.col("_upto"), F.when(F.col("_gap") < 0, F.col("_most")).otherwise(F.col("_least")), whole))
    ends = F.abs(F.col("_least") - F.col(median)), F.abs(F.col("_most") - F.col(median))
    # the inner gaps lie below the bracket of the deviation, the outer ones above it
    ranked = ranked.withColumn("_dev", F.when(F.abs("_gap") == 2, F.least(*ends)).otherwise(F.greatest(*ends)))
    step = F.when(F.abs("_gap") == 1, 0).when(F.abs("_gap") == 2, 2).when(F.col("_dev") < F.col("_near"), 0).when(F.col("_dev") > F.col("_far"), 2).otherwise(1)
    passed = F.sum("_count").over(whole.orderBy("_step", "_dev").rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranked.withColumn("_step", step).withColumn("_passed", passed)
    return ranked.groupBy(*keys, median, "_n").agg(middle(F.col("_passed"), F.col("_dev")).alias(deviation)).drop("_n")


def collect_parts(
    df: DataFrame, keys: list[str], order: list[str | Column], value: Column, size: int, name: str = "items"
) -> DataFrame:
    """Ordered arrays of at most ``size`` items per (key, part); nothing is dropped."""
    rows = number_in_group(df, keys, order, "_row")
    part = F.floor((F.col("_row") - 1) / F.lit(size)).cast("int").alias("part")
    packed = rows.select(*keys, part, F.struct(F.col("_row").alias("k"), value.alias("v")).alias("_item"))
    items = F.transform(F.sort_array(F.collect_list("_item")), lambda s: s["v"])
    return packed.groupBy(*keys, "part").agg(items.alias(name))
