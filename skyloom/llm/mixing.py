"""Operator 1: mixing sources to target weights, with DataFrame functions only.

Words are counted once per document and summed per source. The targets share the budget by weight, but stop
at ``MAX_REPEAT`` times the source's size; what a full source leaves is shared again by weight. That is one
water level: sources in the order of size over weight fill up below it. A source's rate is its target over
its size, and each document is taken floor(rate) times, plus once more if its seeded hash falls below the
fraction. The hash is of the doc_id alone, so reruns agree and copies of a text are drawn apart.

Defined cases: null and empty texts have no words (size 0) and are taken as often as their source's rate says,
which adds nothing; a source without words has target and rate 0; a null source is a source, the last in
the order of weights; a null doc_id draws like an empty one; rows may repeat; a text
of any length is counted whole; an empty table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.session import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
BUDGET = 1.5  # share of all words to take
MAX_REPEAT = 2
SEED = "mix-1"
_DRAWS = float(1 << 52)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 hash."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(_DRAWS)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target. ``sizes``: source, size per document.

    The windows below run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeat)
    # sources in the order in which a rising level fills them; each sees what the ones before it hold
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(everything) * F.lit(budget) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = ranked.withColumn("level", left / F.sum("weight").over(onward))
    # the water level: the first one that its own source does not reach; beyond the last, all are full
    open_here = F.col("level") <= F.col("cap") / F.col("weight")
    level = F.min(F.when(open_here, F.struct((F.col("cap") / F.col("weight")).alias("at"), "level"))).over(everything)["level"]
    target = F.least(F.coalesce(level * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return levels.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every row of ``docs`` (doc_id, text, source)."""
    sizes = store(docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size")))
    targets = store(source_targets(sizes, weights, budget, max_repeat)).withColumnRenamed("source", "_source")
    joined = sizes.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    copies = _copies(F.col("doc_id"), seed)
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def _copies(doc_id: Column, seed: str) -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return F.floor(rate) + F.when(draw(doc_id, seed) < rate - F.floor(rate), F.lit(1)).otherwise(F.lit(0))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it is taken, with all its columns."""
    sizes = docs.select(F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    targets = store(source_targets(sizes, weights, budget, max_repeat)).withColumnRenamed("source", "_source")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col("source").cast("string").alias("_key"))
    joined = rows.join(targets, F.col("_key").eqNullSafe(F.col("_source")))
    times = _copies(F.col("_row.doc_id"), seed).cast("int")
    return joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), times))).select("_row.*")


#: the same in DuckDB, over the table ``documents``
ORACLE = f"""
WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, 2 * source_size AS cap,
    CAST([5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight FROM totals),
levels AS (SELECT *, ((SELECT sum(source_size) FROM totals) * 1.5e0
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
water AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level <= cap / weight),
targets AS (SELECT source, source_size, least(coalesce((SELECT level FROM water) * weight, CAST(cap AS DOUBLE)), CAST(cap AS DOUBLE)) AS target FROM ranked),
rates AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0e0 END AS rate,
    CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / {_DRAWS:.1f}e0 AS draw
  FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * (CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken,
  CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM rates
"""
