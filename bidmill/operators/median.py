"""Exact medians by narrowing down, without holding or ordering a group's values in one task.

The built-in median keeps every distinct value of a group in memory. Here the values of a group
are cut at bounds that a bounded sketch gives, the values between two bounds are only counted,
and only those between the bounds that hold a middle rank go on to the next round. The
first bounds lie close around the middle; later ones are spread evenly over the different values that
are left. Bounds cover the whole line, so a sketch that is off makes a part larger but no result
wrong. After both rounds some five millionths of a group's different values are put in order.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# The sketch's rank error is at most 1/accuracy of the rows, a tenth of the first margin.
_ACCURACY = 10_000
_MIDDLE = tuple(0.499 + 0.002 * i / 16 for i in range(17))
_EVEN = tuple(i / 64 for i in range(1, 64))

# Ranks of the bounds in each round.
_ROUNDS = (_MIDDLE, _EVEN)

# Parts that the distinct values of one group are spread over when they meet its bounds.
_SALTS = 32


def with_medians(
    grouped: DataFrame, rows: DataFrame, keys: tuple[str, ...], medians: dict[str, str]
) -> DataFrame:
    """``grouped`` (one row per key) with the median of each ``{slot: column}`` over ``rows``."""
    for slot, column in medians.items():
        if column not in rows.columns:
            raise ValueError(f"no column {column!r} to aggregate; there are {rows.columns}")
        if not isinstance(rows.schema[column].dataType, T.NumericType):
            raise ValueError(f"median({column}): {column} is not a number")
        found = _medians(rows, keys, column).withColumnRenamed("_median", slot)
        if keys:
            grouped = _join(grouped, found, keys, "left")
        else:  # one row each, put side by side
            both = grouped.unionByName(found, allowMissingColumns=True)
            grouped = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return grouped


def _medians(rows: DataFrame, keys: tuple[str, ...], column: str) -> DataFrame:
    """Keys and ``_median``, for groups with any value."""
    values = rows.select(*keys, F.col(column).cast("double").alias("_v"))
    values = values.where(F.col("_v").isNotNull())
    counts = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # Groups of what is left: the keys, and later one of the two middle ranks and what it is there.
    left, groups = counts, keys
    for number, ranks in enumerate(_ROUNDS):
        sketch = F.percentile_approx("_v", list(ranks), _ACCURACY).alias("_ends")
        bounds = (left if number else values).groupBy(*groups).agg(sketch)
        bounds = bounds.where(F.col("_ends").isNotNull())
        left = _middle_parts(left, bounds, keys, groups, len(ranks))
        groups = (*keys, "_which", "_rank")
    in_order = Window.partitionBy(*groups).orderBy("_v")
    ranked = left.withColumn("_upto", F.sum("_n").over(in_order))
    middle = ranked.where(F.col("_upto") >= F.col("_rank")).groupBy(*groups).agg(F.min("_v").alias("_v"))
    ends = middle.groupBy(*keys).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    median = F.col("_low") + (F.col("_high") - F.col("_low")) * 0.5
    return ends.where(F.col("_low").isNotNull()).select(*keys, median.alias("_median"))


def _middle_parts(
    left: DataFrame, bounds: DataFrame, keys: tuple[str, ...], groups: tuple[str, ...], n: int
) -> DataFrame:
    """What of each group lies between the same bounds as a middle rank, as (keys, ``_which``,
    ``_rank`` there, ``_v``, ``_n``); each of at most two ranks has its own part.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(_SALTS)).cast("int"))
    met = _join(salted, _spread(bounds), (*groups, "_salt"), "inner")
    part = reduce(lambda a, b: a + b, [(F.col("_v") > F.col("_ends")[i]).cast("int") for i in range(n)])
    placed = met.withColumn("_part", part).drop("_ends")
    totals = placed.groupBy(*groups, "_part").agg(F.sum("_n").alias("_size"))
    # As many rows for each group as there are bounds, and one.
    whole = Window.partitionBy(*groups)
    before = F.sum("_size").over(whole.orderBy("_part")) - F.col("_size")
    totals = totals.withColumn("_before", before)
    if "_rank" not in groups:
        totals = totals.withColumn("_all", F.sum("_size").over(whole))
        ranks = F.array_distinct(F.array(F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1))
        totals = totals.select("*", F.posexplode(ranks).alias("_which", "_rank"))
    first = F.col("_rank") - F.col("_before")
    chosen = totals.where((first > 0) & (first <= F.col("_size")))
    chosen = chosen.select(*keys, "_which", F.col("_rank").alias("_old"), first.alias("_new"), "_part")
    on = (*groups, "_part", "_salt")
    if "_rank" in groups:
        chosen = chosen.withColumnRenamed("_old", "_rank")
    kept = _join(placed, _spread(chosen), on, "inner")
    return kept.drop("_rank", "_old").withColumnRenamed("_new", "_rank").select(*keys, "_which", "_rank", "_v", "_n")


def _spread(df: DataFrame) -> DataFrame:
    """Each row once for each part that a group's values are spread over."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))


def _join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str) -> DataFrame:
    """Join on keys, NULL equal to NULL."""
    renamed = {key: f"_right_{key}" for key in keys}
    right = right.withColumnsRenamed(renamed)
    same: list[Column] = [F.col(key).eqNullSafe(F.col(other)) for key, other in renamed.items()]
    joined = left.join(right, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*renamed.values())
