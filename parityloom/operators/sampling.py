"""Deterministic draws: every random value is a function of seed, row id and step.

So a result never depends on partitions, retries or order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small
from .targets import cumulative


def hash01(seed: int, row_id: Column, step: str = "") -> Column:
    """Uniform in [0, 1): the first 32 bits of md5 of seed:step:id."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(step), row_id.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def fast01(seed: int, row_id: Column, step: str = "") -> Column:
    """Uniform in [0, 1): the upper 53 bits of a 64-bit hash of seed, step and id; for records with many draws."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(step), row_id), 11) / F.lit(float(1 << 53))


def pick(cdf: Column, u: Column) -> Column:
    """The category of the first step of a cdf above u; the last one if rounding leaves none."""
    hit = F.get(F.filter(cdf, lambda c: c["cum"] > u), F.lit(0))["category"]
    return F.coalesce(hit, F.element_at(cdf, -1)["category"])


def draw(shares: Mapping[str, float], u: Column) -> Column:
    """A category with probability in proportion to its weight: the first, in order of the keys, whose cumulated share is above u."""
    total, cum, keys = sum(shares.values()), 0.0, sorted(shares)
    out = None
    for k in keys[:-1]:
        cum += shares[k] / total
        out = F.when(u < cum, F.lit(k)) if out is None else out.when(u < cum, F.lit(k))
    return F.lit(keys[-1]) if out is None else out.otherwise(F.lit(keys[-1]))


def draw_given(df: DataFrame, given: str, table: DataFrame, u: Column, name: str, national: DataFrame | None = None) -> DataFrame:
    """df with a draw from table (given, category, p); where it has none, from national, with fell_back set."""
    cdfs = small(cumulative(table, ["given"]).select(F.col("given").alias(given), "cdf"))
    out = df.join(cdfs, given, "left")
    if national is not None:
        total = cumulative(national).select(F.col("cdf").alias("cdf_all"))
        out = out.crossJoin(F.broadcast(total)).withColumn("fell_back", F.col("cdf").isNull()).withColumn("cdf", F.coalesce("cdf", "cdf_all")).drop("cdf_all")
    return out.withColumn(name, pick(F.col("cdf"), u)).drop("cdf")


def uniform_item(items: Sequence[str], u: Column) -> Column:
    return F.get(F.array(*map(F.lit, items)), F.floor(u * len(items)).cast("int"))


def subset(items: Sequence[str], k: int, seed: int, row_id: Column) -> Column:
    """k different items, by order of their hashes."""
    keyed = F.array(*[F.struct(hash01(seed, row_id, f"item{i}").alias("h"), F.lit(x).alias("x")) for i, x in enumerate(items)])
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: s["x"])


def gaussian(mean: float, std: float, seed: int, row_id: Column, step: str, uniform: Callable[[int, Column, str], Column] = hash01) -> Column:
    """Box and Muller's transform of two hashes."""
    a, b = uniform(seed, row_id, step + "a"), uniform(seed, row_id, step + "b")
    return mean + std * F.sqrt(-2 * F.log(1 - a)) * F.cos(2 * math.pi * b)


def triangular(low: Column, high: Column, mode: Column, u: Column) -> Column:
    c = (mode - low) / (high - low)
    return F.when(u < c, low + F.sqrt(u * (high - low) * (mode - low))).otherwise(high - F.sqrt((1 - u) * (high - low) * (high - mode)))


def resample(df: DataFrame, row_id: str, weight: str, n: int, u0: float = 0.5) -> DataFrame:
    """Exactly n rows, with replacement, in proportion to a whole-number weight, by systematic steps.

    A row covers [before, before + w) of the total W and is taken once for each
    point (i + u0) W / n in it. Sums before a row are made of sums of 4,096 lanes (the
    first digits of the md5 of the id) and running sums within one, so no task holds all rows. The
    columns draw (1 to n) and source_id are added.
    """
    lane = F.conv(F.substring(F.md5(F.col(row_id).cast("string").cast("binary")), 1, 3), 16, 10).cast("int")
    rows = df.where(F.col(weight) > 0).withColumn("lane_", lane).withColumn("w_", F.col(weight).cast("decimal(28,0)"))
    sums = rows.groupBy("lane_").agg(F.sum("w_").cast("decimal(38,0)").alias("s_"))
    order = Window.orderBy("lane_").rowsBetween(Window.unboundedPreceding, -1)  # one row a lane
    zero = F.lit(0).cast("decimal(38,0)")
    ahead = sums.withColumn("ahead_", F.coalesce(F.sum("s_").over(order).cast("decimal(38,0)"), zero)).withColumn("all_", F.sum("s_").over(Window.partitionBy()).cast("decimal(38,0)"))
    inside = Window.partitionBy("lane_").orderBy(row_id).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("in_", F.sum("w_").over(inside).cast("decimal(38,0)")).join(F.broadcast(ahead.select("lane_", "ahead_", "all_")), "lane_")
    point = lambda c: F.floor(c.cast("double") / F.col("all_").cast("double") * n + (1 - u0)).cast("long")
    upto, before = point(F.col("ahead_") + F.col("in_")), point(F.col("ahead_") + F.col("in_") - F.col("w_"))
    marked = placed.withColumn("a_", before).withColumn("b_", upto).where("b_ > a_")
    out = marked.withColumn("draw", F.explode(F.sequence(F.col("a_") + 1, F.col("b_"))))
    return out.withColumn("source_id", F.col(row_id)).drop("lane_", "w_", "in_", "ahead_", "all_", "a_", "b_")
