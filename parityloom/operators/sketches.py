"""Sketches of batches that are kept and merged: quantiles, distinct values and overlaps without a second look at rows.

A batch leaves one row a group: counts, sums and bounds, which are exact, a KLL sketch of a
number and a theta sketch of a key. Rows of many batches merge into the same row that one batch of
all would give, within the bounds below. A sketch has a fixed largest size, so a group of any number of rows is
some kilobytes, and merging shuffles sketches, not rows.

Numbers of keys are exact up to the entries of a theta sketch and estimates beyond; exact_distinct and exact_overlaps count
the groups beyond in their rows.

Nulls are left out of a sketch and of n_values; n counts all rows. A null group is a group. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small

#: Sizes of the sketches: K of KLL, and the logarithm of the entries of theta.
K, LOG_ENTRIES = 400, 12


def rank_error(k: int = K) -> float:
    """A quantile's rank is off by no more than this part of all values, with 99 % confidence."""
    return 2.296 / k**0.9723


def distinct_error(log_entries: int = LOG_ENTRIES) -> float:
    """The relative standard error of a number of distinct keys; none up to 2**log_entries keys."""
    return 1 / (2**log_entries - 1) ** 0.5


def sketched(df: DataFrame, by: Sequence[str], value: Column, key: Column | None = None, k: int = K, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(by, n, n_values, total, low, high, quantiles, keys): one row a group of a batch."""
    v = value.cast("double")
    out = [F.count(F.lit(1)).alias("n"), F.count(v).alias("n_values"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"), F.kll_sketch_agg_double(v, k).alias("quantiles")]
    if key is not None:
        out.append(F.theta_sketch_agg(key, log_entries).alias("keys"))
    return df.groupBy(*by).agg(*out)


def merged(sketches: DataFrame, by: Sequence[str], log_entries: int = LOG_ENTRIES) -> DataFrame:
    """The same row for coarser groups, or for the same ones of several batches."""
    out = [F.sum("n").alias("n"), F.sum("n_values").alias("n_values"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("quantiles").alias("quantiles")]
    if "keys" in sketches.columns:
        out.append(F.theta_union_agg("keys", log_entries).alias("keys"))
    return sketches.groupBy(*by).agg(*out)


def estimates(sketches: DataFrame, points: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """The rows of sketches with mean, p50 and so on, and distinct, in place of the sketches; no value where a group has none."""
    at = F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("quantiles", F.array(*[F.lit(float(p)) for p in points])))
    got = sketches.withColumn("at_", at)
    named = [F.get("at_", F.lit(i)).alias(f"p{round(100 * p)}") for i, p in enumerate(points)]
    more = [F.theta_sketch_estimate("keys").alias("distinct")] if "keys" in sketches.columns else []
    rest = [c for c in sketches.columns if c not in ("quantiles", "keys")]
    return got.select(*rest, (F.col("total") / F.col("n_values")).alias("mean"), *named, *more)


def overlaps(sketches: DataFrame, order: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, order, keys of the group, of the one before it, and of both): how many keys stay from one batch to the next; order is a whole number."""
    here = sketches.select(*by, order.alias("order"), F.col("keys").alias("k"))
    before = sketches.select(*by, (order + 1).alias("order"), F.col("keys").alias("kb"))
    both = here.join(before, [*by, "order"])
    size = F.theta_sketch_estimate
    return both.select(*by, "order", size("k").alias("keys"), size("kb").alias("before"), size(F.theta_intersection("k", "kb")).alias("both"))


def _of_groups(df: DataFrame, by: Sequence[str], groups: DataFrame) -> DataFrame:
    """The rows of df that are of the groups; a null group is a group."""
    asked = small(groups.select(*[F.col(b).alias(f"{b}_") for b in by]))
    return df.join(asked, [F.col(b).eqNullSafe(F.col(f"{b}_")) for b in by], "left_semi")


def _corrected(found: DataFrame, exact: DataFrame, by: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """found, with the numbers of exact where it has the group."""
    better = small(exact.select(*[F.col(b).alias(f"{b}_") for b in by], *[F.col(c).alias(f"{c}_") for c in numbers]))
    met = found.join(better, [F.col(b).eqNullSafe(F.col(f"{b}_")) for b in by], "left")
    return met.select(*[F.coalesce(f"{c}_", c).alias(c) if c in numbers else c for c in found.columns])


def exact_distinct(found: DataFrame, df: DataFrame, by: Sequence[str], key: Column, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Estimates with the true number of keys in every group.

    A sketch that holds all keys of its group has at most 2**log_entries of them, and one that left keys out estimates more. Groups
    of more are counted in the rows df: different (group, key) pairs are dealt by both, so no task holds a group.
    """
    unsure = found.where(F.col("distinct") > 2**log_entries)
    pairs = _of_groups(df.select(*by, key.alias("key_")).where("key_ IS NOT NULL"), by, unsure).distinct()
    return _corrected(found, pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("distinct")), by, ["distinct"])


def exact_overlaps(found: DataFrame, df: DataFrame, order: Column, key: Column, by: Sequence[str] = (), log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Overlaps with true numbers: those of which a sketch left keys out are counted in the rows df, by (group, order, key)."""
    unsure = found.where((F.col("keys") > 2**log_entries) | (F.col("before") > 2**log_entries))
    sides = F.array(F.struct(order.alias("order"), F.lit(1).alias("here"), F.lit(0).alias("past")), F.struct((order + 1).alias("order"), F.lit(0).alias("here"), F.lit(1).alias("past")))
    rows = df.select(*by, key.alias("key_"), F.explode(sides).alias("s_")).select(*by, "key_", "s_.*").where("key_ IS NOT NULL")
    each = _of_groups(rows, [*by, "order"], unsure).groupBy(*by, "order", "key_").agg(F.max("here").alias("here"), F.max("past").alias("past"))
    exact = each.groupBy(*by, "order").agg(F.sum("here").alias("keys"), F.sum("past").alias("before"), F.sum(F.col("here") * F.col("past")).alias("both"))
    return _corrected(found, exact, [*by, "order"], ["keys", "before", "both"])


def rank_errors(df: DataFrame, by: Sequence[str], value: Column, found: DataFrame, points: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """(by, error): how far each estimate's true rank is from its point, as a part of all values, the largest of the points.

    This is the second look that sketches spare; it is for checking them.
    """
    names = [f"p{round(100 * p)}" for p in points]
    at = found.select(*[F.col(b).alias(f"{b}_") for b in by], *names)
    met = df.select(*by, value.cast("double").alias("v_")).join(at, [F.col(b).eqNullSafe(F.col(f"{b}_")) for b in by]).where("v_ IS NOT NULL")
    off = []
    for p, name in zip(points, names, strict=True):
        below, upto = F.count_if(F.col("v_") < F.col(name)) / F.count(F.lit(1)), F.count_if(F.col("v_") <= F.col(name)) / F.count(F.lit(1))
        off.append(F.greatest(below - p, p - upto, F.lit(0.0)))
    return met.groupBy(*by).agg(F.greatest(*off).alias("error"))
