"""As-of joins: each row with the latest row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_before(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, take: Sequence[str], width: str = "1 day", tie: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """left with the columns take of the latest row of right of the same key at or before its time, or only before, if strict.

    Both sides are laid over each other and cut into buckets of `width`, so a key of very many rows is
    many groups of a window, and no join brings rows of one key together. Within a
    bucket the last row of right seen so far is carried along. What a bucket ends with is one row, and is carried
    over to the next ones that have rows: that window runs over buckets. Among rows of right of one time the
    largest by `tie`, then by `take`, counts.

    A null key meets nothing, a null time of left has no row, and one of right is never one. Without a
    row the columns are null; repeated rows of left stay. An empty side is fine. Columns of left of the names in take are
    an error.
    """
    if clash := set(map(str.lower, take)) & set(map(str.lower, left.columns)):
        raise ValueError(f"left has {sorted(clash)} already")
    bucket = F.floor(F.unix_micros("ts_") / F.lit(micros(width))).cast("long")
    keys = [f"k{i}_" for i in range(len(on))]
    rows = left.withColumn("ts_", F.col(left_ts).cast("timestamp"))
    here = rows.select(*[F.col(k).alias(n) for k, n in zip(on, keys, strict=True)], "ts_", F.lit(None if strict else 1).cast("int").alias("side_"), F.struct(*left.columns).alias("l_"))
    best = F.struct(F.col(right_ts).cast("timestamp").alias("t"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(tie)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(take)])
    there = right.where(F.col(right_ts).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(on, keys, strict=True)], F.col(right_ts).cast("timestamp").alias("ts_"), F.lit(0).alias("side_"), best.alias("r_")).where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    both = here.unionByName(there, allowMissingColumns=True).withColumn("b_", bucket)
    # at one time: strict rows first (null), then those of right, then the others
    inside = Window.partitionBy(*keys, "b_").orderBy(F.col("ts_").asc_nulls_first(), F.col("side_").asc_nulls_first(), F.col("r_").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("in_", F.last("r_", ignorenulls=True).over(inside)).where("l_ IS NOT NULL")
    ends = both.groupBy(*keys, "b_").agg(F.max("r_").alias("end_"))
    carried = ends.select(*keys, "b_", F.last("end_", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("b_").rowsBetween(Window.unboundedPreceding, -1)).alias("before_")).where("before_ IS NOT NULL")
    same = [F.col(f"s.{k}") == F.col(f"c.{k}") for k in [*keys, "b_"]]
    met = seen.alias("s").join(carried.alias("c"), same, "left")
    got = F.when(F.col("s.ts_").isNotNull(), F.coalesce("s.in_", "c.before_"))
    return met.select("s.l_.*", *[got[f"c{i}"].alias(c) for i, c in enumerate(take)])


def micros(width: str) -> int:
    number, unit = width.split()
    return round(float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit.rstrip("s")] * 1_000_000)
