"""Shares, joint and strata counts, histograms, percentiles: each in one pass over the rows.

Null values are a category of their own unless a function says otherwise. Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved


def with_share(counts: DataFrame, by: Sequence[str] = (), value: str = "n") -> DataFrame:
    """counts with the share of value in its group, or in all; the totals are aggregated first, so no window holds all rows."""
    totals = counts.groupBy(*by).agg(F.sum(value).alias("total_"))
    if not by:
        return counts.crossJoin(F.broadcast(totals)).withColumn("share", F.col(value) / F.col("total_")).drop("total_")
    same = [F.col(f"c.{b}").eqNullSafe(F.col(f"t.{b}")) for b in by]
    joined = counts.alias("c").join(totals.alias("t"), same)
    return joined.select("c.*", (F.col(value) / F.col("t.total_")).alias("share"))


def field_counts(df: DataFrame, fields: Sequence[str], weight: Column | None = None) -> DataFrame:
    """(field, value, n) of several columns; one scan, one shuffle of partial counts."""
    amount = F.lit(1) if weight is None else weight
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    rows = df.select(amount.alias("w_"), F.explode(pairs).alias("p")).select("w_", "p.field", "p.value")
    return rows.groupBy("field", "value").agg(F.sum("w_").alias("n"))


def field_shares(df: DataFrame, fields: Sequence[str], weight: Column | None = None) -> DataFrame:
    """(field, value, n, share)."""
    return with_share(field_counts(df, fields, weight), ["field"])


def shares(df: DataFrame, key: Column, weight: Column | None = None) -> DataFrame:
    """(value, n, share) of one expression, weighted if asked."""
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return with_share(df.groupBy(key.alias("value")).agg(amount.alias("n")))


def merged_counts(parts: Sequence[DataFrame]) -> DataFrame:
    """Final counts from tables (value, n) of partial ones."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("value").agg(F.sum("n").alias("n"))


def joint(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, share) over all combinations that occur."""
    return with_share(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))


def crosstab_shares(df: DataFrame, group: str, key: str) -> DataFrame:
    """(group, key, n, share within the group)."""
    return with_share(df.groupBy(group, key).agg(F.count(F.lit(1)).alias("n")), [group])


def adult_shares(ages: DataFrame, least: int = 18) -> DataFrame:
    """(category, n, p): single ages (age, count) of adults rolled up to age groups; ages too low and nulls are left out."""
    from ..functions.scalar import adult_age_group

    groups = ages.where((F.col("age") >= least) & F.col("count").isNotNull()).groupBy(adult_age_group(F.col("age")).alias("category")).agg(F.sum("count").alias("n"))
    return with_share(groups).withColumnRenamed("share", "p")


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """Counts over several sets of columns in one pass; absent columns are null, and set_id tells which set it is."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("set_id"))


def running(counts: DataFrame, amount: str, by: Sequence[str], *order: Column) -> DataFrame:
    """counts with upto, the sum of amount in order up to each row of its group, and total.

    Rows are dealt out by ranges of (by, order); sums of the ranges before, one a group and range, are
    added to those within one. So no task holds a group of many rows.
    """
    keys = list(by)
    dealt = counts.repartitionByRange(*[F.col(k).asc() for k in keys], *order)
    placed = saved(dealt.withColumn("range_", F.spark_partition_id()), "ranges")
    sums = placed.groupBy(*keys, "range_").agg(F.sum(amount).alias("s_"))
    of_group = Window.partitionBy(*keys)
    ahead = sums.withColumn("ahead_", F.coalesce(F.sum("s_").over(of_group.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("s_").over(of_group)).drop("s_")
    inside = F.sum(amount).over(Window.partitionBy(*keys, "range_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"a.{k}")) for k in [*keys, "range_"]]
    both = placed.withColumn("in_", inside).alias("p").join(ahead.alias("a"), same)
    return both.select("p.*", (F.col("a.ahead_") + F.col("p.in_")).alias("upto"), "a.total").drop("range_", "in_")


def nearest_rank(df: DataFrame, value: str, points: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """sorted[min(int(p n), n - 1)] of each group, without collecting a group: distinct values are counted, then cumulated."""
    keys = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    runs = running(counts, "c", keys, F.col(value).asc())
    out = []
    for p in points:
        place = F.least((F.lit(p) * F.col("total")).cast("long"), F.col("total") - 1)
        out.append(F.min(F.when(F.col("upto") > place, F.col(value))).alias(f"p{round(100 * p)}"))
    return runs.groupBy(*keys).agg(*out)


def summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, least, largest, population deviation and variance; nulls are skipped."""
    v = F.col(value)
    return df.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"), F.stddev_pop(v).alias("std"), F.var_pop(v).alias("variance"))


def stage_summary(df: DataFrame, stage: Sequence[str], latency: str, ok: Column, retries: Column) -> DataFrame:
    """(stage, attempts, success_rate, failure_rate, mean_retries, mean, p50, p95, p99): how attempts of each stage went; percentiles by nearest rank."""
    good = F.coalesce(ok, F.lit(False))
    n = F.count(F.lit(1))
    rates = df.groupBy(*stage).agg(n.alias("attempts"), (F.count_if(good) / n).alias("success_rate"), (F.count_if(~good) / n).alias("failure_rate"), F.avg(retries).alias("mean_retries"), F.avg(latency).alias("mean"))
    ranks = nearest_rank(df, latency, (0.5, 0.95, 0.99), stage)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in stage]
    return rates.alias("a").join(ranks.alias("b"), same, "left").select("a.*", "b.p50", "b.p95", "b.p99")


def failure_reasons(df: DataFrame, stage: Sequence[str], ok: Column, reason: Column) -> DataFrame:
    """(stage, reason, n, share) of the attempts that failed; a null reason is one."""
    failed = df.where(~F.coalesce(ok, F.lit(False)))
    return with_share(failed.groupBy(*stage, reason.alias("reason")).agg(F.count(F.lit(1)).alias("n")), stage)


def histogram(df: DataFrame, bin_: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n")).where("bin is not null")


def type_token(df: DataFrame, words: Column, by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Tokens, different tokens and their ratio; two-stage, so no key needs a set in memory."""
    rows = df.select(*by, F.explode(words).alias("w"))
    if not exact:
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("tokens"), F.approx_count_distinct("w").alias("types"))
    counts = rows.groupBy(*by, "w").agg(F.count(F.lit(1)).alias("c"))
    out = counts.groupBy(*by).agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("types"))
    return out.withColumn("ratio", F.col("types") / F.col("tokens"))


def flag_counts(df: DataFrame, flags: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """How many rows hold each flag, and any and all of them."""
    every = [F.coalesce(c, F.lit(False)) for c in flags.values()]
    any_, all_ = every[0], every[0]
    for c in every[1:]:
        any_, all_ = any_ | c, all_ & c
    named = [F.count_if(c).alias(f"n_{k}") for k, c in zip(flags, every, strict=True)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *named, F.count_if(any_).alias("n_any"), F.count_if(all_).alias("n_all"))


def mean_drift(df: DataFrame, value: str, expected: float, tolerance: float, least: int = 10) -> DataFrame:
    """The mean against an expected one; stable is null for fewer than `least` values."""
    got = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    return got.select("n", "mean", F.when(F.col("n") >= least, F.abs(F.col("mean") - expected) <= tolerance).alias("stable"))


def ranked(counts: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def top_per_group(counts: DataFrame, by: Sequence[str], value: str, tie: str, k: int) -> DataFrame:
    """The k largest of each group, ties by the tie column; counts is aggregated already."""
    return ranked(counts, by, [F.desc(value), F.asc(tie)]).where(F.col("rank") <= k)


def first_per_stratum(df: DataFrame, strata: Sequence[str], order: str, k: int) -> DataFrame:
    """The first k rows of each stratum; a stratum is cut per lane before it meets in one task."""
    lane = F.pmod(F.xxhash64(order), F.lit(64))
    cut = ranked(df.withColumn("lane_", lane), [*strata, "lane_"], [F.asc(order)]).where(F.col("rank") <= k).drop("rank", "lane_")
    return ranked(cut, strata, [F.asc(order)]).where(F.col("rank") <= k)


def arg_max(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """The name with the largest value of each group, the smallest name of equals."""
    best = F.min(F.struct((-F.col(value)).alias("v"), F.col(name).alias("name")))
    return df.groupBy(*by).agg(best.alias("b")).select(*by, F.col("b.name").alias(name), (-F.col("b.v")).alias(value))


def dominant_groups(df: DataFrame, group: str, key: str, limit: float = 0.5, top: int = 3) -> DataFrame:
    """Groups one of whose most common keys holds more than limit of the group."""
    counts = crosstab_shares(df, group, key)
    return top_per_group(counts, [group], "n", key, top).where(F.col("share") > limit)


def first_last(df: DataFrame, order: str, value: str, limit: float = 1.5) -> DataFrame:
    """The first and last value by order, their ratio, and whether it passes the limit."""
    got = df.agg(F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))
    ratio = F.when(F.col("first") != 0, F.col("last") / F.col("first"))
    return got.select("first", "last", ratio.alias("ratio"), F.coalesce(ratio > limit, F.lit(False)).alias("drifts"))


def trend(df: DataFrame, x: Column, y: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.count(F.lit(1)).alias("n"))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """A top-k report: the first n rows by the order."""
    return df.orderBy(*order).limit(n)


def first_of_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key, the first by order: the pick by priority, and deduplication that keeps order."""
    others = [c for c in df.columns if c not in key]
    best = F.min_by(F.struct(*others), F.struct(*order)) if others else F.first(F.lit(1))
    got = df.groupBy(*key).agg(best.alias("b_"))
    return got.select(*key, *[F.col(f"b_.{c}").alias(c) for c in others])


def marginal(cells: DataFrame, axis: str) -> DataFrame:
    """(axis, n, share): one side of a two-way table of counts n."""
    return with_share(cells.groupBy(axis).agg(F.sum("n").alias("n")), [])


def oldest(rows: DataFrame, source: str, ts: str) -> DataFrame:
    """(oldest, source): the earliest of the sources' first times, and the first source that has it."""
    first = rows.groupBy(source).agg(F.min(ts).alias("oldest"))
    return first.agg(F.min(F.struct("oldest", source)).alias("b")).select("b.oldest", f"b.{source}")
