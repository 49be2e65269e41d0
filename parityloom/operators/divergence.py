"""Observed against expected: distances, divergences, tests, entropy, information, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.math import adaptive_tolerance, chi2_p
from .common import saved, small
from .profile import joint, running


def aligned(observed: DataFrame, target: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, category, p, q) over the union of categories; what is missing counts as 0."""
    keys = [*by, "category"]
    p, q = observed.select(*keys, "p"), target.select(*keys, F.col("p").alias("q"))
    return p.join(q, keys, "full_outer").select(*keys, F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q"))


def distances(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """L1, total variation, largest error, Jensen-Shannon in bits."""
    m = (F.col("p") + F.col("q")) / 2
    part = lambda c: F.when(F.col(c) > 0, F.col(c) * F.log2(F.col(c) / m)).otherwise(0.0)
    gap = F.abs(F.col("p") - F.col("q"))
    return pairs.groupBy(*by).agg(F.sum(gap).alias("l1"), (F.sum(gap) / 2).alias("tv"), F.max(gap).alias("max_error"), (F.sum(part("p") + part("q")) / 2).alias("js"))


def smoothed_divergence(pairs: DataFrame, by: Sequence[str] = (), eps: float = 1e-10) -> DataFrame:
    """KL and JS in nats, with eps added to every share before they are normalised again."""
    totals = pairs.groupBy(*by).agg(F.sum(F.col("p") + eps).alias("tp"), F.sum(F.col("q") + eps).alias("tq"))
    both = pairs.join(small(totals), list(by)) if by else pairs.crossJoin(F.broadcast(totals))
    both = both.select(*by, ((F.col("p") + eps) / F.col("tp")).alias("p"), ((F.col("q") + eps) / F.col("tq")).alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    kl = F.col("p") * F.log(F.col("p") / F.col("q"))
    js = (F.col("p") * F.log(F.col("p") / m) + F.col("q") * F.log(F.col("q") / m)) / 2
    return both.groupBy(*by).agg(F.sum(kl).alias("kl"), F.sum(js).alias("js"))


def chi_square(counts: DataFrame, target: DataFrame, by: Sequence[str] = (), least: float = 5.0) -> DataFrame:
    """(statistic, df, p_value) of counts (category, n) against shares (category, p); cells with less than `least` expected are left out."""
    keys = [*by, "category"]
    total = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    both = target.join(small(total), list(by)) if by else target.crossJoin(F.broadcast(total))
    cells = both.withColumn("e", F.col("p") * F.col("total")).where(F.col("e") >= least).join(counts.select(*keys, "n"), keys, "left")
    gap = F.coalesce("n", F.lit(0)) - F.col("e")
    out = cells.groupBy(*by).agg(F.coalesce(F.sum(gap * gap / F.col("e")), F.lit(0.0)).alias("statistic"), F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("df"))
    return out.withColumn("p_value", chi2_p(F.col("statistic"), F.col("df").cast("double")))


def joint_chi_square(df: DataFrame, a: str, b: str, target: DataFrame, least: float = 5.0) -> DataFrame:
    """The same over all cells of a table (row, col, p)."""
    counts = df.groupBy(F.col(a).alias("row"), F.col(b).alias("col")).agg(F.count(F.lit(1)).alias("n"))
    cell = F.to_json(F.struct("row", "col")).alias("category")
    return chi_square(counts.select(cell, "n"), target.select(cell, "p"), least=least)


def drift_cells(observed: DataFrame, target: DataFrame, tolerance: float) -> DataFrame:
    """Target categories whose share is off by more than the tolerance."""
    both = target.select("category", F.col("p").alias("target")).join(observed.select("category", F.col("p").alias("actual")), "category", "left")
    gap = F.abs(F.coalesce("actual", F.lit(0.0)) - F.col("target"))
    return both.select("category", F.coalesce("actual", F.lit(0.0)).alias("actual"), "target", gap.alias("error")).where(F.col("error") > tolerance)


def within_tolerance(observed: DataFrame, target: DataFrame, n: int, confidence: float = 0.95) -> DataFrame:
    """Each target category with its error, the tolerance for n rows, and whether it holds."""
    both = aligned(observed, target).where("q > 0")
    tolerance = adaptive_tolerance(F.lit(n), confidence)
    return both.select("category", "p", "q", F.abs(F.col("p") - F.col("q")).alias("error"), tolerance.alias("tolerance"), (F.abs(F.col("p") - F.col("q")) <= tolerance).alias("ok"))


def mismatched(observed: DataFrame, target: DataFrame) -> DataFrame:
    """(category, side) of categories that only one side has."""
    extra = observed.join(target, "category", "left_anti").select("category", F.lit("extra").alias("side"))
    return extra.unionByName(target.join(observed, "category", "left_anti").select("category", F.lit("missing").alias("side")))


def strata_divergence(counts: DataFrame, target: DataFrame, strata: Sequence[str]) -> DataFrame:
    """KL, JS and errors over cells of several columns, and whether KL <= .1 and no error is over .05."""
    cell = F.to_json(F.struct(*strata)).alias("category")
    total = counts.agg(F.sum("n").alias("t"))
    observed = counts.crossJoin(F.broadcast(total)).select(cell, (F.col("n") / F.col("t")).alias("p"))
    pairs = aligned(observed, target.select(cell, "p"))
    gap = F.abs(F.col("p") - F.col("q"))
    errors = pairs.agg(F.max(gap).alias("max_error"), F.avg(gap).alias("mean_error"), F.count(F.lit(1)).alias("cells"))
    return smoothed_divergence(pairs).crossJoin(errors).withColumn("acceptable", (F.col("kl") <= 0.1) & (F.col("max_error") <= 0.05))


def entropy(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bits, from counts n: log2 N - sum n log2 n / N, so that one pass is enough."""
    total = F.sum("n")
    return counts.groupBy(*by).agg((F.log2(total) - F.sum(F.col("n") * F.log2("n")) / total).alias("entropy"), F.count(F.lit(1)).alias("categories"))


def mutual_information(df: DataFrame, a: str, b: str) -> DataFrame:
    """H(a) + H(b) - H(a, b) in bits, from the joint counts."""
    cells = joint(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b)
    part = lambda keys, name: entropy(cells.groupBy(*keys).agg(F.sum("n").alias("n"))).select(F.col("entropy").alias(name))
    got = part([a], "ha").crossJoin(part([b], "hb")).crossJoin(part([a, b], "hab"))
    return got.select((F.col("ha") + F.col("hb") - F.col("hab")).alias("mi"))


def weight_quality(df: DataFrame, weight: str, top: float = 0.05) -> DataFrame:
    """Effective sample size, its ratio, concentration, and the share of the heaviest rows.

    The heaviest rows are found over distinct weights with their counts, dealt out
    by ranges, so no task holds all rows.
    """
    levels = saved(df.where(F.col(weight).isNotNull()).groupBy(F.col(weight).cast("double").alias("w")).agg(F.count(F.lit(1)).alias("c")), "levels")
    whole = levels.agg(F.sum("c").alias("n"), F.sum(F.col("w") * F.col("c")).alias("sw"), F.sum(F.col("w") * F.col("w") * F.col("c")).alias("sww"), F.max("w").alias("mw"))
    placed = running(levels, "c", [], F.desc("w"))
    k = F.greatest(F.lit(1), (F.col("total") * top).cast("long"))
    taken = F.greatest(F.lit(0), F.least(F.col("c"), k - (F.col("upto") - F.col("c"))))
    heavy = placed.agg(F.sum(taken * F.col("w")).alias("heavy"))
    got = whole.crossJoin(heavy)
    ess = F.col("sw") * F.col("sw") / F.col("sww")
    return got.select("n", ess.alias("ess"), (ess / F.col("n")).alias("ess_ratio"), (1 - ess / F.col("n")).alias("information_loss"), (F.col("mw") * F.col("n") / F.col("sw")).alias("concentration"), (F.col("heavy") / F.col("sw")).alias("top_share"))


def against_baseline(metrics: DataFrame, baseline: DataFrame) -> DataFrame:
    """(metric, value, base, change, level): critical at twice the metric's threshold, warning beyond it."""
    both = metrics.join(baseline, "metric")
    change = F.abs(F.col("value") - F.col("base"))
    level = F.when(change >= 2 * F.col("threshold"), "critical").when(change > F.col("threshold"), "warning").otherwise("ok")
    return both.select("metric", "value", "base", change.alias("change"), level.alias("level"))


def strata_gaps(observed: DataFrame, target: DataFrame, k: int = 5) -> DataFrame:
    """The k categories with the largest errors."""
    pairs = aligned(observed, target)
    return pairs.withColumn("error", F.abs(F.col("p") - F.col("q"))).orderBy(F.desc("error"), "category").limit(k)


def collapsed(df: DataFrame, value: str, least_std: float, by: Sequence[str] = ()) -> DataFrame:
    """n and population deviation of a value, and whether it varies less than it has to."""
    got = df.groupBy(*by).agg(F.count(value).alias("n"), F.stddev_pop(value).alias("std"))
    return got.withColumn("collapsed", F.coalesce(F.col("std") < least_std, F.lit(True)))


def normal_cdf(z: Column) -> Column:
    """The normal law's distribution function by a polynomial for the error function; off by less than 1e-7."""
    x = F.abs(z) / F.lit(2**0.5)
    t = 1 / (1 + 0.3275911 * x)
    tail = ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t * F.exp(-x * x) / 2
    return F.when(z >= 0, 1 - tail).otherwise(tail)


def against_normal(df: DataFrame, value: str, by: Sequence[str], low: float, high: float, bins: int, mean: float | None = None, std: float | None = None, least_variance: float = 100.0) -> DataFrame:
    """(by, n, mean, std, kl, js, max_error, mean_error, collapsed): each group's histogram against a normal law of its own mean and deviation, or of given ones.

    Shares of the bins of low..high, of both, sum to one; kl is that of the law against the histogram. A group collapsed if its
    variance is below the least; without any variance there is no law, and only the counts are given.
    """
    rows = df.where(F.col(value).isNotNull())
    groups = rows.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    width = (high - low) / bins
    bin_ = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    seen = rows.where(F.col(value).between(low, high)).groupBy(*by, bin_.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    at = F.lit(mean) if mean is not None else F.col("mean")
    wide = F.lit(std) if std is not None else F.col("std")
    edge = lambda i: normal_cdf((F.lit(low) + width * i - at) / wide)
    law = groups.where(wide > 0).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(*by, "bin", (edge(F.col("bin") + 1) - edge(F.col("bin"))).alias("mass"))
    met = law.alias("l").join(seen.alias("s"), [*[F.col(f"l.{b}").eqNullSafe(F.col(f"s.{b}")) for b in by], F.col("l.bin") == F.col("s.bin")], "left").select("l.*", F.coalesce("s.c", F.lit(0)).alias("c"))
    of = Window.partitionBy(*by)  # as many rows as there are bins
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.sum(c).over(of)), F.lit(0.0))
    pairs = saved(met.select(*by, share("mass").alias("p"), share("c").cast("double").alias("q")), "bins")
    gap = F.abs(F.col("p") - F.col("q"))
    errors = pairs.groupBy(*by).agg(F.max(gap).alias("max_error"), F.avg(gap).alias("mean_error"))
    same = lambda x, y: [F.col(f"{x}.{b}").eqNullSafe(F.col(f"{y}.{b}")) for b in by]
    got = groups.alias("g").join(smoothed_divergence(pairs, by).alias("d"), same("g", "d"), "left").join(errors.alias("e"), same("g", "e"), "left")
    return got.select("g.*", "d.kl", "d.js", "e.max_error", "e.mean_error", (F.col("g.std") * F.col("g.std") < least_variance).alias("collapsed"))


def required(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(category, present, n) of the wanted categories; a test of shares fails where one is absent, whatever its p-value."""
    return wanted.join(counts.select("category", "n"), "category", "left").select("category", F.col("n").isNotNull().alias("present"), F.coalesce("n", F.lit(0)).alias("n"))
