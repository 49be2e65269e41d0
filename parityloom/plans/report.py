"""The end-to-end report: one pass for all marginals, then gates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.math import chi2_p
from ..operators import divergence, profile
from ..operators.raking import Raked
from .gates import Decision, Metrics, decide
from .people import MARGINALS, corrected, generate


def target_table(spark: SparkSession, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """(field, category, p), normalised by field."""
    rows = [(f, k, v / sum(d.values())) for f, d in targets.items() for k, v in d.items()]
    return spark.createDataFrame(rows, "field string, category string, p double")


def marginal_errors(df: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """(field, n, l1, tv, max_error, js, statistic, df, p_value) of all target fields from one scan."""
    spark = df.sparkSession
    target = F.broadcast(target_table(spark, targets))
    counts = profile.with_share(profile.field_counts(df, list(targets)), ["field"]).select("field", F.col("value").alias("category"), "n", F.col("share").alias("p"))
    both = divergence.aligned(counts, target, ["field"]).join(counts.select("field", "category", "n"), ["field", "category"], "left")
    totals = counts.groupBy("field").agg(F.sum("n").alias("total"))
    cells = both.join(F.broadcast(totals), "field")
    expected = F.col("q") * F.col("total")
    gap = F.coalesce("n", F.lit(0)) - expected
    tested = cells.groupBy("field").agg(F.coalesce(F.sum(F.when(expected >= 5, gap * gap / expected)), F.lit(0.0)).alias("statistic"), F.greatest(F.count_if(expected >= 5) - 1, F.lit(0)).alias("df"), F.max("total").alias("n"))
    out = divergence.distances(both, ["field"]).join(tested, "field")
    return out.withColumn("p_value", chi2_p(F.col("statistic"), F.col("df").cast("double")))


def metrics(df: DataFrame, targets: Mapping[str, Mapping[str, float]], raked: Raked | None = None, provenance: Mapping[str, str] | None = None, **other) -> Metrics:
    """One row a field comes to the driver."""
    rows = marginal_errors(df, targets).collect()
    by = {r["field"]: {"js": r["js"], "p_value": r["p_value"], "n": r["n"], "l1": r["l1"]} for r in rows}
    sources = dict(provenance or {})
    from .gates import CRITICAL, SUPER_CRITICAL

    part = lambda fields: sum(sources.get(f) == "FALLBACK" for f in fields if f in sources) / max(1, sum(f in sources for f in fields))
    ess = None
    if raked is not None:
        ess = divergence.weight_quality(raked.rows, "weight").first()["ess_ratio"]
    return Metrics(
        mean_l1=sum(r["l1"] for r in rows) / max(1, len(rows)), max_error=max((r["max_error"] for r in rows), default=0.0),
        fallback_critical=part(CRITICAL), fallback_super=part(SUPER_CRITICAL), all_fallback=bool(sources) and set(sources.values()) == {"FALLBACK"},
        ess_ratio=ess, converged=None if raked is None else raked.converged, by_field=by, **other,
    )


@dataclass
class Bundle:
    rows: DataFrame
    decision: Decision
    metrics: Metrics


class Rejected(Exception):
    """The gates rejected a data set that had to pass."""


def generate_dataset(spark: SparkSession, n: int, profile_name: str = "ANALYSIS_ONLY", seed: int = 42, rake: bool = True, strict: bool = False, raise_on_reject: bool = False) -> Bundle:
    """Draw, correct, measure and judge a population."""
    from ..operators.common import saved
    from .people import AGES

    rows, raked = corrected(spark, n, seed) if rake else (generate(spark, n, seed), None)
    rows = saved(rows, "population")
    fields = ("sex", "region", "residence_type", "ethnicity", "age_group")
    targets = {f: {k: v for k, v in MARGINALS[f].items() if f != "age_group" or k in AGES} for f in fields}
    m = metrics(rows, targets, raked)
    decision = decide(m, profile_name, strict)
    if raise_on_reject and decision.verdict == "REJECT":
        raise Rejected("; ".join(decision.reasons))
    return Bundle(rows, decision, m)
