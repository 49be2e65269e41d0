"""Target distributions as long tables (category, p) or (given, category, p), and their algebra."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .profile import with_share


def distribution(spark: SparkSession, shares: Mapping[str, float]) -> DataFrame:
    """(category, p), normalised."""
    total = sum(shares.values())
    return spark.createDataFrame([(k, v / total) for k, v in shares.items()], "category string, p double")


def conditional(spark: SparkSession, shares: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """(given, category, p), normalised within each given."""
    rows = [(g, k, v / sum(d.values())) for g, d in shares.items() for k, v in d.items()]
    return spark.createDataFrame(rows, "given string, category string, p double")


def normalised(df: DataFrame, by: Sequence[str] = (), value: str = "p") -> DataFrame:
    """p divided by its total; without rows where the total is zero."""
    return with_share(df, by, value).withColumn(value, F.col("share")).drop("share").where(F.col(value).isNotNull())


def valid(df: DataFrame, tolerance: float = 0.02, value: str = "p") -> DataFrame:
    """total, and whether it is 1 within the tolerance."""
    return df.agg(F.sum(value).alias("total")).withColumn("valid", F.abs(F.col("total") - 1) <= tolerance)


def mixture(weights: DataFrame, given: DataFrame) -> DataFrame:
    """The marginal sum over g of P(g) P(x | g), renormalised; a given without weight is left out."""
    joined = given.join(weights.select(F.col("category").alias("given"), F.col("p").alias("w")), "given")
    return normalised(joined.groupBy("category").agg(F.sum(F.col("p") * F.col("w")).alias("p")))


def rolled_up(df: DataFrame, mapping: DataFrame, strict: bool = False) -> DataFrame:
    """Categories summed to those that mapping (category, parent) names; with strict, one it lacks is an error."""
    if strict and (lost := df.join(mapping, "category", "left_anti").select("category").head(5)):
        raise ValueError(f"no parent for {[r[0] for r in lost]}")
    summed = df.join(mapping, "category").groupBy("parent").agg(F.sum("p").alias("p"))
    return normalised(summed.withColumnRenamed("parent", "category"))


def without(df: DataFrame, drop: Column) -> DataFrame:
    """The rest, renormalised."""
    return normalised(df.where(~F.coalesce(drop, F.lit(False))))


def cumulative(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row a given with its cdf, an array of (cum, category) in order of the category."""
    order = Window.partitionBy(*by).orderBy("category").rowsBetween(Window.unboundedPreceding, 0)
    part = normalised(df.where("p > 0"), by).withColumn("cum", F.sum("p").over(order))
    return part.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("cum", "category"))).alias("cdf"))


def independent(a: DataFrame, b: DataFrame) -> DataFrame:
    """(row, col, p): the product of two marginals, which two-way fitting from an even seed gives."""
    return a.select(F.col("category").alias("row"), F.col("p").alias("p_row")).crossJoin(F.broadcast(b.select(F.col("category").alias("col"), F.col("p").alias("p_col")))).select("row", "col", (F.col("p_row") * F.col("p_col")).alias("p"))


def to_conditional(joint: DataFrame, given: str, category: str) -> DataFrame:
    """P(category | given) from a joint table."""
    part = joint.select(F.col(given).alias("given"), F.col(category).alias("category"), "p")
    return normalised(part, ["given"])


def by_priority(sources: Sequence[DataFrame]) -> DataFrame:
    """For each dist, the rows of the first of the sources that has it, with that source's number."""
    every = None
    for i, s in enumerate(sources):
        part = s.withColumn("priority", F.lit(i))
        every = part if every is None else every.unionByName(part)
    first = every.groupBy("dist").agg(F.min("priority").alias("priority"))
    return every.join(first, ["dist", "priority"])
