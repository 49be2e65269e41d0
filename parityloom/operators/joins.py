"""Lookups, outer alignment, semi and anti joins, range and banded joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str], strict: bool = False) -> DataFrame:
    """df with the columns of dim, null where it has none; with strict, that is an error."""
    if strict and (lost := df.join(dim, list(on), "left_anti").select(*on).head(5)):
        raise ValueError(f"no entry for {[tuple(r) for r in lost]}")
    return df.join(small(dim), list(on), "left")


def lookup_chain(df: DataFrame, sources: Sequence[tuple[DataFrame, str]], value: str) -> DataFrame:
    """value from the first of the sources (table, key) that has it; fell_back is that source's number."""
    out, found, number = df, [], []
    for i, (table, key) in enumerate(sources):
        out = out.join(small(table.select(key, F.col(value).alias(f"v{i}_"))), key, "left")
        found.append(F.col(f"v{i}_"))
        number.append(F.when(F.col(f"v{i}_").isNotNull(), F.lit(i)))
    return out.withColumn(value, F.coalesce(*found)).withColumn("fell_back", F.coalesce(*number)).drop(*[f"v{i}_" for i in range(len(sources))])


def in_ranges(df: DataFrame, value: str, ranges: DataFrame, width: float) -> DataFrame:
    """Rows with the ranges (low, high, label) that hold the value, both ends included.

    Value and ranges are cut into cells of the given width and joined on them,
    so the join is one on equal keys and not one of all pairs.
    """
    cell = lambda c: F.floor(c / width).cast("long")
    spread = ranges.withColumn("cell_", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    hit = df.withColumn("cell_", cell(F.col(value))).join(spread, "cell_")
    return hit.where(F.col(value).between(F.col("low"), F.col("high"))).drop("cell_")


def close_pairs(df: DataFrame, row_id: str, value: str, width: float, block: Sequence[str] = (), tasks: int = 400) -> DataFrame:
    """(a, b) of rows of one block whose values differ by at most width: a banded join on cells.

    A pair lies in one cell or in two that follow each other, so each row waits in its own cell and looks into its own and the
    next. Pairs outnumber rows without bound, so cells are dealt to a fixed number of tasks, which Spark does not join to a few for
    the smallness of the rows.
    """
    cell = F.floor(F.col(value) / width).cast("long")
    left = df.select(*block, F.col(row_id).alias("i"), F.col(value).alias("vi"), F.explode(F.array(F.struct(cell.alias("cell_"), F.lit(True).alias("own_")), F.struct((cell + 1).alias("cell_"), F.lit(False).alias("own_")))).alias("c_")).select(*block, "i", "vi", "c_.*")
    right = df.select(*block, F.col(row_id).alias("j"), F.col(value).alias("vj"), cell.alias("cell_"))
    keys = [*block, "cell_"]
    met = left.repartition(tasks, *keys).join(right.repartition(tasks, *keys).hint("shuffle_hash"), keys)
    once = F.when(F.col("own_"), F.col("i") < F.col("j")).otherwise(F.col("i") != F.col("j"))
    pairs = met.where(once & (F.abs(F.col("vi") - F.col("vj")) <= width))
    return pairs.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))


def missing(df: DataFrame, known: DataFrame, on: str) -> DataFrame:
    return df.join(known, on, "left_anti")


def known_only(df: DataFrame, known: DataFrame, on: str) -> DataFrame:
    return df.join(known, on, "left_semi")


def resumed(done: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """What is done, and what of more it lacks."""
    return done.unionByName(more.join(done.select(key), key, "left_anti"), allowMissingColumns=True)


def zipped(left: Column, right: Column) -> Column:
    """An array of pairs (x, y) by position."""
    return F.transform(F.arrays_zip(left.alias("x"), right.alias("y")), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
