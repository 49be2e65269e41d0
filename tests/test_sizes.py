"""Results and work of queries on tables larger than the given ones."""

import hashlib
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
from oracle import TABLES, difference
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  it adds all queries to the catalogue
from parityloom.functions import digests
from parityloom.operators import duplicates, joins
from parityloom.plans import catalogue
from parityloom.streaming import state

SF = "/root/testdata/sf0.001"


def tables(folder: Path, **made):
    """A folder with the given tables in place of the driver's, and DuckDB's view of it."""
    con = duckdb.connect()
    for t in TABLES:
        path = folder / f"{t}.parquet"
        if t in made:
            made[t].write.parquet(str(path))
        else:
            path.symlink_to(f"{SF}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if t in made else ''}')")
    return str(folder), con


@pytest.fixture
def many_users(spark, tmp_path):
    """Events with 5,000 users a day of one type, 20 of another."""
    ts = F.make_timestamp_ntz(F.lit(2024), F.lit(1), (1 + F.col("d")).cast("int"), F.lit(3), F.lit(0), F.lit(0.0))
    rows = spark.range(15_060).select("id", (F.col("id") % 3).alias("d"), F.floor(F.col("id") / 3).alias("u"))
    kind = F.when(F.col("u") < 5000, "click").otherwise("view")
    return tables(tmp_path, events=rows.select(F.col("id").alias("event_id"), ts.alias("ts"), (F.col("u") + 1000 * F.col("d")).alias("user_id"), kind.alias("event_type"), (F.col("id") % 50 / 2).alias("value"), F.lit("{}").alias("props")))


def test_sketch_percentiles_counts_more_users_than_a_sketch_holds(spark, many_users):
    sf, con = many_users
    assert difference(catalogue.QUERIES["sketch_percentiles"](spark, sf), con, catalogue.ORACLE["sketch_percentiles"]) == ""


def test_sketch_overlap_counts_more_users_than_a_sketch_holds(spark, many_users):
    sf, con = many_users
    assert difference(catalogue.QUERIES["sketch_overlap"](spark, sf), con, catalogue.ORACLE["sketch_overlap"]) == ""


def test_digests_of_grams_are_those_of_hashlib(spark):
    """Messages of one block to many, at the edges of blocks, of none, in rows that are cut from one another."""
    words = [chr(97 + i % 26) * (i % 29 + 1) for i in range(120)] + ["ș" * 70, "x" * 500, "y", "語"]
    rows = [" ".join(words[i : i + i % 13]) for i in range(100)] + [None, "", "a b", "a b c", " ".join(words * 3)]
    grams = [[" ".join(w[i : i + 3]) for i in range(len(w) - 2)] for w in ((r or "").split() for r in rows)]
    least = [[min(hashlib.md5(f"{g}_{i}".encode()).hexdigest() for g in each) for i in range(20)] if each else None for each in grams]
    assert digests.least_of(pa.array(rows), 3, 20).to_pylist() == least


def test_signatures_are_computed_once_and_not_row_by_row(spark):
    plan = duplicates.signed(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "md5" not in plan


def test_close_pairs_are_spread_over_many_tasks(spark):
    rows = spark.range(6000).select("id", (F.col("id") % 600 / 10.0).alias("v"))
    got = joins.close_pairs(rows, "id", "v", 0.25)
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    expected = sum(1 for x in range(600) for y in range(x, min(x + 3, 600)) for _ in range(45 if x == y else 100))
    assert sum(per_task) == expected == got.distinct().count() and max(per_task) < expected / 20


class Handle:
    """State in memory that counts what is asked of it."""

    def __init__(self):
        self.calls = 0

    def registerTimer(self, at):
        self.calls += 1

    def state(self, name, schema):
        kept, handle = [], self

        class State:
            def __getattr__(self, what):
                handle.calls += 1
                return {
                    "get": lambda: kept[0] if name == "open" else list(kept), "exists": lambda: bool(kept), "clear": kept.clear, "appendList": kept.extend,
                    "appendValue": kept.append, "update": lambda v: kept.__setitem__(slice(None), [v]), "put": lambda v: kept.__setitem__(slice(None), v),
                }[what]

        return State()

    getListState = getValueState = state


def test_visits_ask_state_for_few_things_however_many_rows_a_key_has():
    hour = 3_600_000_000
    visits, handle = state.Visits("user", 6 * hour, hour), Handle()
    visits.init(handle)
    list(visits.handleInputRows((1,), iter([{"at_": i * hour, "tie_": i, "kind_": "k", "amount_": 1} for i in range(500) if i != 250 and not 300 <= i < 320]), None))
    times = type("T", (), {"getCurrentWatermarkInMs": lambda self: 600 * 3_600_000})()
    got = list(visits.handleExpiredTimer((1,), times, None))
    assert [(r.first // hour, r.last // hour, r.n, len(r.path)) for r in got] == [(0, 299, 299, 299), (320, 499, 180, 180)]
    assert handle.calls < 20
