"""Raking of many cells, sketches, as-of joins, trees and dependencies against plain Python."""

import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parityloom.functions import nested
from parityloom.operators import asof, profile, raking, rules, sketches

# ---- raking --------------------------------------------------------------------------------------


def people(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), rng.choice(["x", "y", None]), rng.randrange(40)) for _ in range(n)]
    return spark.createDataFrame(rows, "a string, b string, c int")


TARGETS = {"a": {"a": 0.5, "b": 0.3, "d": 0.2}, "b": {"x": 0.4, "y": 0.6}}


def test_rounds_of_dataframes_give_what_the_driver_gives(spark):
    df = people(spark).where("b IS NOT NULL")
    for rounds in (1, 3, 40):
        one = raking.rake(df, TARGETS, rounds)
        two = raking.rake_table(df, raking.long_targets(df, TARGETS), ["a", "b"], rounds)
        assert one.rounds == two.rounds and one.converged == two.converged and one.max_error == pytest.approx(two.max_error)
        for f in TARGETS:
            assert one.drift[f] == pytest.approx(two.drift[f])
        of = lambda r: {(x["a"], x["b"]): x["weight"] for x in r.rows.collect()}
        assert of(one) == pytest.approx(of(two))


def test_raking_goes_on_beyond_the_drivers_cells(spark, monkeypatch):
    df = people(spark).where("b IS NOT NULL")
    want = {(r["a"], r["b"]): r["weight"] for r in raking.rake(df, TARGETS, 5).rows.collect()}
    monkeypatch.setattr(raking, "CELLS", 2)
    monkeypatch.setattr(raking.np, "bincount", None)  # nothing is fitted on the driver
    assert {(r["a"], r["b"]): r["weight"] for r in raking.rake(df, TARGETS, 5).rows.collect()} == pytest.approx(want)


def test_raking_converges_on_many_cells(spark):
    df = people(spark, 3000)
    fair = {str(i): 1 + i % 3 for i in range(40)}
    got = raking.rake_table(df, raking.long_targets(df, {"c": fair, "a": {"a": 0.2, "b": 0.3, "c": 0.5}}), ["c", "a"], 30, 1e-9, (0.0, 1e9))
    assert got.converged
    by = {r["c"]: r["w"] for r in got.rows.groupBy("c").agg(F.sum("weight").alias("w")).collect()}
    total = sum(by.values())
    assert [by[i] / total for i in range(40)] == pytest.approx([(1 + i % 3) / sum(fair.values()) for i in range(40)], abs=1e-8)


def test_raking_of_nulls_and_of_nothing(spark):
    df = people(spark)
    got = raking.rake_table(df, raking.long_targets(df, {"b": {"x": 0.5, "y": 0.5}}), ["b"], 3)
    assert {r["weight"] for r in got.rows.where("b IS NULL").collect()} == {0.2}  # a value without target sinks to the bound
    none = raking.rake_table(df.limit(0), raking.long_targets(df, {"b": {"x": 1.0}}), ["b"], 2)
    assert none.rows.count() == 0 and none.rounds == 2 and none.max_error == 1.0


# ---- sketches ------------------------------------------------------------------------------------


def test_sketches_of_batches_merge_into_one(spark):
    rng = random.Random(8)
    rows = [(i % 7, rng.choice(["p", "q", None]), rng.gauss(0, 1) if i % 11 else None, rng.randrange(3000)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "batch int, g string, v double, k long")
    daily = sketches.sketched(df, ["batch", "g"], F.col("v"), F.col("k"))
    got = {r["g"]: r for r in sketches.estimates(sketches.merged(daily, ["g"])).collect()}
    off = {r["g"]: r["error"] for r in sketches.rank_errors(df, ["g"], F.col("v"), sketches.estimates(sketches.merged(daily, ["g"]))).collect()}
    for g in ("p", "q", None):
        mine = [r for r in rows if r[1] == g]
        values = [r[2] for r in mine if r[2] is not None]
        assert (got[g]["n"], got[g]["n_values"], got[g]["low"], got[g]["high"]) == (len(mine), len(values), min(values), max(values))
        assert got[g]["mean"] == pytest.approx(sum(values) / len(values)) and got[g]["distinct"] == len({r[3] for r in mine})
        assert off[g] <= 2 * sketches.rank_error()


def test_sketch_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(1, None, None)], "g int, v double, k long")
    r = sketches.estimates(sketches.sketched(df, ["g"], F.col("v"), F.col("k"))).head()
    assert (r["n"], r["n_values"], r["p50"], r["mean"], r["distinct"]) == (1, 0, None, None, 0)
    assert sketches.merged(sketches.sketched(df.limit(0), ["g"], F.col("v")), ["g"]).count() == 0


def test_overlap_of_many_keys_is_within_its_error(spark):
    df = spark.range(60_000).select((F.col("id") % 2).alias("day"), F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") - 1 + 20_000).alias("k"), F.lit(1.0).alias("v"))
    r = sketches.overlaps(sketches.sketched(df, ["day"], F.col("v"), F.col("k")), F.col("day")).head()
    assert r["keys"] == pytest.approx(30_000, rel=5 * sketches.distinct_error()) and r["both"] == pytest.approx(20_000, rel=0.15)


def test_stage_summary_counts_nulls_as_failures(spark):
    df = spark.createDataFrame([("s", 1.0, True, 0), ("s", 3.0, None, 2), (None, None, False, None)], "stage string, ms double, ok boolean, retries int")
    got = {r["stage"]: r for r in profile.stage_summary(df, ["stage"], "ms", F.col("ok"), F.col("retries")).collect()}
    assert (got["s"]["attempts"], got["s"]["success_rate"], got["s"]["mean_retries"], got["s"]["p50"]) == (2, 0.5, 1.0, 3.0)
    assert got[None]["failure_rate"] == 1 and got[None]["p50"] is None
    assert {(r["stage"], r["n"]) for r in profile.failure_reasons(df, ["stage"], F.col("ok"), F.lit(None).cast("string")).collect()} == {("s", 1), (None, 1)}


# ---- as-of joins ---------------------------------------------------------------------------------


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("width", ["1 second", "1 minute", "1 day"])
def test_as_of_join(spark, strict, width):
    rng = random.Random(len(width))
    at = lambda: rng.choice([None, *range(0, 400)])
    left = [(i, rng.choice(["a", "b", "c", None]), at()) for i in range(150)] + [(7, "a", 100)] * 2
    right = [(rng.choice(["a", "b", None]), at(), i) for i in range(60)] + [("a", 100, 900), ("a", 100, 901), ("b", 399, None)]
    frame = lambda rows, s: spark.createDataFrame(rows, s).withColumn("ts", F.timestamp_seconds("s")).drop("s")
    got = asof.latest_before(frame(left, "id int, key string, s int"), frame(right, "key string, s int, v int").withColumnRenamed("ts", "rts"), ["key"], "ts", "rts", ["v"], width, strict=strict)
    want = []
    for i, k, t in left:
        rows = [(s, v is not None, v) for key, s, v in right if k is not None and key == k and s is not None and t is not None and (s < t if strict else s <= t)]
        want.append((i, max(rows)[2] if rows else None))
    assert Counter((r["id"], r["v"]) for r in got.collect()) == Counter(want)


def test_as_of_join_of_nothing_and_of_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "2024-01-01", 5)], "id int, key string, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp"))
    other = df.select("key", F.col("ts").alias("rts"), F.col("v").alias("w"))
    assert asof.latest_before(df, other.limit(0), ["key"], "ts", "rts", ["w"]).head()["w"] is None
    assert asof.latest_before(df.limit(0), other, ["key"], "ts", "rts", ["w"]).count() == 0
    with pytest.raises(ValueError):
        asof.latest_before(df, df, ["key"], "ts", "ts", ["v"])


# ---- trees ---------------------------------------------------------------------------------------


def leaves(x, path=()):
    if isinstance(x, (dict, list)) and x:
        for k, v in x.items() if isinstance(x, dict) else enumerate(x):
            yield from leaves(v, (*path, str(k)))
    else:
        text = None if x is None else json.dumps(x) if isinstance(x, (dict, list, bool, int)) else x
        yield "/".join(path), text


def test_trees_of_any_depth(spark):
    deep = 1
    for i in range(30):
        deep = {"k": deep} if i % 2 else [deep, "é", True]
    trees = [{"a": {"b": [1, {"c": None}], "": "x"}, "e": {}, "l": [], "a.b": "dot"}, deep, 5, "text", None, [], [[[]], [1]]]
    rows = [(i, json.dumps(t)) for i, t in enumerate(trees)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, j string").select("id", F.parse_json("j").alias("t"))
    got = Counter((r["id"], "/".join(r["path"]), r["value"]) for r in nested.tree_leaves(df, "t", ["id"]).collect())
    assert got == Counter((i, p, v) for i, t in enumerate(trees) for p, v in leaves(t))
    with pytest.raises(ValueError):
        nested.tree_leaves(df, "t", ["id"], most=5)
    assert nested.tree_leaves(df.limit(0), "t", ["id"]).count() == 0


def test_values_at_paths(spark):
    df = spark.createDataFrame([('{"a": [1, {"b": "2.5"}], "s": "text"}',), ("7",), (None,)], "j string").select(F.parse_json("j").alias("t"))
    get = lambda *a, **k: [r[0] for r in df.select(nested.at_path(F.col("t"), *a, **k)).collect()]
    assert get("$.a[0]") == [1.0, 0.0, 0.0] and get("$.a[1].b") == [2.5, 0.0, 0.0] and get("$.s", "string", "-") == ["text", "-", "-"]


# ---- dependencies --------------------------------------------------------------------------------


def test_dependencies(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["n", "m", None]), rng.choice([1, 2]), rng.choice(["x", "y", None])) for _ in range(60)] + [("one", 1, "x"), ("none", 1, None)]
    df = spark.createDataFrame(rows, "a string, b int, v string")
    groups = defaultdict(list)
    for a, b, v in rows:
        groups[a, b].append(v)
    want = {(a, b, len(vs), len(set(vs))) for (a, b), vs in groups.items() if len(set(vs)) > 1}
    assert {(r["a"], r["b"], r["n_rows"], r["n_values"]) for r in rules.dependency(df, ["a", "b"], "v").collect()} == want
    usual = {k: min(set(vs), key=lambda v: (-vs.count(v), v is None, v or "")) for k, vs in groups.items()}
    assert Counter((r["a"], r["b"], r["v"], r["usual"]) for r in rules.contradictions(df, ["a", "b"], "v").collect()) == Counter((a, b, v, usual[a, b]) for a, b, v in rows if v != usual[a, b])
    assert rules.dependency(df.limit(0), ["a"], "v").count() == 0


def test_references(spark):
    df, parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int"), spark.createDataFrame([(2, "x"), (2, "y"), (3, "z")], "id int, k string")
    assert [tuple(r) for r in rules.dangling(df, "k", parent, "id").collect()] == [(1, 2)]
    assert [tuple(r) for r in rules.childless(parent, "id", df, "k").collect()] == [(3,)]
    assert [tuple(r) for r in rules.repeated_rows(df, ["k"]).collect()] == [(1, 2)]


# ---- shared folders ------------------------------------------------------------------------------


def test_only_a_local_session_goes_without_a_shared_folder():
    from types import SimpleNamespace

    from parityloom.operators.common import shared_folder

    session = lambda master, given=None: SimpleNamespace(conf=SimpleNamespace(get=lambda *a: given), sparkContext=SimpleNamespace(master=master))
    assert shared_folder(session("local[4]")) and shared_folder(session("local")) and shared_folder(session("spark://x", "hdfs://y/")) == "hdfs://y"
    for master in ("local-cluster[2,1,1024]", "spark://x"):
        with pytest.raises(ValueError):
            shared_folder(session(master))
