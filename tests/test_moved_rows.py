"""What queries move and write on the way, where larger tables made it too much."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from parityloom.functions import nested
from parityloom.operators import raking
from parityloom.plans import people, quality


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_corrected_population_draws_ids_before_it_makes_records(spark):
    rows, _ = people.corrected(spark, 50)
    made, _, moved = plan(rows).partition("Window [")
    assert "ocean_openness" in made and "ocean_openness" not in moved and "mother_tongue" not in moved
    records = {r["id"]: r for r in people.generate(spark, 150).collect()}
    assert all(r[c] == records[r["source_id"]][c] for r in rows.collect() for c in ("name", "age", "age_group", "occupation", "ocean_openness"))


def test_raking_writes_cells_once_a_round_if_categories_are_few(spark, monkeypatch):
    tags, save = [], raking.saved
    monkeypatch.setattr(raking, "saved", lambda df, tag: tags.append(tag) or save(df, tag))
    rows = [(i % 3, i % 5 / 2, None if i % 7 == 0 else str(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b double, c string")
    targets = {"a": {"0": 1, "1": 2, "2": 3}, "b": {str(i / 2): i + 1 for i in range(5)}, "c": {"0": 2, "1": 1}}
    counted = df.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n_"))
    cells, done, _ = raking.rake_cells(counted, raking.long_targets(df, targets), list(targets), rounds=2, tolerance=0.0)
    got = {(r["a"], r["b"], r["c"]): r["weight"] for r in cells.collect()}
    assert done == 2 and tags.count("cells") == 3
    # the same by hand
    w, n = dict.fromkeys(set(rows), 1.0), Counter(rows)
    for _ in range(2):
        for k, goal in enumerate(targets.values()):
            sums, total = Counter(), sum(n[r] * w[r] for r in w)
            for r in w:
                sums[r[k]] += n[r] * w[r]
            w = {r: min(5.0, max(0.2, x * goal.get(str(r[k]), 0) / sum(goal.values()) * total / sums[r[k]])) for r, x in w.items()}
    assert got == pytest.approx(w)


def test_levels_of_a_tree_share_a_table(spark, monkeypatch):
    tags, save = [], nested.saved
    monkeypatch.setattr(nested, "saved", lambda df, tag: tags.append(tag) or save(df, tag))
    df = spark.createDataFrame([('{"a": {"b": [{"c": 1}, []]}, "d": null}',)], "j string").select(F.parse_json("j").alias("t"))
    got = {("/".join(r["path"]), r["kind"], r["value"]) for r in nested.tree_leaves(df, "t").collect()}
    assert got == {("a/b/0/c", "BIGINT", "1"), ("a/b/1", "ARRAY", "[]"), ("d", "VOID", None)} and len(tags) == 1


def test_trigrams_are_counted_as_numbers(spark):
    df = spark.createDataFrame([("a b c a b c d",), ("ab c d",), ("a bc d",), (None,), ("x y",)], "text string")
    got = quality.trigram_repetition(df, ["text"])
    assert got.first()[:2] == (6, 1) and "array_join" not in plan(got)
