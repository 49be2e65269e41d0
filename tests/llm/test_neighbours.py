"""Neighbours against brute force: few vectors, repeated rows, and recall where buckets choose."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parityloom.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<double>"


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


def brute(rows, k=5):
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (i, v) in enumerate(fine):
        if i % 50 == 0:
            others = [(-cosine(v, w), j) for b, (j, w) in enumerate(fine) if b != at and len(w) == len(v)]
            others = sorted((round(s, 9), j) for s, j in others)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(others, 1)]
    return Counter((q, r, j, round(s, 6) + 0.0) for q, r, j, s in out)


def found(spark, rows, k=5, schema=SCHEMA):
    got = neighbours.nearest(spark.createDataFrame(rows, schema), F.col("id") % 50 == 0, k)
    return Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6) + 0.0) for r in got.collect())


@pytest.mark.parametrize("n", [0, 1, 2, 4, 6, 60])
def test_few_vectors(spark, n):
    rng = random.Random(n)
    rows = [(25 * i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(n)]
    got = found(spark, rows)
    assert got if n > 1 else not got
    if n <= 6:
        assert got == brute(rows)
    assert Counter(q for q, *_ in got.elements()) == Counter(q for q, *_ in brute(rows).elements())


def test_repeated_rows_ids_and_invalid_vectors(spark):
    v = [[1.0, 0.0, 2.0, 0.5], [0.0, 1.0, -1.0, 0.0], [3.0, 1.0, 0.0, 0.0], [-1.0, 2.0, 2.0, 1.0]]
    rows = [(0, v[0]), (0, v[0]), (0, v[1]), (50, v[0]), (7, v[0]), (100, v[2]), (100, v[3]), (3, [0.0] * 4), (4, None), (None, v[0]), (5, [1.0, None, 0.0, 0.0]), (6, [float("nan"), 1.0, 0.0, 0.0]), (8, [1.0, 2.0]), (150, [2.0, 1.0]), (200, [1.0] * 3), (9, [-0.0, 1.0, -1.0, 0.0])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, 2) == brute(rows, 2)


def test_many_copies_of_one_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(130)] + [(500, [1.0, 2.0, 3.1])]
    assert found(spark, rows) == brute(rows)


def test_recall_at_128_dimensions(spark):
    x = np.random.default_rng(5).normal(size=(2500, 128))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {(r["query_id"], r["vec_id"]) for r in neighbours.nearest(df, F.col("id") % 50 == 0).collect()}
    s = x[::50] @ x.T
    s[np.arange(50), np.arange(0, 2500, 50)] = -2
    assert len(got & {(50 * i, j) for i, r in enumerate(np.argsort(-s)[:, :5].tolist()) for j in r}) >= 0.9 * 250


def test_query(spark):
    got = queries.op10_neighbours(spark, "/root/testdata/sf0.001").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows)
    mine = Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in got)
    pairs = {(q, j) for q, _, j, _ in want}
    assert len({(q, j) for q, _, j, _ in mine} & pairs) >= 0.9 * len(pairs) and sum(mine.values()) == sum(want.values())
