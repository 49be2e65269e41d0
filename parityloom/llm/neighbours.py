"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform.
Its table puts a unit vector in the bucket of the signed axis nearest to the
rotated vector. A query looks into the buckets of its PROBES nearest signed axes
in each of TABLES tables, GROWTH times as many with each doubling of the dimensions
beyond 64; all vectors there are compared exactly. Tables of all sizes are searched alike.

A query that met fewer than k others there is compared with all vectors, so it has k neighbours
wherever there are so many.

Equal vectors are compared once: of each, the k + 1 smallest ids are carried, repeats included, and
no other copy can be among the k nearest. Buckets are dealt out in blocks of
vectors and of queries whose numbers follow the counted sizes, so no task holds
more than one block of each.

Vectors that are null, zero or hold null or non-finite components take no part.
Null ids take no part either. Only vectors of one length are compared. Ties go to
the smaller id. Every row but the query's own is a candidate, one of the same id or of the same id and vector too; of
repeated query rows each has its ranks. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

TABLES, PROBES, SEED = 7, 14, 11
#: Measured: the same share of more axes finds less.
GROWTH = 2.6
VECTORS, QUERIES = 4_096, 512
#: Beyond the k nearest of a block, those so close to the last that rounding could matter.
MARGIN = 1e-9
HASHED = "dim int, t int, bucket int, id long, key long, ids array<bigint>, v array<double>"
PART = "query_id long, qkey long, key long, n int, vec_id long, score double"
BUCKET = ["dim", "t", "bucket"]


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two of columns), orthonormal."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, t: int) -> np.ndarray:
    """The rows after pseudo-rotation t, padded with zeros to a power of two."""
    d = 1 << max(0, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    rng = np.random.default_rng([SEED, t, d])
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], d))
    return x


def axes(x: np.ndarray, t: int, probes: int) -> np.ndarray:
    """The signed axes nearest to each rotated row, nearest first; axis a of -x is a + d."""
    r = rotated(x, t)
    both = np.concatenate([r, -r], axis=1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def probes_of(dim: int, probes: int = PROBES) -> int:
    """Probes a table for vectors of a length: beyond 64 dimensions, GROWTH times as many for twice the axes."""
    doubled = max(0, max(0, dim - 1).bit_length() - 6)
    return round(probes * GROWTH**doubled)


def _hashed(rows: DataFrame, tables: int, probes: int | None) -> DataFrame:
    """One row for each table and probe of (id, key, ids, v); without probes, for the nearest axis alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, key, lists, vectors = b.column(0), b.column(1), b.column(2), [np.array(v) for v in b.column(3).to_pylist()]
            for dim in sorted({len(v) for v in vectors}):
                at = np.array([i for i, v in enumerate(vectors) if len(v) == dim])
                x = np.stack([vectors[i] for i in at])
                x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the norm
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for t in range(tables):
                    got = axes(x, t, probes_of(dim, probes) if probes else 1)
                    who = np.repeat(at, got.shape[1])
                    take = pa.array(who)
                    yield pa.record_batch(
                        [pa.array(np.full(len(who), dim, np.int32)), pa.array(np.full(len(who), t, np.int32)), pa.array(got.ravel().astype(np.int32)), ids.take(take), key.take(take), lists.take(take), b.column(3).take(take)],
                        [*BUCKET, "id", "key", "ids", "v"],
                    )

    return rows.select("id", "key", "ids", "v").mapInArrow(run, HASHED)


def valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _met(index: DataFrame, probed: DataFrame, k: int) -> DataFrame:
    """The k + 1 nearest of each query in each block of its buckets, one row an id, as PART says."""
    sizes = index.groupBy(BUCKET).count().withColumn("blocks", F.ceil(F.col("count") / VECTORS).cast("int")).drop("count")
    wide = probed.groupBy(BUCKET).count().withColumn("lots", F.ceil(F.col("count") / QUERIES).cast("int")).drop("count")
    both = saved(sizes.join(wide, BUCKET), "buckets")  # one row a table and axis
    of = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(F.broadcast(both), BUCKET).withColumn("block", of("v", "blocks")).withColumn("lot", every("lots"))
    right = probed.join(F.broadcast(both), BUCKET).withColumn("lot", of("id", "lots")).withColumn("block", every("blocks"))
    group = [*BUCKET, "block", "lot"]

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c.split()[0]: [] for c in PART.split(", ")})
        x, q = np.stack(a["v"].to_numpy()), np.stack(b["v"].to_numpy())
        xs, qs = (m / np.abs(m).max(1, keepdims=True) for m in (x, q))
        xn, qn = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (xs, qs))
        rough = qn @ xn.T
        keep = min(k + 1, rough.shape[1])
        last = np.partition(rough, -keep, axis=1)[:, -keep]
        i, j = np.nonzero(rough >= (last - MARGIN)[:, None])
        score = np.sum(qs[i] * xs[j], axis=1) / (np.sqrt(np.sum(qs[i] ** 2, axis=1)) * np.sqrt(np.sum(xs[j] ** 2, axis=1)))
        ids, owner, key, qkey = a["ids"].to_numpy(), b["id"].to_numpy(), a["key"].to_numpy(), b["key"].to_numpy()
        n = np.array([len(ids[c]) for c in j])
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out = pd.DataFrame({"query_id": np.repeat(owner[i], n), "qkey": np.repeat(qkey[i], n), "key": np.repeat(key[j], n), "n": place, "vec_id": np.concatenate([np.asarray(ids[c], np.int64) for c in j]), "score": np.repeat(score, n)})
        # of the query's own vector, one row of its own id is the query
        own = (out["key"] == out["qkey"]) & (out["vec_id"] == out["query_id"])
        return out[~(own & ~out[own].duplicated(["query_id", "qkey"]).reindex(out.index, fill_value=True))]

    return left.select(*group, "ids", "key", "v").groupBy(group).cogroup(right.select(*group, "id", "key", "v").groupBy(group)).applyInPandas(search, PART)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, tables: int = TABLES, probes: int = PROBES, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query; is_query speaks of id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & valid(F.col("v")))
    # one number for equal vectors; 0.0 and -0.0 are equal
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("key", F.xxhash64("v"))
    copies = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1)
    distinct = saved(few.groupBy("v", "key").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("id", F.col("ids")[0]), "vectors")
    queries = saved(rows.where(is_query).groupBy("id", "v", "key").agg(F.count(F.lit(1)).alias("times")).withColumn("ids", F.array("id")), "queries")
    index = saved(_hashed(distinct, tables, None), "index")
    probed = saved(_hashed(queries, tables, probes), "probes")
    pair = ["query_id", "qkey", "key", "n", "vec_id"]
    once = saved(_met(index, probed, k).groupBy(pair).agg(F.max("score").alias("score")), "met")
    # queries with fewer than k are tried on all vectors, block by block
    enough = once.groupBy("query_id", "qkey").count().where(F.col("count") >= k).select(F.col("query_id").alias("id"), F.col("qkey").alias("key"))
    whole = lambda df: df.select(F.size("v").alias("dim"), F.lit(-1).alias("t"), F.lit(0).alias("bucket"), "id", "key", "ids", "v")
    short = saved(queries.join(enough, ["id", "key"], "left_anti"), "short")
    if not short.isEmpty():
        once = once.unionByName(_met(whole(distinct), whole(short), k)).groupBy(pair).agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    best = once.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    times = queries.where("times > 1").select(F.col("id").alias("query_id"), F.col("key").alias("qkey"), "times")
    again = best.join(times, ["query_id", "qkey"], "left").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("times", F.lit(1)))))
    return again.select("query_id", "rank", "vec_id", "score")
