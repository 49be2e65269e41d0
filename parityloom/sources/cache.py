"""Results kept by what they were computed of: the key is a hash of the inputs, so a changed input is another result."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Numbers that agree in so many places are the same.
PLACES = 12


def signature(inputs: Mapping[str, Mapping[str, float]]) -> str:
    """The SHA-256 of distributions by name, in whatever order their entries are."""
    body = {name: sorted((str(k), round(float(v), PLACES)) for k, v in d.items()) for name, d in inputs.items()}
    return hashlib.sha256(json.dumps(body, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def table_signature(*tables: DataFrame) -> str:
    """The same for tables (category, p) of any size: each is a number of rows and sums of their hashes, which have no order."""
    parts = []
    for df in tables:
        row = lambda seed: F.xxhash64(F.lit(seed), F.col("category").cast("string"), F.round(F.col("p").cast("double"), PLACES) + F.lit(0.0)).cast("decimal(20,0)")
        got = df.agg(F.count(F.lit(1)), F.sum(row(1)), F.sum(row(2))).head()
        parts.append([str(x) for x in got])
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def kept(spark: SparkSession, folder: str, name: str, key: str, compute: Callable[[], DataFrame], days: float | None = None) -> tuple[DataFrame, bool]:
    """(table, found): the table kept under name and key if it is there whole and not older than days; else it is computed, written once, and read.

    Two that compute the same at once write the same; the folder must be shared by all machines. A result that has aged is replaced.
    """
    path = f"{folder.rstrip('/')}/{name}/{key}"
    fs, done = _files(spark, f"{path}/_SUCCESS")
    if fs.exists(done) and (days is None or time.time() * 1000 - fs.getFileStatus(done).getModificationTime() <= days * 86_400_000):
        return spark.read.parquet(path), True
    compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), False


def aged_out(spark: SparkSession, folder: str, name: str, days: float) -> list[str]:
    """Delete the results of a name that are older than days; their keys."""
    fs, base = _files(spark, f"{folder.rstrip('/')}/{name}")
    gone = []
    for s in fs.listStatus(base) if fs.exists(base) else []:
        _, done = _files(spark, f"{s.getPath()}/_SUCCESS")
        at = fs.getFileStatus(done).getModificationTime() if fs.exists(done) else s.getModificationTime()
        if time.time() * 1000 - at > days * 86_400_000:
            fs.delete(s.getPath(), True)
            gone.append(s.getPath().getName())
    return gone
