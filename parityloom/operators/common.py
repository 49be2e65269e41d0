"""Checked broadcasts and tables cut from their lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it has at most so many rows; beyond it Spark chooses.
BROADCAST_ROWS = 100_000


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="parityloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share. Only a local session may go without: it takes a folder of its own."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (given or _own_folder()).rstrip("/")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it is counted to have at most `rows` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
