"""File streams, event-time windows, running aggregates, and batches that are safe to run twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(fmt).load(path)


def timed(df: DataFrame, ts: str, late: str | None = None) -> DataFrame:
    """ts as an instant, with a watermark if one is asked for; zone-less times are read in the session's zone."""
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withWatermark(ts, late) if late else out


def tumbling(df: DataFrame, ts: str, width: str, by: Sequence[str], *aggs: Column) -> DataFrame:
    got = df.groupBy(F.window(ts, width).alias("w"), *by).agg(*aggs)
    return got.select(F.col("w.start").alias("start"), *[c for c in got.columns if c != "w"])


def sliding(df: DataFrame, ts: str, width: str, step: str, by: Sequence[str], *aggs: Column) -> DataFrame:
    got = df.groupBy(F.window(ts, width, step).alias("w"), *by).agg(*aggs)
    return got.select(F.col("w.start").alias("start"), *[c for c in got.columns if c != "w"])


def sessions(df: DataFrame, ts: str, gap: str, by: Sequence[str], *aggs: Column) -> DataFrame:
    """Sessions end when no event follows within the gap; one exactly a gap later starts a new one."""
    got = df.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(*aggs)
    return got.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *[c for c in got.columns if c != "w"])


def first_seen(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One event for each key within the watermark."""
    return df.dropDuplicatesWithinWatermark(list(keys))


def joined(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str) -> DataFrame:
    """Two streams on a key, right at most `within` after left; both sides need watermarks."""
    near = F.expr(f"r.{right_ts} between l.{left_ts} and l.{left_ts} + interval {within}")
    return left.alias("l").join(right.alias("r"), (F.col(f"l.{key}") == F.col(f"r.{key}")) & near)


def run_all(df: DataFrame, name: str, mode: str = "complete", checkpoint: str | None = None) -> DataFrame:
    """Run a stream over everything there is, into a table in memory."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    writer.start().awaitTermination()
    return df.sparkSession.table(name)


def to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", by: Sequence[str] = (), once: bool = False) -> StreamingQuery:
    """Exactly once into files; a restart goes on where the checkpoint says. once takes all in one batch: state with
    processing time has another batch to run for ever, so all there is now would never end."""
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).partitionBy(*by).outputMode("append")
    return (writer.trigger(once=True) if once else writer.trigger(availableNow=True)).start(path)


def each_batch(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """work(rows, number) for every batch; a number may come again after a failure, so work must overwrite by number."""
    return df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_metrics(path: str, fields: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Work for each_batch: shares of some fields, one folder a batch."""
    from ..operators.profile import field_shares

    def work(rows: DataFrame, number: int) -> None:
        field_shares(rows, fields).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return work


def slices(n: int, size: int) -> list[tuple[int, int]]:
    """Ranges of ids [first, end) of at most size."""
    return [(a, min(n, a + size)) for a in range(0, n, size)]


def generate_sliced(spark: SparkSession, make: Callable[[DataFrame], DataFrame], n: int, size: int, path: str, seed: int, on_progress: Callable[[int, int], None] | None = None) -> int:
    """Write n made rows slice by slice; a slice that stands complete is not made again.

    Rows are functions of (seed, id), so a run that is taken up later gives the
    same rows as one run. Fewer rows than were made before is an error.
    """
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = sorted(s.getPath().getName() for s in fs.listStatus(base)) if fs.exists(base) else []
    done = {x for x in there if x.startswith(f"seed={seed}-") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{x}/_SUCCESS"))}
    if any(int(x.rsplit("-", 1)[1]) > n for x in done):
        raise ValueError(f"{path} holds more than {n} rows")
    for a, b in slices(n, size):
        name = f"seed={seed}-{a:012d}-{b:012d}"
        if name not in done:
            make(spark.range(a, b)).write.mode("overwrite").parquet(f"{path}/{name}")
        if on_progress:
            on_progress(b, n)
    return n


def checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """(name, seed, first, end, complete, modified) of the slices that stand in a folder; one row a slice."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = []
    for s in fs.listStatus(base) if fs.exists(base) else []:
        name = s.getPath().getName()
        if name.startswith("seed="):
            seed, first, end = name.removeprefix("seed=").rsplit("-", 2)
            rows.append((name, int(seed), int(first), int(end), fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")), s.getModificationTime()))
    return spark.createDataFrame(rows, "name string, seed long, first long, end long, complete boolean, modified long")


def checkpoint_summary(spark: SparkSession, path: str, n: int) -> DataFrame:
    """(seed, slices, rows, part, latest): what is complete for each seed of n rows, and the slice that was written last."""
    done = checkpoints(spark, path).where("complete")
    rows = F.sum(F.col("end") - F.col("first"))
    return done.groupBy("seed").agg(F.count(F.lit(1)).alias("slices"), rows.alias("rows"), (rows / n).alias("part"), F.max_by("name", F.struct("modified", "name")).alias("latest"))


class Progress(StreamingQueryListener):
    """Rows and rates of all queries, gathered for a report."""

    def __init__(self):
        self.rows: list[tuple[str, int, float]] = []

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((p.name or str(p.id), p.numInputRows, p.processedRowsPerSecond))

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...
