"""What the operators of this subpackage share: saved tables, folds, batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch. Texts may have 100,000 characters and more, so a
#: worker holds few of them at a time.
ARROW_ROWS = 256


@cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="parityloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share. Only a local session may go without: it takes a folder of its own."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (given or _own_folder()).rstrip("/")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def saved(df: DataFrame, tag: str, codec: str = "snappy") -> DataFrame:
    """Cut the lineage of df: write it to the shared folder and read it again.

    What was shuffled for it goes once it is written; nothing reads that again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def unused(columns: list[str], name: str) -> str:
    """name, or name with as many underscores as it takes to be none of columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text", nulls_first: bool = True) -> DataFrame:
    """docs with a number of each row, in the order of the ids.

    It is the id itself where all have one of their own. If ids are null or repeated,
    rows are sorted by id and by the hash of their text, numbered and saved; rows that
    are equal in both spread over tasks as well.
    """
    doc = F.col(id_col).cast("long")
    if docs.select(doc.alias("id")).groupBy("id").count().where("count > 1 OR id IS NULL").isEmpty():
        return docs.withColumn(name, doc)
    columns = docs.columns
    tie = unused(columns, "tie")
    order = [doc.asc_nulls_first() if nulls_first else doc.asc_nulls_last(), F.xxhash64(text_col), F.col(tie)]
    placed = docs.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(shuffle_width(docs.sparkSession), *order).sortWithinPartitions(*order)
    return saved(placed.select(*columns, F.monotonically_increasing_id().alias(name)), "numbered", "zstd")


def small_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches of long texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; 0 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def runs(texts: list[str], chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Slices of texts of about so many characters each, at least one text."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once even where use has it in a lambda."""
    return F.transform(F.array(value), use)[0]
