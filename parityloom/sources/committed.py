"""A sink for streams whose batches are there once, whole, or not at all: parts and a list of them for each batch.

Every attempt of a task writes parts of names of its own and tells the driver which. A batch is there when the
driver has moved its list into place, which is one rename. A batch that comes again after a failure finds its
list there, and its new parts are deleted. Parts of failed attempts stand in no list, so no reader sees them; `swept` deletes
them. The folder may be on any file system that all machines share and pyarrow knows: a path or a URI.

Formats are parquet (row groups and compression by option), jsonl, and csv with a header in each part; nested
values are JSON text in csv. A part ends after `rows_per_part` rows, so no writer holds more than one Arrow batch.
A batch without rows has an empty list.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

NAME = "committed"
LISTS = "_batches"


def place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    fs, base = pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)
    return fs, base.rstrip("/")


@dataclass
class Parts(WriterCommitMessage):
    names: list[str] = field(default_factory=list)
    rows: int = 0


class _Part:
    """One open file of a format."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str, fmt: str, schema: pa.Schema, options: dict[str, str]):
        self.out, self.fmt, self.rows = fs.open_output_stream(path), fmt, 0
        self.group = int(options.get("row_group_size", 10_000))
        if fmt == "parquet":
            self.to = pq.ParquetWriter(self.out, schema, compression=options.get("compression", "snappy"))
        elif fmt == "csv":
            self.nested = [i for i, f in enumerate(schema) if pa.types.is_nested(f.type)]
            self.schema = pa.schema([pa.field(f.name, pa.string()) if i in self.nested else f for i, f in enumerate(schema)])
            self.to = pyarrow.csv.CSVWriter(self.out, self.schema)

    def add(self, batch: pa.RecordBatch) -> None:
        self.rows += len(batch)
        if self.fmt == "parquet":
            self.to.write_table(pa.Table.from_batches([batch]), row_group_size=self.group)
        elif self.fmt == "csv":
            columns = [pa.array([None if x is None else json.dumps(x, default=str, ensure_ascii=False) for x in c.to_pylist()], pa.string()) if i in self.nested else c for i, c in enumerate(batch.columns)]
            self.to.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        else:
            self.out.write("".join(json.dumps(r, default=str, ensure_ascii=False) + "\n" for r in batch.to_pylist()).encode())

    def close(self) -> None:
        if self.fmt != "jsonl":
            self.to.close()
        self.out.close()


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.options, self.path, self.fmt = dict(options), options["path"], options.get("format", "parquet")
        if self.fmt not in ("parquet", "jsonl", "csv"):
            raise ValueError(f"no writer for {self.fmt}")
        self.most = int(options.get("rows_per_part", 1_000_000))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        fs, base = place(self.path)
        fs.create_dir(base, recursive=True)
        made, part = Parts(), None
        for batch in iterator:
            at = 0
            while at < len(batch):
                if part is None:
                    made.names.append(f"part-{uuid.uuid4().hex}.{self.fmt}")
                    part = _Part(fs, f"{base}/{made.names[-1]}", self.fmt, batch.schema, self.options)
                some = batch.slice(at, self.most - part.rows)
                part.add(some)
                at, made.rows = at + len(some), made.rows + len(some)
                if part.rows >= self.most:
                    part.close()
                    part = None
        if part is not None:
            part.close()
        return made

    def commit(self, messages: list[Parts | None], batchId: int) -> None:
        fs, base = place(self.path)
        target = f"{base}/{LISTS}/{batchId:012d}.json"
        if fs.get_file_info(target).type != pyarrow.fs.FileType.NotFound:
            self.abort(messages, batchId)  # this batch is there already
            return
        fs.create_dir(f"{base}/{LISTS}", recursive=True)
        body = {"batch": batchId, "parts": [n for m in messages if m for n in m.names], "rows": sum(m.rows for m in messages if m)}
        draft = f"{base}/{LISTS}/.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps(body).encode())
        fs.move(draft, target)

    def abort(self, messages: list[Parts | None], batchId: int) -> None:
        fs, base = place(self.path)
        for name in (n for m in messages if m for n in m.names):
            fs.delete_file(f"{base}/{name}")


class CommittedSink(DataSource):
    """Options: path, format, rows_per_part, and for parquet row_group_size and compression."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _Writer(self.options)


def start(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", **options: str | int) -> StreamingQuery:
    """Write a stream to a folder, all there is now; the same checkpoint goes on where it was."""
    df.sparkSession.dataSource.register(CommittedSink)
    writer = df.writeStream.format(NAME).option("path", path).option("format", fmt).option("checkpointLocation", checkpoint)
    for k, v in options.items():
        writer = writer.option(k, str(v))
    return writer.outputMode("append").trigger(availableNow=True).start()


def batches(path: str) -> list[dict]:
    """What the lists say: batch, parts and rows of each batch that is there, in order."""
    fs, base = place(path)
    found = fs.get_file_info(pyarrow.fs.FileSelector(f"{base}/{LISTS}", allow_not_found=True))
    names = sorted(f.path for f in found if f.base_name.endswith(".json"))
    out = []
    for n in names:
        with fs.open_input_stream(n) as f:
            out.append(json.loads(f.read()))
    return out


def read(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """The rows of all batches that are there."""
    fs, base = place(path)
    prefix = path.rstrip("/")
    parts = [f"{prefix}/{n}" for b in batches(path) for n in b["parts"]]
    if not parts:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("escape", '"').csv(parts)
    return reader.json(parts) if fmt == "jsonl" else reader.parquet(*parts)


def swept(path: str) -> int:
    """Delete the parts that no list names, once no query writes; how many there were."""
    fs, base = place(path)
    known = {n for b in batches(path) for n in b["parts"]}
    lost = [f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True)) if f.base_name.startswith("part-") and f.base_name not in known]
    for p in lost:
        fs.delete_file(p)
    return len(lost)
