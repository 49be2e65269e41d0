"""Token ids on disk: one compressed frame a document, one dictionary for all.

A dataset is a folder with two tables. `segments` has rows of (shard, segment,
first, dict_hash, doc_ids, n_tokens, offsets, payload): the frames of some
consecutive documents, where each frame starts, and how many ids of the shard
come before. Documents are in ascending order of id over shards, segments and
places. `dictionary` has the zstandard dictionary and its hash. Spark writes
both, so a task that is run again leaves nothing behind, in any store that Spark
can write to. A frame holds a document's ids as little-endian unsigned 32-bit
numbers and is decompressed alone, after one look at `offsets`.

Nulls: a null text is an empty one; a null id is kept and sorts first. An empty
text gives the end id. Repeated ids are kept, in the order of the hash of their
text. An empty table gives an empty dataset. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, shuffle_width, small_batches
from .encoding import encoder

#: The dictionary is trained on at most so many documents, those with the smallest
#: hashes of id and start of the text, of texts no longer than SAMPLE_CHARS. All documents are
#: compressed with it.
SAMPLE_DOCS, SAMPLE_CHARS = 800, 20_000
DICTIONARY_BYTES = 65_536
SEGMENT_DOCS, SEGMENT_BYTES, LEVEL = 512, 1_000_000, 3
SEGMENTS = "shard long, segment long, first long, dict_hash string, doc_ids array<bigint>, n_tokens array<bigint>, offsets array<bigint>, payload binary"
DECODED = "shard long, first long, doc_id long, n_tokens long, ids binary"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def train(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", literal: bool = True) -> bytes:
    """A dictionary from a bounded sample; empty if there is too little to learn from."""
    import zstandard

    # the start of a text tells rows of one id apart; whole texts are read once, by the filter
    drawn = F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(1 << 40))
    # four times the rows that are needed lie below this on average, so that few texts travel however many there are
    below = int((1 << 40) * min(1.0, 4 * SAMPLE_DOCS / max(1, docs.count())))
    texts = _texts(docs, id_col, text_col).withColumn("drawn", drawn)
    sample = texts.where((F.col("drawn") < below) & (F.length("text") <= SAMPLE_CHARS)).orderBy("drawn", "doc_id").limit(SAMPLE_DOCS)
    end = np.array([end_id], "<u4").tobytes()
    arrays = [x + end for x in encoder(tokenizer, literal).encode([r["text"] for r in sample.collect()])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def _hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", literal: bool = True) -> str:
    """Encode, sort by id and write; the path is returned. With literal, added tokens in a text are mere characters."""
    spark = docs.sparkSession
    small_batches(spark)
    dictionary = train(docs, tokenizer, end_id, id_col, text_col, literal)
    key, end = _hash(dictionary), np.array([end_id], "<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, shard = encoder(tokenizer, literal), TaskContext.get().partitionId()
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
        docs_: list[tuple] = []
        state = {"segment": 0, "first": 0, "bytes": 0}
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int64())] * 3 + [pa.binary()]
        names = ["shard", "segment", "first", "dict_hash", "doc_ids", "n_tokens", "offsets", "payload"]

        def row() -> pa.RecordBatch:
            ids, counts, frames = zip(*docs_, strict=True)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            values = [shard, state["segment"], state["first"], key, list(ids), list(counts), offsets, b"".join(frames)]
            state.update(segment=state["segment"] + 1, first=state["first"] + sum(counts), bytes=0)
            docs_.clear()
            return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                frame = press.compress(ids + end)
                docs_.append((doc, len(ids) // 4 + 1, frame))
                state["bytes"] += len(frame)
                if len(docs_) >= SEGMENT_DOCS or state["bytes"] >= SEGMENT_BYTES:
                    yield row()
        if docs_:
            yield row()

    texts = _texts(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    placed = texts.repartitionByRange(shuffle_width(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    placed.mapInArrow(segments, SEGMENTS).write.option("compression", "none").parquet(f"{path}/segments")
    spark.createDataFrame([(key, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    return path


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").collect()[0]
    if _hash(bytes(row["dictionary"])) != row["dict_hash"]:
        raise ValueError(f"the dictionary of {path} is not the one it was written with")
    return row["dict_hash"], bytes(row["dictionary"])


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents, or of some only.

    start counts the ids of all documents before it. With doc_ids, only the
    segments that hold them are read, and only their frames are decompressed.
    """
    key, dictionary = _dictionary(spark, path)
    wanted = None if doc_ids is None else set(doc_ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for b in batches:
            for r in b.to_pylist():
                if r["dict_hash"] != key:
                    raise ValueError("a segment was written with another dictionary")
                before = np.concatenate([[0], np.cumsum(r["n_tokens"])])[:-1] + r["first"]
                at = [i for i, d in enumerate(r["doc_ids"]) if wanted is None or d in wanted]
                ids = [unpress.decompress(r["payload"][r["offsets"][i] : r["offsets"][i + 1]]) for i in at]
                yield pa.record_batch(
                    [pa.array([r["shard"]] * len(at), pa.int64()), pa.array(before[at], pa.int64()), pa.array([r["doc_ids"][i] for i in at], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["shard", "first", "doc_id", "n_tokens", "ids"],
                )

    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    shards = sorted(map(tuple, segments.groupBy("shard").agg(F.sum(total)).collect()))  # as many rows as the files have shards
    base, bases = 0, []
    for shard, n in shards:
        bases.append((shard, base))
        base += n
    few = spark.createDataFrame(bases, "shard long, base long")
    hit = segments if wanted is None else segments.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(int(x)) for x in sorted(wanted)]).cast("array<bigint>")))
    # a segment of short documents grows when decompressed; each becomes a batch of its own
    small_batches(spark)
    found = hit.select([c.split()[0] for c in SEGMENTS.split(", ")]).mapInArrow(decode, DECODED)
    return found.join(F.broadcast(few), "shard").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", literal: bool = True) -> DataFrame:
    """Write to a new folder beside the checkpoints and read everything back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    return read(spark, write(docs, path, tokenizer, end_id, id_col, text_col, literal))
