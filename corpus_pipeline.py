"""The training-data pipeline: raw documents to packed token sequences.

Every stage reads what the stage before it wrote. A toxic document goes; lines
that repeat an earlier line go; of each group of near copies the document with
the smallest id stays; documents that hold a benchmark item go; what is left is
packed. No row goes for its id being null or repeated; a null id is the largest among
near copies. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityloom.llm import decontamination, line_dedup, packing, queries, simhash, toxicity
from parityloom.llm.common import saved, table

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    model = toxicity.trained(table(spark, sf_dir, "documents"), labels, ~queries.held_out(queries.TOXIC_FOLD))
    return toxicity.kept(docs, model, queries.LEAST_SCORE)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_later(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.kept(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer("byte_bpe_50k.json"), queries.WINDOW, queries.PACK_END, literal=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    out = STAGES[-1][1](spark, docs, sf_dir)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
