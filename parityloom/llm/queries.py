"""One thin query an operator, over its whole table; columns beyond the contract follow it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, html_text, idfile, line_dedup, neighbours, packing, pii, quality, simhash, source_divergence, spelling, suffix_tree, toxicity
from .common import fold, table

#: Documents of one fold are never learnt from: (number of folds, fold held out).
QUALITY_FOLD, TOXIC_FOLD, LM_FOLD = (5, 0), (4, 2), (10, 0)
LEAST_SCORE = 0.3
WINDOW, PACK_END, FILE_END = 1024, 0, 2
NEIGHBOURS, QUERY_STEP = 5, 50


def tokenizer(name: str) -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(folds: tuple[int, int], id_col: str = "doc_id"):
    return fold(F.col(id_col), folds[0]) == folds[1]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    every = F.array_sort(F.concat("base", "learned"))
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(every).alias("spans"), F.size("learned").cast("long").alias("n_learned"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), WINDOW, PACK_END, literal=False)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup.decisions(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("kept").cast("long").alias("n_kept"), F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.trained(docs, table(spark, sf_dir, "labels"), ~held_out(QUALITY_FOLD))
    return quality.scored(docs, model).select("doc_id", held_out(QUALITY_FOLD).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"), "n_passages", "focus")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = idfile.encoded(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), FILE_END, literal=False)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"), ~held_out(TOXIC_FOLD))
    got = toxicity.toxic_segments(docs, model)
    return got.select("doc_id", held_out(TOXIC_FOLD).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"), F.size("segments").cast("long").alias("n_segments"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "contaminated", "item_id", "coverage", "n_tiles", "item_ids")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_STEP == 0, NEIGHBOURS)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_tree.scored(table(spark, sf_dir, "documents"), ~held_out(LM_FOLD))
    return got.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_simhash, op3_packing, op4_line_dedup, op5_quality, op6_html, op7_token_file, op8_toxicity, op9_decontamination, op10_neighbours, op11_source_divergence, op12_lm_scoring, op13_spelling_variants)}
ORACLE: dict[str, str] = {"op11_source_divergence": source_divergence.SQL, "op13_spelling_variants": spelling.SQL}
