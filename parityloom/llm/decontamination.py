"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are lower-cased runs of letters and digits. A
document is compared with the items that share a run of SEED words with it (an
item with fewer words: all of them). The pair is tiled: the longest common runs
of unmarked words, found by running Karp-Rabin hashes, are marked again and
again, from long to short, until none of at least SEED words is left. Tiles don't
overlap and may stand in any order, so a passage whose sentences were moved is
covered all the same. A document is contaminated if the tiles cover at least
`least_coverage` of an item's words.

The items' seeds are sent to all tasks if the items have at most BROADCAST_WORDS
words; beyond that, documents and items meet in a shuffled join on the seeds.

Nulls: null texts are empty; empty documents are clean; items without a word
match nothing; null ids are kept. Equal items are items of their own, and of
equally covered ones the smallest id is named. Repeated documents are judged each
for itself. Empty tables give no rows, or clean documents. Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, saved, small_batches

SEED, LEAST_COVERAGE, BROADCAST_WORDS = 5, 0.7, 1_000_000
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
VERDICT = "doc_id long, item_id long, coverage double, n_tiles int, item_ids array<bigint>"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` ids, modulo 2**64."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * _BASE + (ids[j : j + n].astype(np.uint64) + np.uint64(2))
    return out


def tiles(item: np.ndarray, text: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiling as (place in item, place in text, length); ids below 0 match nothing."""
    free_i, free_t = item >= 0, text >= 0
    out: list[tuple[int, int, int]] = []
    size = max(least, min(20, len(item)))
    while True:
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        places: dict[int, list[int]] = defaultdict(list)
        for hashes, free, put in ((_rolling(text, size), free_t, True), (_rolling(item, size), free_i, False)):
            open_ = np.convolve(free, np.ones(size, int), "valid") == size if len(free) >= size else np.zeros(0, bool)
            for at in np.flatnonzero(open_).tolist():
                if put:
                    places[int(hashes[at])].append(at)
                    continue
                for t in places.get(int(hashes[at]), ()):
                    if at and t and free_i[at - 1] and free_t[t - 1] and item[at - 1] == text[t - 1]:
                        continue  # the end of a match that starts earlier
                    n = 0
                    while at + n < len(item) and t + n < len(text) and free_i[at + n] and free_t[t + n] and item[at + n] == text[t + n]:
                        n += 1
                    if n >= size:
                        found[n].append((at, t))
        if found and max(found) > 2 * size:
            size = max(found)
            continue
        marked = cut = False
        for n in sorted(found, reverse=True):
            for i, t in found[n]:
                if free_i[i : i + n].all() and free_t[t : t + n].all():
                    out.append((i, t, n))
                    free_i[i : i + n] = False
                    free_t[t : t + n] = False
                    marked = True
                else:
                    cut = True
        if marked and cut:
            continue  # a match was cut by a tile; what is left of it is tried again
        if size == least:
            return out
        size = max(least, size // 2)


class Items:
    """The items, with the places of their seeds."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        seeds: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in rows:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)], np.int64)
            if len(ids):
                size = min(SEED, len(ids))
                for h in _rolling(ids, size).tolist():
                    seeds[size][h].add(len(self.items))
                self.items.append((item_id, ids))
        self.seeds = {k: {h: sorted(v) for h, v in x.items()} for k, x in seeds.items()}
        self.sorted = {k: np.array(sorted(x), np.uint64) for k, x in self.seeds.items()}

    def judge(self, text: str, least_coverage: float) -> tuple[int | None, float, int, list[int]]:
        """(best item, its coverage, its tiles, items covered enough)."""
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words(text)], np.int64)
        at: dict[int, set[int]] = defaultdict(set)
        for size, known in self.sorted.items():
            if len(ids) < size:
                continue
            inside = np.convolve(ids >= 0, np.ones(size, int), "valid") == size
            if not inside.any():
                continue
            places = np.flatnonzero(inside)
            hashes = _rolling(ids, size)[places]
            k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for p in np.flatnonzero(known[k] == hashes).tolist():
                for i in self.seeds[size][int(hashes[p])]:
                    at[i].add(int(places[p]))
        best: tuple[int | None, float, int] = (None, 0.0, 0)
        hits = []
        for i in sorted(at, key=lambda i: (self.items[i][0] is None, self.items[i][0] or 0)):
            item_id, item = self.items[i]
            keep = np.zeros(len(ids), bool)
            for p in at[i]:  # a match holds a seed, so it lies within an item's length of one
                keep[max(0, p - len(item)) : p + len(item) + SEED] = True
            # a run that is left out ends in one word that matches nothing
            edge = keep | np.append(False, keep[:-1])
            found = tiles(item, np.where(keep, ids, -1)[edge], min(SEED, len(item)))
            coverage = sum(n for _, _, n in found) / len(item)
            if coverage > best[1]:
                best = (item_id, coverage, len(found))
            if coverage >= least_coverage:
                hits.append(item_id)
        return (*best, hits)


def _seeds(text: Column) -> Column:
    """Distinct hashes of the runs of SEED words; all words of a shorter text."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))

    def hashes(w: Column) -> Column:
        size = F.least(F.lit(SEED), F.size(w))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - size + 1))
        return F.when(F.size(w) > 0, F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(w, i, size), " ")))))

    return let(tokens, hashes)


def _apart(texts: DataFrame, items: DataFrame, least_coverage: float) -> DataFrame:
    """Verdicts when the items are too many to send to every task: only pairs that share a seed meet."""
    short = F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))) < SEED
    keyed = saved(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    few = items.where(short)
    by_seed = items.where(~short).select("item_id", "text", F.explode(_seeds(F.col("text"))).alias("seed")).select("item_id", F.col("text").alias("item"), "seed")
    pairs = keyed.select("row", F.explode(_seeds(F.col("text"))).alias("seed")).join(by_seed, "seed").select("row", "item_id", "item").distinct()
    both = pairs.join(keyed, "row").select("row", "doc_id", "text", "item_id", "item")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            got = [Items([(r["item_id"], r["item"])]).judge(r["text"], least_coverage) for r in rows]
            yield pa.record_batch([pa.array([r["row"] for r in rows], pa.int64()), *_columns(got)], ["row", "item_id", "coverage", "n_tiles", "item_ids"])

    found = both.mapInArrow(judge, "row long, item_id long, coverage double, n_tiles int, item_ids array<bigint>")
    short_items = Items([(r["item_id"], r["text"]) for r in few.toLocalIterator()])
    found = found.unionByName(_sent(keyed, short_items, least_coverage, "row"))
    order = F.struct((-F.col("coverage")).alias("c"), F.col("item_id").alias("item_id"), F.col("n_tiles").alias("n_tiles"))
    best = found.groupBy("row").agg(F.min(order).alias("best"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    return keyed.join(best, "row", "left").select("doc_id", "best.item_id", F.coalesce(-F.col("best.c"), F.lit(0.0)).alias("coverage"), F.coalesce("best.n_tiles", F.lit(0)).alias("n_tiles"), F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"))


def _columns(got: list[tuple]) -> list[pa.Array]:
    kinds = (pa.int64(), pa.float64(), pa.int32(), pa.list_(pa.int64()))
    return [pa.array(list(c), k) for c, k in zip(zip(*got, strict=True) if got else ([],) * 4, kinds, strict=True)]


def _sent(texts: DataFrame, items: Items, least_coverage: float, key: str = "doc_id") -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [shared.value.judge(t, least_coverage) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), *_columns(got)], [key, "item_id", "coverage", "n_tiles", "item_ids"])

    return texts.select(key, "text").mapInArrow(judge, VERDICT.replace("doc_id", key))


def contamination(docs: DataFrame, benchmark: DataFrame, least_coverage: float = LEAST_COVERAGE, broadcast_words: int = BROADCAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, item_ids, contaminated) of every row."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    if size <= broadcast_words:
        out = _sent(texts, Items([(r["item_id"], r["text"]) for r in items.collect()]), least_coverage)
    else:
        out = _apart(texts, items, least_coverage)
    return out.withColumn("contaminated", F.size("item_ids") > 0)


def kept(docs: DataFrame, benchmark: DataFrame, least_coverage: float = LEAST_COVERAGE, broadcast_words: int = BROADCAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no item, with all their columns. Rows are told apart by id and text."""
    key = next(k for k in map("row_key{}".format, range(len(docs.columns) + 1)) if k not in docs.columns)
    keyed = docs.withColumn(key, F.xxhash64(id_col, text_col))
    found = contamination(keyed, benchmark, least_coverage, broadcast_words, key, text_col)
    return keyed.join(found.where("contaminated").select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)
