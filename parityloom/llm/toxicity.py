"""Toxic passages by maximum-scoring segments.

Each word has a log-odds of toxic against other documents under a Dirichlet prior
that follows the overall word frequencies. Words whose log-odds is not
significant share one small negative score, so an ordinary passage scores below
zero. One linear scan of a document finds every maximal-scoring segment. A
segment's chance of arising in ordinary text follows the extreme-value law of
local scores: with lambda from sum p exp(lambda s) = 1, a document of n words has
K n exp(-lambda S) such segments expected; K is fitted to the best segments of the ordinary training rows. The scores of significant segments are
added, and a logistic curve, fitted on the training rows, maps the sum to 0..1.

The model is fitted on at most SAMPLE_ROWS labelled rows of each label, those
with the smallest hashes of their ids, of texts of at most SAMPLE_CHARS. Everything else covers all rows.

Nulls: a null text is an empty one, a null id is kept. An empty text has no
segments and gets the score of an ordinary document. Repeated rows are scored
each for itself; a repeated label row counts once. Without labels of both kinds
the score is 0 for all. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches

SAMPLE_ROWS, SAMPLE_CHARS = 3_000, 20_000
#: Words the prior is worth, its least part of a word, least significance and log-odds of a word, largest part of a
#: toxic passage's words that are ordinary, and p-value of a significant segment.
PRIOR, LEAST_PRIOR, LEAST_Z, LEAST_ODDS, ORDINARY, P_VALUE = 20.0, 0.5, 3.5, 1.5, 0.9, 0.002
#: Lengths of the word starts that are tokens besides the words.
STARTS = (4, 5, 6, 7)
_WORD = re.compile(r"[^\W\d_]+")
SEGMENTS = "doc_id long, evidence double, n_words long, segments array<struct<start:int,end:int,score:double>>"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str) -> list[str]:
    """The word and its starts of some lengths: inflected forms share their start."""
    return [word, *(word[:k] + "-" for k in STARTS if len(word) >= k)]


@dataclass
class Model:
    scores: dict[str, float]
    ordinary: float
    rate: float  # lambda of the extreme-value law
    scale: float  # K
    slope: float = 0.0
    shift: float = -30.0

    def __post_init__(self) -> None:
        self.gate = {f[:3] for f in self.scores}

    def all_segments(self, tokens: list[str]) -> list[tuple[int, int, float]]:
        """All maximal-scoring segments as (first word, end word, score)."""
        get, gate = self.scores.get, self.gate
        some = [(i, w) for i, w in enumerate(tokens) if w[:3] in gate]
        hits = [(i, s) for i, w in some if (s := max((get(f, 0.0) for f in features(w)), default=0.0)) > 0]
        return maximal_segments(hits, self.ordinary) if hits else []

    def segments(self, tokens: list[str]) -> list[tuple[int, int, float]]:
        """The significant ones of them."""
        found = self.all_segments(tokens)
        least = math.log(self.scale * len(tokens) / -math.log1p(-P_VALUE)) / self.rate if found else 0.0
        return [x for x in found if x[2] >= least]

    def evidence(self, found: list[tuple[int, int, float]], n_words: int) -> float:
        """Sum of the significant segments' scores in units of the law, less the search for them."""
        return sum(self.rate * s for _, _, s in found) - math.log(self.scale * n_words + 1.0) if found else 0.0

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.slope * evidence + self.shift))))


def maximal_segments(hits: list[tuple[int, float]], ordinary: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence in which unlisted places score `ordinary`.

    The scan keeps candidate segments with the cumulative score before and at the
    end of each. A new one joins the nearest earlier one that starts lower, if
    that one also ends lower; negative places never start or end a segment. Each
    remembers the nearest earlier one that starts lower, so that those between are
    never looked at again and the scan is linear.
    """
    kept: list[list] = []  # [start, end, score before, score at the end, place of the nearest lower start]
    total, last = 0.0, 0
    for at, score in hits:
        total += (at - last) * ordinary
        last = at + 1
        before, total = total, total + score
        if score <= 0:
            continue
        begin, j = at, len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= total:
                kept.append([begin, at + 1, before, total, j])
                break
            begin, before, lower = kept[j][0], kept[j][2], kept[j][4]
            del kept[j:]
            j = lower
    return [(a, b, end - start) for a, b, start, end, _ in kept]


def _law(scores: np.ndarray, p: np.ndarray) -> float:
    """lambda of the local scores under the ordinary word rates p."""
    low, high = 1e-6, 1.0
    f = lambda x: float(np.sum(p * np.exp(x * scores)) - 1.0)
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def _scale(best: list[tuple[int, float]], rate: float) -> float:
    """The likeliest K for (number of words, best score) of ordinary texts; 0 is the best score where nothing scores.

    The best score of n words is at most S with probability exp(-K n exp(-lambda S)), so n exp(-lambda S) of the best
    score is exponential with rate K.
    """
    expected = [n * math.exp(-rate * s) for n, s in best if n]
    return len(expected) / sum(expected) if expected else 1.0


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the largest F1 of label 1, midway between neighbouring scores."""
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hit = np.cumsum(y)
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k] - 1e-6)


def _logistic(x: np.ndarray, y: np.ndarray, cut: float = 0.3) -> tuple[float, float]:
    """Slope and shift of a logistic curve, moved so that the best threshold lands on cut."""
    top = max(1e-9, float(np.abs(x).max()))
    a = b = 0.0
    z = x / top
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([np.sum((p - y) * z) + 1e-3 * a, np.sum(p - y)])
        h = np.array([[np.sum(w * z * z) + 1e-3, np.sum(w * z)], [np.sum(w * z), np.sum(w)]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
        a = max(a, 1e-3)
    a /= top
    return float(a), float(math.log(cut / (1 - cut)) - a * best_threshold(x, y))


def fit(rows: list[tuple[str, int]]) -> Model:
    """A model from (text, label) rows.

    A word counts once a text, and near copies of a text (those with the same
    smallest hash of a word pair) count once, so that copies of one text don't make
    its rare words look toxic.
    """
    counts, seen, size = [Counter(), Counter()], set(), [0, 0]
    length = 1
    for text, y in rows:
        t = words(text)
        length += 0 if y else len(t)
        mark = min((crc32(f"{a} {b}".encode()) for a, b in zip(t, t[1:], strict=False)), default=-len(t))
        if (mark, y) not in seen:
            seen.add((mark, y))
            counts[y].update({f for w in set(t) for f in features(w)})
            size[y] += 1
    if not all(size):
        return Model({}, -0.1, 1.0, 1.0)
    n, scores, rates = sum(size), {}, {}
    for f, c1 in counts[1].items():
        c0 = counts[0][f]
        prior = LEAST_PRIOR + PRIOR * (c0 + c1) / n
        odds = [math.log((c + prior) / (m + PRIOR + LEAST_PRIOR - c)) for c, m in ((c1, size[1]), (c0, size[0]))]
        delta, spread = odds[0] - odds[1], math.sqrt(1 / (c1 + prior) + 1 / (c0 + prior))
        if delta / spread >= LEAST_Z and delta > LEAST_ODDS:
            scores[f], rates[f] = delta, (c0 + LEAST_PRIOR) / length
    # a word start that says no more than a shorter one is left out
    for f in sorted(scores, key=len, reverse=True):
        if any(g != f and scores.get(g, 0.0) >= scores[f] for g in features(f.rstrip("-"))):
            del scores[f], rates[f]
    model = Model(scores, math.log(ORDINARY), 1.0, 1.0)
    if scores:
        s, p = np.array(list(scores.values())), np.array([rates[w] for w in scores])
        model.rate = _law(np.append(s, model.ordinary), np.append(p, 1 - p.sum()))
        tokens = [words(text) for text, y in rows if not y]
        model.scale = _scale([(len(t), max((v for *_, v in model.all_segments(t)), default=0.0)) for t in tokens], model.rate)
        x = np.array([model.evidence(model.segments(t := words(text)), len(t)) for text, _ in rows])
        y = np.array([y for _, y in rows])
        if len(set(x.tolist())) > 1:
            model.slope, model.shift = _logistic(x, y)
    return model


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most `rows` training rows of each label as (text, label), chosen by hash of the id.

    Labels of an id that disagree leave it out; the ids that are kept are few
    enough to be broadcast.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(train)
    marked = marked.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("doc_id", "y")
    few = None
    for y in (0, 1):
        part = marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        few = part if few is None else few.unionByName(part)
    few = saved(few, "sample")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    got = texts.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(few), "doc_id").select("text", "y")
    return [(r["text"], r["y"]) for r in got.toLocalIterator()]


def toxic_segments(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, evidence, n_words, segments) of every row; segments by word numbers."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        names = ["doc_id", "evidence", "n_words", "segments"]
        for b in batches:
            evidence, counts, segments = [], [], []
            for text in b.column(1).to_pylist():
                tokens = words(text)
                found = model.segments(tokens)
                evidence.append(model.evidence(found, len(tokens)))
                counts.append(len(tokens))
                segments.append([{"start": s, "end": e, "score": v} for s, e, v in found])
            yield pa.record_batch([b.column(0), pa.array(evidence, pa.float64()), pa.array(counts, pa.int64()), pa.array(segments, kind)], names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(model.slope) * F.col("evidence") + F.lit(model.shift)))
    return texts.mapInArrow(scan, SEGMENTS).withColumn("score", 1 / (1 + F.exp(-z)))


def trained(docs: DataFrame, labels: DataFrame, train: Column) -> Model:
    """A model from the labelled rows for which train holds."""
    return fit(sample_rows(docs, labels, "toxic", train, SAMPLE_ROWS))


def kept(docs: DataFrame, model: Model, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is below least_score, with all their columns, in one pass."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = [words(t or "") for t in b.column(at).to_pylist()]
            fine = [model.probability(model.evidence(model.segments(t), len(t))) < least_score for t in tokens]
            yield b.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(sift, docs.schema)
