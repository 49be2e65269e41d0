"""Document quality by attention over passages.

A document is a bag of passages of PASSAGE words. Each passage is encoded as a
vector of surface statistics (word lengths, repetition, case, punctuation,
symbols) and passed through one layer. A gated attention unit weighs the
passages, and a logistic unit scores their weighted mean. All weights are learned
together from document labels by gradient descent with momentum.

The model is fitted on at most SAMPLE_ROWS labelled rows of each label, those
with the smallest hashes of their ids, of texts of at most SAMPLE_CHARS.
Everything else covers all rows and all passages.

Nulls: a null text is an empty one, a null id is kept. An empty text has one
passage without words. Repeated rows are scored each for itself. Without labels
of both kinds the score is 0.5 for all. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import runs, small_batches
from .toxicity import best_threshold, sample_rows

PASSAGE, HIDDEN, ATTENTION = 96, 16, 8
SAMPLE_ROWS = 2_500
EPOCHS, RATE, DECAY, SEED = 250, 0.02, 1e-4, 7
N_FEATURES = 22
SCORED = "doc_id long, score double, n_passages int, focus int"
_PUNCTUATION = frozenset(".,;:!?|#*=+<>{}[]()&%$@\"'-_/\\~^")


def encode_passage(words: list[str]) -> list[float]:
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    text = " ".join(words)
    chars, count = len(text), Counter(words)
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    spread = (sum(x * x for x in lengths) / n - mean * mean) ** 0.5 if n > 1 else 0.0
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    pairs = len(set(zip(words, words[1:], strict=False)))
    symbols = sum(text.count(c) for c in _PUNCTUATION)
    return [
        min(n / PASSAGE, 1.0), mean / 10, spread / 10, len(count) / n, max(count.values()) / n, same / max(1, n - 1),
        pairs / max(1, n - 1), letters / chars, upper / max(1, letters), symbols / chars, sum(map(str.isdigit, text)) / chars,
        text.count(".") / n, text.count(",") / n, text.count("!") / n, text.count("|") / n, text.count("=") / n,
        sum(not any(map(str.isalnum, w)) for w in words) / n, sum(w[0].isupper() for w in words) / n, sum(x <= 3 for x in lengths) / n,
        sum(x > 20 for x in lengths) / n, sum(c for c in count.values() if c > 2) / n, sum(ord(c) > 0x24F for c in text) / chars,
    ]


def encode(text: str) -> np.ndarray:
    words = text.split()
    return np.array([encode_passage(words[i : i + PASSAGE]) for i in range(0, max(1, len(words)), PASSAGE)], np.float64)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    shift: float = 0.0

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple:
        """Score of each bag of rows of x that begins at starts, and what the gradient needs."""
        w = self.weights
        sizes = np.diff(np.append(starts, len(x)))
        z = (x - self.mean) / self.scale
        h = np.tanh(z @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        raw = (t * g) @ w["a"]
        top = np.repeat(np.maximum.reduceat(raw, starts), sizes)
        e = np.exp(raw - top)
        att = e / np.repeat(np.add.reduceat(e, starts), sizes)
        bag = np.add.reduceat(att[:, None] * h, starts)
        return bag @ w["c"] + w["d"], (z, h, t, g, att, bag, sizes)

    def score(self, bags: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Scores and the attention of each passage."""
        starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
        if not self.weights:
            return np.full(len(bags), 0.5), [np.full(len(b), 1 / len(b)) for b in bags]
        logit, (_, _, _, _, att, _, _) = self.forward(np.concatenate(bags), starts)
        return 1 / (1 + np.exp(-np.clip(logit + self.shift, -30, 30))), np.split(att, starts[1:])


def _gradients(w: dict, got: tuple, starts: np.ndarray, error: np.ndarray) -> dict:
    z, h, t, g, att, bag, sizes = got
    out = {"c": bag.T @ error, "d": error.sum(keepdims=True)}
    dbag = np.repeat(error[:, None] * w["c"], sizes, axis=0)
    along = (dbag * h).sum(1)
    draw = att * (along - np.repeat(np.add.reduceat(att * along, starts), sizes))
    out["a"] = (t * g).T @ draw
    dtg = draw[:, None] * w["a"]
    dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    out["V"], out["U"] = h.T @ dt, h.T @ dg
    dh = att[:, None] * dbag + dt @ w["V"].T + dg @ w["U"].T
    dz = dh * (1 - h * h)
    out["W"], out["b"] = z.T @ dz, dz.sum(0)
    return out


def fit(rows: list[tuple[str, int]], cut: float = 0.3) -> Model:
    """A model from (text, label) rows; its scores have their best threshold at cut."""
    y = np.array([label for _, label in rows], float)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES))
    bags = [encode(t) for t, _ in rows]
    x, starts = np.concatenate(bags), np.cumsum([0] + [len(b) for b in bags[:-1]])
    model = Model(x.mean(0), x.std(0) + 1e-6)
    rng = np.random.default_rng(SEED)
    shapes = {"W": (N_FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "a": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
    w = model.weights = {k: rng.normal(0, 0.3, s) if k not in "bd" else np.zeros(s) for k, s in shapes.items()}
    each = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    m, v = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        logit, got = model.forward(x, starts)
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * each
        for k, grad in _gradients(w, got, starts, error).items():
            grad = grad + DECAY * w[k]
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.99 * v[k] + 0.01 * grad * grad
            w[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    logit = model.forward(x, starts)[0]
    model.shift = float(np.log(cut / (1 - cut)) - best_threshold(logit, y.astype(int)))
    return model


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, n_passages, focus) of every row; focus is the passage with most attention."""
    small_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in runs(texts, 2_000_000):
                bags = [encode(t) for t in texts[i:j]]
                scores, att = model.score(bags)
                yield pa.record_batch([b.column(0).slice(i, j - i), pa.array(scores, pa.float64()), pa.array([len(x) for x in bags], pa.int32()), pa.array([int(a.argmax()) for a in att], pa.int32())], ["doc_id", "score", "n_passages", "focus"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(score, SCORED)


def trained(docs: DataFrame, labels: DataFrame, train: Column) -> Model:
    """A model from the labelled rows for which train holds."""
    return fit(sample_rows(docs, labels, "quality", train, SAMPLE_ROWS))
