"""Sequence packing by non-negative least squares over shallow length combinations.

A document is encoded and cut into full windows and one rest shorter than a
window. The histogram of rest lengths (at most window - 1 entries) goes to the
driver. There, combinations of two or three lengths that fill a window exactly
are enumerated, repeat counts are solved as a non-negative least squares problem
against the histogram and rounded, never beyond what the histogram holds. Rests
that no combination takes are packed greedily, one after the other, and cut
where a window ends. The last window is cut at powers of two, which need no
padding.

Rests are numbered within (length, lane), so that no task ever gets more than
one lane of a length; a lane is a hash of the document.

Nulls: a null text is an empty one, a null id is kept. An empty text gives the
end id alone. Repeated rows are packed each for itself. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, shuffle_width, small_batches
from .encoding import encoder

PIECES = "doc_id long, doc_tokens long, start long, length long, ids binary"
PACKED = PIECES + ", sequence_id long, offset long"
LANES = 64
#: Lengths from which three-part combinations are built: the most frequent ones.
TRIPLE_LENGTHS = 96
STEPS = 400


def pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", literal: bool = True) -> DataFrame:
    """Full windows and the rest of every document, with ids as 32-bit little-endian."""
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, literal)
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start : 4 * (start + window)]
                    for c, v in zip(cols, (doc, n, start, len(part) // 4, part), strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "doc_tokens", "start", "length", "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(cut, PIECES)


def combinations(histogram: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Two or three lengths that fill the window; histogram[i] counts length i."""
    have = np.flatnonzero(histogram[1:window]) + 1
    held = set(have.tolist())
    out = {(a, window - a) for a in held if a <= window - a and window - a in held}
    often = have[np.argsort(-histogram[have], kind="stable")][:TRIPLE_LENGTHS].tolist()
    for i, a in enumerate(often):
        for b in often[i:]:
            if window - a - b in held:
                out.add(tuple(sorted((a, b, window - a - b))))
    return sorted(out)


def repeat_counts(histogram: np.ndarray, combos: list[tuple[int, ...]], steps: int = STEPS) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|, by accelerated projected gradient."""
    if not combos:
        return np.zeros(0)
    who = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    what = np.concatenate([np.array(c) for c in combos])
    goal = histogram.astype(float)
    rows = np.bincount(what, minlength=len(goal))
    step = 1.0 / max(1.0, 3.0 * rows.max())  # 1 / a bound of the largest eigenvalue of A'A
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        residual = np.bincount(what, weights=y[who], minlength=len(goal)) - goal
        new = np.maximum(0.0, y - step * np.bincount(who, weights=residual[what], minlength=len(combos)))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        x, y, t = new, new + (t - 1) / t2 * (new - x), t2
    return x


def whole_counts(histogram: np.ndarray, combos: list[tuple[int, ...]], x: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Rounded counts, the largest first, within what is left of each length."""
    left = histogram.astype(np.int64).copy()
    out = []
    for i in np.argsort(-x, kind="stable"):
        combo = combos[i]
        n = min([round(x[i]), *(int(left[a]) // combo.count(a) for a in set(combo))])
        if n > 0:
            out.append((combo, n))
            for a in combo:
                left[a] -= n
    return out


def _plan(counts: dict[tuple[int, int], int], window: int) -> dict:
    """Where the rest with each number in its length goes."""
    histogram = np.zeros(window + 1, np.int64)
    first: dict[tuple[int, int], int] = {}
    for key in sorted(counts):
        first[key] = int(histogram[key[0]])
        histogram[key[0]] += counts[key]
    combos = combinations(histogram, window)
    chosen = whole_counts(histogram, combos, repeat_counts(histogram, combos))
    slots: dict[int, list[tuple[int, int, int]]] = {}  # length: (first number, first sequence, offset)
    used, sequences = np.zeros(window + 1, np.int64), 0
    for combo, n in chosen:
        offset = 0
        for a in combo:
            slots.setdefault(a, []).append((int(used[a]), sequences, offset))
            used[a] += n
            offset += a
        sequences += n
    left = histogram - used
    before = np.concatenate([[0], np.cumsum(left * np.arange(window + 1))])  # tokens of shorter rests in the stream
    total = int(before[-1])
    ends = [total // window * window]
    for bit in reversed(range(window.bit_length())):
        if (total - ends[0]) >> bit & 1:
            ends.append(ends[-1] + (1 << bit))
    return {"first": first, "slots": slots, "used": used, "before": before, "sequences": sequences, "tail": np.array(ends), "streamed": total // window + len(ends) - 1}


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", literal: bool = True) -> DataFrame:
    """Every id of every document in exactly one piece: PACKED columns. With literal, added tokens in a text are mere characters."""
    cut = saved(pieces(docs, tokenizer, window, end_id, id_col, text_col, literal), "pieces", "zstd")
    lane = F.pmod(F.xxhash64("doc_id", "doc_tokens", F.substring("ids", 1, 64)), F.lit(LANES)).cast("int")
    rests = cut.where(F.col("length") < window).withColumn("lane", lane)
    counts = {(r["length"], r["lane"]): r["count"] for r in rests.groupBy("length", "lane").count().collect()}
    plan = _plan(counts, window)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "doc_tokens", "start", "length", "ids", "sequence_id", "offset"]
        kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 2
        starts = {a: np.array([s[0] for s in got]) for a, got in plan["slots"].items()}
        tail, width = plan["tail"], 4
        for b in batches:
            cols: list[list] = [[] for _ in names]
            for doc, n, start, length, ids, lane_, rank in zip(*(c.to_pylist() for c in b.columns), strict=True):
                number = plan["first"][length, lane_] + rank - 1
                if number < plan["used"][length]:
                    k = int(np.searchsorted(starts[length], number, "right")) - 1
                    from_, sequence, offset = plan["slots"][length][k]
                    parts = [(0, length, sequence + number - from_, offset)]
                else:
                    at = int(plan["before"][length]) + (number - int(plan["used"][length])) * length
                    parts, done = [], 0
                    while done < length:
                        if at + done < tail[0]:
                            sequence, offset = divmod(at + done, window)
                            stop = (sequence + 1) * window
                        else:
                            k = int(np.searchsorted(tail, at + done, "right")) - 1
                            sequence, offset, stop = int(tail[0]) // window + k, at + done - int(tail[k]), int(tail[k + 1])
                        size = min(length - done, stop - at - done)
                        parts.append((done, size, plan["sequences"] + sequence, offset))
                        done += size
                for done, size, sequence, offset in parts:
                    for c, v in zip(cols, (doc, n, start + done, size, ids[width * done : width * (done + size)], sequence, offset), strict=True):
                        c.append(v)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    order = Window.partitionBy("length", "lane").orderBy("doc_id", "doc_tokens", "ids")
    ranked = rests.repartition(shuffle_width(docs.sparkSession), "length", "lane").select("doc_id", "doc_tokens", "start", "length", "ids", "lane", F.row_number().over(order).alias("rank"))
    base = plan["sequences"] + plan["streamed"]
    full = cut.where(F.col("length") == window).withColumns({"sequence_id": F.monotonically_increasing_id() + F.lit(base), "offset": F.lit(0).cast("long")})
    return full.unionByName(ranked.mapInArrow(place, PACKED))
