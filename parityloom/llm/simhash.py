"""Near-duplicates by SimHash with bit-sliced comparison.

Fingerprints are compared once each, however many documents share one. Cutting
the 64 bits into blocks, two fingerprints that differ in at most RADIUS bits
agree in at least blocks - RADIUS of them, so tables keyed by every choice of
that many blocks bring all close pairs together; the number of blocks grows with
the number of fingerprints, which keeps buckets small and loses nothing. A
bucket of more than CHUNK fingerprints is dealt out as pairs of its chunks.

Within a bucket the fingerprints stand as 64 bit planes, one bit a lane. A
comparison runs over the planes, adds the difference bits of all lanes in
carry-save counters, and leaves a block of lanes when all have passed the radius.
Small buckets are compared all at once, neighbour by neighbour; in a large one,
every fingerprint is compared once with those not reached yet, so it yields a
tree and never all its pairs. The trees' edges make components.

Nulls: a null text is an empty one, with fingerprint zero, which links like any
other; a null id is kept, has a fingerprint and counts as larger than any id, so
its component is that of its group, null if all its members are. Repeated rows
are kept. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, saved, shuffle_width, small_batches
from .components import components

SHINGLE, SEED, RADIUS, CHUNK, SMALL = 4, 42, 4, 2048, 12
#: Blocks of bits, by the number of fingerprints up to which they are used.
BLOCKS = ((1 << 23, 6), (1 << 28, 7), (1 << 62, 8))
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = re.compile(rb"[ \t-\r]+")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit b is set if it is set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    parts = [w for w in _SPACE.split(text.encode().translate(_UPPER)) if w]
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    k = min(shingle, len(parts))
    starts = np.concatenate([[0], ends[: len(parts) - k] + 1]).tolist()
    hashes = np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):  # the bits of a very long text piece by piece
        ones += np.unpackbits(hashes[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp as a signed long."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, fp long")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints: 64 rows of one bit a lane, packed into bytes."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little")


def within(differences: Iterator[np.ndarray] | list[np.ndarray], lanes: int, radius: int = RADIUS) -> np.ndarray:
    """Lanes of which at most radius (< 8) of the planes of differing bits are set.

    ones, twos and fours are carry-save counters; over marks lanes that reached
    eight. Every eight planes the lanes that have passed the radius are looked at,
    and 64-byte blocks that have no other lane are left out from then on.
    """
    size = (lanes + 7) // 8
    pad = -size % 64
    live = np.arange((size + pad) // 64)
    out = np.zeros((size + pad) // 64 * 512, bool)
    ones, twos, fours, over = (np.zeros((len(live), 64), np.uint8) for _ in range(4))
    for n, plane in enumerate(differences, 1):
        x = np.pad(plane, (0, pad)).reshape(-1, 64)[live] if pad or len(live) < len(out) // 512 else plane.reshape(-1, 64)
        carry = ones & x
        ones ^= x
        up = twos & carry
        twos ^= carry
        over |= fours & up
        fours ^= up
        if n % 8 == 0:
            past = over.copy()
            for value in range(radius + 1, 8):
                past |= (ones if value & 1 else ~ones) & (twos if value & 2 else ~twos) & (fours if value & 4 else ~fours)
            if n == 64:
                rows = np.unpackbits(~past, axis=1, bitorder="little").astype(bool)
                out.reshape(-1, 512)[live] = rows
                break
            over = past
            keep = (past != 0xFF).any(1)
            if not keep.any():
                break
            if not keep.all():
                live, ones, twos, fours, over = live[keep], ones[keep], twos[keep], fours[keep], over[keep]
    return out[:lanes]


def _grown(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the fingerprints within radius, each compared once."""
    left = np.arange(len(fps))
    out: list[tuple[int, int]] = []
    sliced, queue = planes(fps), []
    packed_for = left
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
        i = queue.pop()
        if not len(left):
            break
        if 2 * len(left) < len(packed_for) or (len(left) != len(packed_for) and len(left) <= 512):
            packed_for, sliced = left, planes(fps[left])
        flip = np.where((int(fps[i]) >> np.arange(64, dtype=object)).astype(object) & 1, 0xFF, 0).astype(np.uint8)
        close = packed_for[within((sliced[k] ^ flip[k] for k in range(64)), len(packed_for), radius)]
        close = close[np.isin(close, left, assume_unique=True)]
        if len(close):
            out += [(i, int(c)) for c in close]
            queue += close.tolist()
            left = np.setdiff1d(left, close, assume_unique=True)
    return out


def bucket_edges(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS, small: int = SMALL) -> list[tuple[int, int]]:
    """Edges (places) that connect, within each group of equal neighbours in `group`, what is close."""
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(first, len(group)))
    out: list[tuple[int, int]] = []
    for a, n in zip(first[sizes > small].tolist(), sizes[sizes > small].tolist(), strict=True):
        out += [(a + x, a + y) for x, y in _grown(fps[a : a + n], radius)]
    own = np.repeat(sizes <= small, sizes)
    where = np.flatnonzero(own)
    f, g = fps[where], group[where]
    for d in range(1, small):
        i = np.flatnonzero(g[d:] == g[:-d]) if d < len(g) else np.zeros(0, np.int64)
        if not len(i):
            break
        for at in range(0, len(i), 65_536):
            part = i[at : at + 65_536]
            hit = part[within(list(planes(f[part] ^ f[part + d])), len(part), radius)]
            out += zip(where[hit].tolist(), where[hit + d].tolist(), strict=True)
    return out


def _tables(n: int) -> list[tuple[int, ...]]:
    """Bit positions of every table's key."""
    blocks = next(b for limit, b in BLOCKS if n <= limit)
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [tuple(p for c in choice for p in range(cuts[c], cuts[c + 1])) for choice in combinations(range(blocks), blocks - RADIUS)]


def close_edges(classes: DataFrame, n: int) -> DataFrame:
    """Edges (a, b) of node numbers that connect all of (fp, node) within RADIUS, from n rows."""
    masks = [sum(1 << p for p in t) for t in _tables(n)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).cast("int").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    rows = classes.select("fp", "node", F.explode(keys).alias("k")).select("fp", "node", "k.t", "k.key")
    sizes = rows.groupBy("t", "key").count().where("count > 1")
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    found = rows.join(sizes, ["t", "key"]).withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("fp"), "chunks").cast("int"))
    # a chunk of a large bucket meets every chunk of it
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(F.least("own", o).alias("x"), F.greatest("own", o).alias("y")))
    dealt = found.select("fp", "node", "t", "key", F.explode(pairs).alias("p")).select("fp", "node", "t", "key", "p.x", "p.y")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        columns = ("t", "key", "x", "y", "fp", "node")

        def edges(cols: list[np.ndarray]) -> pa.RecordBatch:
            t, key, x, y, fp, node = cols
            change = (t[1:] != t[:-1]) | (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            got = bucket_edges(fp.view(np.uint64), np.append(0, np.cumsum(change)))
            a, b = np.array(got, np.int64).reshape(-1, 2).T
            return pa.record_batch([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in columns]
            held = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)] if held else cols
            if len(held[0]) < 50_000:
                continue
            last = np.array([h[-1] for h in held[:4]])
            same = np.logical_and.reduce([h == v for h, v in zip(held[:4], last, strict=True)])
            cut = len(same) - int(same.sum())  # the last group may go on
            if cut:
                yield edges([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if held and len(held[0]):
            yield edges(held)

    order = ["t", "key", "x", "y"]
    return dealt.repartition(shuffle_width(classes.sparkSession), *order).sortWithinPartitions(*order).mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    prints = saved(fingerprints(docs, id_col, text_col), "fingerprints")
    known = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = saved(known, "classes")
    total = classes.count()
    # nodes are the fingerprints themselves: ids may repeat
    edges = close_edges(classes.select("fp", F.col("fp").alias("node")), total)
    roots = components(edges)
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    final = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(final, "fp").select("doc_id", "fp", "component_id")


def kept(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of docs, without those whose id is larger than the id of their component; ids are to be unique."""
    later = found.where(F.col("doc_id") > F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(later, id_col, "left_anti")


def first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of near copies one row: that of the smallest id, a null id being the largest."""
    rows = numbered(docs, "row_", id_col, text_col, nulls_first=False)
    return kept(rows, near_duplicates(rows, "row_", text_col), "row_").select(*docs.columns)
