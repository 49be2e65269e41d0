"""Language-model scores of texts by a probabilistic suffix tree over words.

A text is its words, A-Z lower-cased, then one end. The root of the tree is the smoothed frequency of
tokens: (c + ALPHA) / (N + ALPHA (V + 1)). A state is a context of one or of two words, the latest first, and
the tree grows downwards: a context of two words needs that of its last word. The next-symbol
distribution of a state is (c' + b P(parent)) / (N + K), where c' are counts of at least LEAST_COUNT,
N is how often the context occurs, and b = N - sum c' + K, so that it sums to one. A context
is kept if it occurs LEAST_CONTEXT times and its divergence from its parent, estimated with every
occurrence left out of the counts it is tried on, and times N, is over LEAST_GAIN decimal digits. A token is scored by
the longest state that ends the words before it; a text begins with a mark of its own.

Counts are sums over all training tokens: pairs and triples are counted in blocks, packed into lanes by their hash, and added
up there, so a frequent one is one entry a block. The tree is a table: for
each kept context what a token unseen there loses against its parent, and for each token seen there its
gain over the root. Tokens are packed by the word before them into lanes and sent once; the tree's rows
of a lane meet them there. A word before more tokens than a lane should have is dealt out over several
lanes, to which its rows are copied, so no lane grows with a frequent word, pair or passage. The base is a sum over
tokens: the at most 2**17 words that make so large a share of N go to all tasks, the others are joined. Two filters of
FILTER bits keep tokens at home that no state can score; they change no result.

Words stand as 64-bit hashes, taken from the bytes of a whole batch of texts at once. Nulls: a null text is an empty one, which has its end to score; a null id is in the
training fold or not as the caller says. Repeated rows are scored, and learnt from, each for itself. Without
training rows every score is 0. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, numbered, saved, small_batches, unused

ALPHA, K, LEAST_COUNT, LEAST_CONTEXT, LEAST_GAIN = 0.1, 2.0, 2, 12, 2.0
#: Most words that go to all tasks, bits of a filter, tokens of a block, tokens of a lane at 6 bytes each, and least lanes.
HEAVY, FILTER, BLOCK, LANE, TOKEN, LANES = 1 << 17, 1 << 22, 1_000_000, 2_250_000, 6, 64
#: What stands before a text, two places before it, and tells keys of the four kinds of rows apart.
BEGIN, NONE = 0x5BD1E9955BD1E995, 0
PAIR, TRIPLE, ONE, TWO = 0x1B873593CC9E2D51, 0x2127599BF4325C37, 0x4CF5AD432745937F, 0x38495AB569CC5DF1
#: The end of a text.
END = 0x2545F4914F6CDD1D
SCORED = "row long, h long, n long, known long, x double"
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: An odd number and its inverse modulo 2**64, and how many bytes are hashed at once.
BASE, SPAN = 0x9E3779B97F4A7C15, 1 << 20
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of BASE and of its inverse, n at least."""
    if not _powers or len(_powers[0]) < n:
        made = []
        for x in (BASE, pow(BASE, -1, 1 << 64)):
            with np.errstate(over="ignore"):
                steps = np.full(max(n, SPAN), np.uint64(x))
                steps[0] = 1
                made.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = made
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words data[start:end], A-Z lower-cased: differences of running sums of bytes times powers, then mixed."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + SPAN, "right")))
        power, inverse = _power(int(ends[to - 1] - low))
        part = _FOLDED[data[low : ends[to - 1]]].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * power[: len(part)], dtype=np.uint64)])
        a, b = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)
        at = to
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xA0761D6478BD642F)
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of tokens of each text, and the hashes of all in order; the end is a token."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, body = texts.buffers()
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    blank = _SPACE[data]
    first, last = np.ones(len(data), bool), np.ones(len(data), bool)
    first[1:], last[:-1] = blank[:-1], blank[1:]
    # no word goes on from one text to the next
    first[offsets[offsets < len(data)]], last[offsets[offsets > 0] - 1] = True, True
    starts, ends = np.flatnonzero(~blank & first), np.flatnonzero(~blank & last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    stop = np.cumsum(counts + 1) - 1
    out = np.empty(len(starts) + len(counts), np.int64)
    word = np.ones(len(out), bool)
    word[stop] = False
    out[word], out[stop] = word_hashes(data, starts, ends), END
    return counts + 1, out


def texts(docs: DataFrame, row: str, text_col: str = "text") -> DataFrame:
    return docs.select(F.col(row).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def turned(h: Column, by: int) -> Column:
    return F.call_function("shiftleft", h, F.lit(by)).bitwiseOR(F.shiftrightunsigned(h, 64 - by))


def key(kind: int, *words: Column) -> Column:
    """One number for a kind of row and its words, the latest word last."""
    out = words[-1]
    for i, w in enumerate(reversed(words[:-1]), 1):
        out = out.bitwiseXOR(turned(w, 21 * i))
    return out.bitwiseXOR(F.lit(kind))


def keys(kind: int, *words: np.ndarray) -> np.ndarray:
    """The same on arrays."""
    out = words[-1].view(np.uint64).copy()
    for i, w in enumerate(reversed(words[:-1]), 1):
        x = w.view(np.uint64)
        out ^= (x << np.uint64(21 * i)) | (x >> np.uint64(64 - 21 * i))
    return (out ^ np.uint64(kind)).view(np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(rows, d, known, t, u, w) of some million tokens each: row numbers and each token's place in them; hashes, and each
    token's place and that of the two before it in them."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> tuple[np.ndarray, ...]:
        rows, lengths, flat = (np.concatenate([h[i] for h in held]) for i in range(3))
        code, words = pd.factorize(flat)
        known = np.concatenate([np.array([NONE, BEGIN], np.int64), words])
        w = code.astype(np.int32) + 2
        starts = np.cumsum(lengths) - lengths
        u, t = np.empty_like(w), np.empty_like(w)
        u[1:], t[2:] = w[:-1], w[:-2]
        t[starts[lengths > 1] + 1] = 1
        u[starts], t[starts] = 1, 0
        return rows, np.repeat(np.arange(len(rows), dtype=np.int32), lengths), known, t, u, w

    for b in batches:
        if len(b):
            lengths, flat = tokens(b.column(1))
            held.append((b.column(0).to_numpy(), lengths, flat))
            size += len(flat)
        if size >= BLOCK:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _bits(buckets: DataFrame) -> np.ndarray:
    """A filter of FILTER bits from (b); at most so many numbers come to the driver."""
    out = np.zeros(FILTER, bool)
    out[buckets.select(F.col("b").cast("int")).distinct().toArrow()["b"].to_numpy()] = True
    return np.packbits(out)


def _bucket(k: Column) -> Column:
    return F.shiftrightunsigned(k, 20).bitwiseAND(F.lit(FILTER - 1)).alias("b")


def _within(bits: np.ndarray, k: np.ndarray) -> np.ndarray:
    b = (k.view(np.uint64) >> np.uint64(20)) & np.uint64(FILTER - 1)
    return (bits[b >> np.uint64(3)] >> (np.uint8(7) - (b & np.uint64(7)).astype(np.uint8))) & 1 == 1


def packed(**arrays: np.ndarray) -> bytes:
    import zstandard

    to = io.BytesIO()
    np.savez(to, **arrays)
    return zstandard.compress(to.getvalue(), 1)


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    import zstandard

    return dict(np.load(io.BytesIO(zstandard.decompress(blob))))


def _lanes(lane: np.ndarray, lanes: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each lane that occurs with its places, in order."""
    lane = lane.astype(np.min_scalar_type(lanes))
    order = np.argsort(lane, kind="stable")
    ends = np.searchsorted(lane[order], np.arange(lanes + 1))
    for i in np.flatnonzero(np.diff(ends)):
        yield int(i), order[ends[i] : ends[i + 1]]


def _coded(size: int, *codes: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which of so many words occur, those of first before the others and in its order, and the codes as places in them."""
    used = np.zeros(size, bool)
    for c in codes:
        used[c] = True
    at = np.flatnonzero(used)
    if first is not None:
        at = np.concatenate([first[used[first]], at[~np.isin(at, first, assume_unique=True)]])
    rank = np.empty(size, np.int32)
    rank[at] = np.arange(len(at))
    return at, np.concatenate([rank[c] for c in codes]).astype(np.min_scalar_type(max(1, len(at))))


def _counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and how often each occurs."""
    code, values = pd.factorize(x)
    order = np.argsort(values)
    return values[order], np.bincount(code, minlength=len(values))[order]


def _chunk(lane: int, **arrays: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([lane]), pa.array([packed(**arrays)], pa.binary())], ["lane", "blob"])


def counted(rows: DataFrame, lanes: int, contexts: np.ndarray | None = None) -> DataFrame:
    """(t, u, w, n): how often tokens (t, u none), pairs (t none) or, with a filter of contexts (t, u), triples occur; the latter two if LEAST_COUNT times."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, known, t, u, w in blocks(batches):
            k = len(known)
            if contexts is None:
                one, n = _counts(w)
                none = np.zeros(len(one), np.int64)
                pairs, m = _counts(u.astype(np.int64) * k + w)
                grams = [(none, none, one, n), (np.zeros(len(pairs), np.int64), pairs // k, pairs % k, m)]
            else:
                some = (t != 0) & _within(contexts, keys(TWO, known[t], known[u]))
                code, before = pd.factorize(t[some].astype(np.int64) * k + u[some])
                found, n = _counts(code * k + w[some])
                before = before[found // k]
                grams = [(before // k, before % k, found % k, n)]
            for *gram, n in grams:
                for lane, part in _lanes(keys(TRIPLE, *[known[x] for x in gram]) % lanes, lanes):
                    at, code = _coded(k, *[x[part] for x in gram])
                    yield _chunk(lane, words=known[at], code=code, n=n[part].astype(np.min_scalar_type(int(n.max()))))

    def add(found: pa.Table) -> pa.Table:
        parts = []
        for blob in found["blob"]:
            got = unpacked(blob.as_py())
            parts.append((*np.split(got["words"][got["code"]], 3), got["n"].astype(np.int64)))
        t, u, w, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        k = keys(TRIPLE, t, u, w)
        order = np.argsort(k)
        new = np.flatnonzero(np.append(True, k[order][1:] != k[order][:-1]))
        n, first = np.add.reduceat(n[order], new), order[new]
        t, u, w = t[first], u[first], w[first]
        often = (n >= LEAST_COUNT) | (u == NONE)
        return pa.table({"t": t[often], "u": u[often], "w": w[often], "n": n[often]})

    return rows.mapInArrow(pack, "lane long, blob binary").groupBy("lane").applyInArrow(add, "t long, u long, w long, n long")


def _states(seen: DataFrame, by: list[str], total: DataFrame, parent: Column, k: float, least: int, gain: float) -> tuple[DataFrame, DataFrame]:
    """(by, pen) of the contexts kept, and their rows of seen with gain, the logarithm of their chance over that of the root.

    seen has the counts n, root chances p0, and what parent is computed of; total (by, total) is how often contexts occur.
    """
    sums = seen.groupBy(*by).agg(F.sum("n").alias("sum")).join(total.where(F.col("total") >= least), by)
    b, n, all_ = F.col("total") - F.col("sum") + k, F.col("n"), F.col("total")
    tried = saved(seen.join(sums, by).withColumn("parent", parent), "tried", "zstd")
    hit = n * F.log10((n - 1 + b * F.col("parent")) / (F.col("parent") * (all_ - 1 + k)))
    new = F.col("total") - F.col("sum")
    divergence = tried.groupBy(*by, "total", "sum").agg(F.sum(hit).alias("hits")).withColumn("d", F.col("hits") + new * F.log10(b / (all_ - 1 + k)))
    kept = saved(divergence.where(F.col("d") > gain).select(*by, F.log10(b / (all_ + k)).alias("pen")), "states")
    rows = tried.join(kept.select(*by), by, "left_semi").withColumn("gain", F.log10((n + b * F.col("parent")) / (all_ + k)) - F.log10("p0"))
    out = saved(rows.drop("parent", "total", "sum"), "gains", "zstd")
    forget(tried)
    return kept, out


def words_of(grams: DataFrame) -> DataFrame:
    return grams.where(F.col("u") == NONE).select(F.col("w").alias("h"), F.col("n").alias("c"))


def learnt(rows: DataFrame, grams: DataFrame, docs: int, p0: Callable[[str], Column], lanes: int, least: int = LEAST_CONTEXT, gain: float = LEAST_GAIN, k: float = K) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The tree (u, key, value), u the latest word of the context, and filters of its contexts of one and of two words; grams are counted tokens and pairs."""
    begin = rows.sparkSession.createDataFrame([(BEGIN, docs)], "h long, c long")
    words, pairs = words_of(grams), grams.where(F.col("u") != NONE).drop("t")
    seen = pairs.join(words.select(F.col("h").alias("w"), p0("c").alias("p0")), "w")
    one, gains1 = _states(seen, ["u"], words.unionByName(begin).select(F.col("h").alias("u"), F.col("c").alias("total")), F.col("p0"), k, least, gain)
    often = pairs.where(F.col("n") >= least).select(F.col("u").alias("t"), F.col("w").alias("u"), F.col("n").alias("total")).join(one.select("u"), "u", "left_semi")
    contexts = saved(often, "contexts", "zstd")
    triples = saved(counted(rows, lanes, _bits(contexts.select(_bucket(key(TWO, F.col("t"), F.col("u")))))), "triples", "zstd")
    above = gains1.select("u", "w", "p0", F.col("gain").alias("gain1"))
    two, gains2 = _states(triples.join(above, ["u", "w"]), ["t", "u"], contexts, F.col("p0") * F.pow(F.lit(10.0), "gain1"), k, least, gain)
    t, u, w = F.col("t"), F.col("u"), F.col("w")
    tree = one.select("u", key(ONE, u).alias("key"), F.col("pen").alias("value")).unionByName(gains1.select("u", key(PAIR, u, w).alias("key"), F.col("gain").alias("value")))
    tree = tree.unionByName(two.select("u", key(TWO, t, u).alias("key"), F.col("pen").alias("value"))).unionByName(gains2.select("u", key(TRIPLE, t, u, w).alias("key"), F.col("gain").alias("value")))
    tree = saved(tree, "tree", "zstd")
    ones, twos = _bits(one.select(_bucket(key(ONE, u)))), _bits(two.select(_bucket(key(TWO, t, u))))
    forget(one, gains1, contexts, triples, two, gains2)
    return tree, ones, twos


def over_root(rows: DataFrame, tree: DataFrame, ones: np.ndarray, twos: np.ndarray, hot: dict[int, int], lanes: int, common: np.ndarray) -> DataFrame:
    """(row, x): sums of what the states add to the root's logarithms of a row's tokens; hot has the number of lanes of words before
    very many, and common the hashes, in order, of words that are sent as numbers."""
    hot_words, hot_parts = (np.array(x, np.int64) for x in (sorted(hot), [hot[w] for w in sorted(hot)]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, d, known, t, u, w in blocks(batches):
            at = np.minimum(np.searchsorted(common, known), max(0, len(common) - 1))
            first = np.flatnonzero(common[at] == known) if len(common) else np.zeros(0, np.int64)
            first = first[np.argsort(at[first])]
            some = _within(ones, keys(ONE, known))[u]
            d, t, u, w = d[some], t[some], u[some], w[some]
            t[~_within(twos, keys(TWO, known[t], known[u]))] = 0
            lane = known % lanes
            if len(hot_words):
                of = np.minimum(np.searchsorted(hot_words, known), len(hot_words) - 1)
                lane = np.where(hot_words[of] == known, (lane + int(rows_[0]) % hot_parts[of]) % lanes, lane)
            for i, part in _lanes(lane[u], lanes):
                words, code = _coded(len(known), t[part], u[part], w[part], first=first)
                n = np.count_nonzero(np.isin(words, first, assume_unique=True))
                whose, who = _coded(len(rows_), d[part])
                yield _chunk(i, rows=rows_[whose], d=who, common=np.diff(at[words[:n]], prepend=0).astype(np.uint32), words=known[words[n:]], code=code)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["key"].to_numpy())
        k, v = right["key"].to_numpy()[order], right["value"].to_numpy()[order]

        def find(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(np.searchsorted(k, x), len(k) - 1)
            return k[at] == x, v[at]

        out: list[tuple[np.ndarray, np.ndarray]] = []
        for blob in left["blob"] if len(k) else []:
            got = unpacked(blob.as_py())
            known = np.concatenate([common[np.cumsum(got["common"])], got["words"]])
            t, u, w = np.split(got["code"], 3)
            kept, pen = (a[u] for a in find(keys(ONE, known)))
            hit, gain = find(keys(PAIR, known[u], known[w]))
            x = np.where(kept, np.where(hit, gain, pen), 0.0)
            # the longer contexts of those that may have one
            at = np.flatnonzero(known[t] != NONE)
            deep, pen = find(keys(TWO, known[t[at]], known[u[at]]))
            at, pen = at[deep], pen[deep]
            hit, gain = find(keys(TRIPLE, known[t[at]], known[u[at]], known[w[at]]))
            x[at] = np.where(hit, gain, pen + x[at])
            out.append((got["rows"], np.bincount(got["d"], x, len(got["rows"]))))
        whose, x = (np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in range(2))
        return pa.table({"row": pa.array(whose.astype(np.int64)), "x": pa.array(x.astype(float))})

    chunks = rows.mapInArrow(pack, "lane long, blob binary")
    spread = tree.withColumn("lane", F.pmod("u", F.lit(lanes).cast("long")))
    if hot:
        parts = rows.sparkSession.createDataFrame(list(hot.items()), "u long, parts long")
        spread = spread.join(F.broadcast(parts), "u", "left").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).withColumn("lane", F.pmod(F.col("lane") + F.col("i"), F.lit(lanes)))
    return chunks.groupBy("lane").cogroup(spread.select("lane", "key", "value").groupBy("lane")).applyInArrow(score, "row long, x double").groupBy("row").agg(F.sum("x").alias("x"))


def based(rows: DataFrame, words: DataFrame, common: pa.Table) -> DataFrame:
    """(row, n, known, x): tokens, those known, and the sum of log10(c + ALPHA); common has the most frequent words in order."""
    h_, x_ = common["h"].to_numpy(), np.log10(common["c"].to_numpy() + ALPHA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, d, words_, _, _, w in blocks(batches):
            at = np.minimum(np.searchsorted(h_, words_), max(0, len(h_) - 1))
            there = h_[at] == words_ if len(h_) else np.zeros(len(words_), bool)
            hit = there[w]
            sums = [np.bincount(d, minlength=len(rows_)), np.bincount(d[hit], minlength=len(rows_)), np.bincount(d[hit], x_[at[w[hit]]], len(rows_))]
            # row numbers in place of hashes: they meet no word, or one that is not looked at
            yield pa.record_batch([pa.array(rows_), pa.array(rows_), *[pa.array(s.astype(c)) for s, c in zip(sums, (np.int64, np.int64, float), strict=True)]], ["row", "h", "n", "known", "x"])
            found, n = _counts(d[~hit].astype(np.int64) * len(words_) + w[~hit])
            yield pa.record_batch([pa.array(rows_[found // len(words_)]), pa.array(words_[found % len(words_)]), pa.array(n.astype(np.int64)), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.float64())], ["row", "h", "n", "known", "x"])

    each = rows.mapInArrow(run, SCORED)
    met = each.join(words, "h", "left")
    c = F.coalesce("c", F.lit(0))
    rare = F.col("known").isNull()
    x = F.when(rare, F.col("n") * F.log10(c + ALPHA)).otherwise(F.col("x"))
    known = F.when(rare, F.when(c > 0, F.col("n")).otherwise(0)).otherwise(F.col("known"))
    return met.groupBy("row").agg(F.sum(F.when(rare, 0).otherwise(F.col("n"))).alias("n"), F.sum(known).alias("known"), F.sum(x).alias("x"))


def scored(docs: DataFrame, train: Column, least: int = LEAST_CONTEXT, gain: float = LEAST_GAIN, k: float = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs (doc_id, trained) with n_tokens, n_known, train_tokens, base_score and score; train tells which to learn from."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("trained"))
    row = unused(docs.columns, "row")
    docs = numbered(docs, row)
    every, learning = texts(docs, row), texts(docs.where("trained"), row)
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    lanes = max(LANES, -(-size // (LANE * TOKEN)))
    grams = saved(counted(learning, lanes), "grams", "zstd")
    words = words_of(grams)
    total, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).head()
    rows = words.where(F.col("h") == END).select("c").head()
    rows = rows[0] if rows else 0
    down = total + ALPHA * (kinds + 1)
    tree, ones, twos = learnt(learning, grams, rows, lambda c: (F.col(c) + ALPHA) / down, lanes, least, gain, k)
    # the bound is Python's: 2 * F.lit(total) was a product of 32-bit numbers, an error from 2**30 tokens on
    many = words.where(F.col("c") > 2 * total // lanes).collect()  # at most half as many as lanes
    hot = {r["h"]: -(-r["c"] * lanes // total) for r in many} | ({BEGIN: -(-rows * lanes // total)} if rows * lanes > 2 * total else {})
    common = words.orderBy(F.desc("c"), "h").limit(HEAVY).toArrow().sort_by("h")
    # one after the other, so that only one of them is shuffled at a time
    base = saved(based(every, words, common), "base")
    forget(grams)
    more = saved(over_root(every, tree, ones, twos, hot, lanes, common["h"].to_numpy()), "more")
    forget(tree)
    got = base.join(more.withColumnRenamed("x", "more"), "row", "left")
    b = F.col("x") - F.col("n") * F.lit(float(np.log10(down)))
    out = got.select(F.col("row").alias(row), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), b.alias("base_score"), (b + F.coalesce("more", F.lit(0.0))).alias("score"))
    return docs.select(row, "doc_id", "trained").join(out, row).drop(row)
