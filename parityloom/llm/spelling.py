"""Spelling variants: words that differ by one code point, grouped under their most frequent form.

Words are runs of letters, only A-Z lower-cased. A run whose salted checksum 97 divides loses one code
point first, so that texts without misspellings have some. The dictionary holds the results of at least
LEAST_LENGTH code points and LEAST_COUNT occurrences.

One edit at place i of the shorter word (length L) leaves the first i code points of both words alone,
and the last L - i - 1. So an edit in the second half leaves a prefix of L // 2 intact, and the two words
stand in one block of the dictionary in forward order; an edit in the first half leaves the rest intact, and they
stand in one block of the reversed dictionary. A block that more than BLOCK words share is subdivided:
each half of the places that are left has its own block, which shares a longer prefix or
suffix. A block of a single place holds at most as many words as the alphabet allows. A merge join sorts
the entries by block and scans each block as a range; pairs are verified there, and each pair is
taken in the one block that holds the place where its words part.

The form of a word is its near word with the largest count (ties: the smaller word), if that is at
least RATIO times its own; counts grow along forms, so roots are found by doubling pointers.

Nulls: a null text has no words, a null id is an empty one. Repeated rows count as often as they are there.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, saved
from .source_divergence import ascii_lower, matches

#: What stands between words: all but A-Z, a-z and U+00C0 to U+00FF, without a negation, which takes ten times as long.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\xBF\x{100}-\x{10FFFF}]+"
LEAST_LENGTH, LEAST_COUNT, RATIO, STEP, BLOCK = 5, 3, 2, 97, 48
KEY = ["L", "lo", "hi", "block"]


def dictionary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words with enough code points and occurrences."""
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(doc.alias("d"), F.explode(matches(ascii_lower(F.col(text_col)), BETWEEN)).alias("r"))
    hashed = runs.select("r", F.crc32(F.concat("d", F.lit(":"), "r").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("r").cast("long")).cast("int")
    cut = F.concat(F.substring("r", F.lit(1), at), F.substring("r", at + 2, F.length("r")))
    words = hashed.select(F.when(F.pmod("h", F.lit(STEP)) == 0, cut).otherwise(F.col("r")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _block(lo: Column, hi: Column, size: Column) -> Column:
    """What the words of a block share: code points before lo, and those from hi on, backwards as the reversed dictionary has them."""
    w = F.col("word")
    tail = size - hi
    return F.concat(F.substring(w, F.lit(1), lo), F.lit("\x00"), F.reverse(F.substring(w, F.length(w) - tail + 1, tail)))


def _dealt(entries: DataFrame, *places: tuple[Column, Column]) -> DataFrame:
    """An entry for each range of places [lo, hi) of the edit, with its block."""
    size = F.col("L")
    each = F.explode(F.array(*[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in places])).alias("p")
    return entries.select("word", "n", "len", "L", each).select("word", "n", "len", "L", F.col("p.lo").alias("lo"), F.col("p.hi").alias("hi"), _block(F.col("p.lo"), F.col("p.hi"), size).alias("block"))


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, len, L, lo, hi, block): the entries of blocks with a pair to try, none with more than `block` words but those of one place."""
    length = F.length("word")
    # a word is the shorter of a pair, or one longer than it
    roles = words.select("word", "n", length.alias("len"), F.explode(F.array(length, length - 1)).alias("L")).where(F.col("L") >= 1)
    half = F.floor(F.col("L") / 2).cast("int")
    open_ = saved(_dealt(roles, (F.lit(0), half), (half, F.col("L"))).where("hi > lo"), "entries", "zstd")
    done: list[DataFrame] = []
    while True:
        sizes = open_.groupBy(*KEY).agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("len") == F.col("L")).alias("short")).where("c > 1 AND short > 0")
        met = saved(open_.join(sizes.drop("short"), KEY), "blocks", "zstd")
        forget(open_)
        full = (F.col("c") > block) & (F.col("hi") - F.col("lo") > 1)
        done.append(met.where(~full).drop("c"))
        rest = met.where(full)
        if rest.isEmpty():
            break
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        open_ = saved(_dealt(rest, (F.col("lo"), mid), (mid, F.col("hi"))), "entries", "zstd")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def near(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, na, b, nb): each two words that one edit turns into each other, once; a is not the longer."""
    entries = blocks(words, block)
    a, b = (entries.select(*KEY, F.col("word").alias(s), F.col("n").alias(f"n{s}"), F.col("len").alias(f"l{s}")) for s in "ab")
    short = a.where(F.col("la") == F.col("L")).hint("merge")
    apart = (F.col("hi") == F.col("L")) | (F.substring("a", F.lit(1), F.col("hi")) != F.substring("b", F.lit(1), F.col("hi")))
    other = (F.col("lb") > F.col("la")) | (F.col("b") > F.col("a"))
    return short.join(b, KEY).where(other & apart & (F.levenshtein("a", "b", 1) == 1)).select("a", "na", "b", "nb")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each word's chain of forms, by doubling."""
    now = saved(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = saved(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        forget(now)
        now = moved.select("word", "root")
        now.saved_at = moved.saved_at
        if moved.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the dictionary."""
    words = saved(dictionary(docs, least_length, least_count, id_col, text_col), "dictionary")
    pairs = near(words)
    sides = F.array(F.struct(F.col("a").alias("word"), (-F.col("nb")).alias("m"), F.col("b").alias("other")), F.struct(F.col("b").alias("word"), (-F.col("na")).alias("m"), F.col("a").alias("other")))
    best = pairs.select(F.explode(sides).alias("s")).groupBy(F.col("s.word").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("s.m", "s.other")).alias("best"))
    large = -F.col("best.m") >= ratio * F.col("n")
    known = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(large, F.col("best.other")).alias("form"), F.when(large, -F.col("best.m")).alias("form_n"))
    found = saved(known, "forms")
    forget(words)
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents),
each_run AS (SELECT d, r, count(*) AS n, hex(encode(d || ':' || r)) AS x FROM runs GROUP BY 1, 2),
hashed AS (SELECT r, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST((instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 1 AS BIGINT))),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM each_run, crc),
made AS (SELECT CASE WHEN h % 97 = 0 THEN left(r, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS word, n FROM hashed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
gaps AS (SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (SELECT x.word, y.word AS other, y.n AS m FROM gaps x JOIN gaps y ON x.a = y.a AND x.b = y.b AND x.word <> y.word AND x.i = y.i
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN w ON w.word = g.a || g.b UNION SELECT w.word, g.word, g.n FROM gaps g JOIN w ON w.word = g.a || g.b),
best AS (SELECT word, count(*) AS n_near, arg_min(other, struct_pack(m := -m, o := other)) AS other, max(m) AS m FROM near GROUP BY 1),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM w LEFT JOIN best ON best.word = w.word),
chain AS (WITH RECURSIVE c AS (SELECT word, word AS at FROM forms UNION SELECT c.word, f.form FROM c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
  SELECT c.word, c.at FROM c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
SELECT forms.word, form, chain.at AS root, n, n_near, form_n FROM forms JOIN chain ON chain.word = forms.word
"""
