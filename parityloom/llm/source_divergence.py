"""How far the sources of a language are from each other and from the language, in whole numbers.

Terms are runs of letters (every character that is no ASCII control, mark, digit or blank), with
only A-Z lower-cased. A language keeps the terms of at least LEAST_DOCS of its rows. Each source of
a language, and the language itself, gives each kept term a share in parts of SCALE, smoothed so that
none is zero; the divergence of two shares p and q is floor((p - q)**2 / (p + q)).

All of it is relational: matches are exploded and counted by (lang, source, term); groups are crossed
with the kept terms of their language, so that absent terms count zero; a self-join on lang and
term compares sources; sums and ranks follow. The cross meets no hot key, since the terms of a
language are dealt out over lanes and its few groups are copied to each; the self-join is by
(lang, term), of which each source has one row, however many documents it has. Counts are added
up before every shuffle.

Nulls in text, lang or source are empty strings. Every row is a document of its own, repeated or
not. A group without terms takes part with zeros; a language without kept terms has its pairs of
sources with value 0 and no terms. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, saved, shuffle_width

LEAST_DOCS, SCALE, TOP = 10, 1_000_000_000, 10
#: What stands between terms. Splitting there finds the matches of its complement, ten times as fast as looking for them.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["lang", "source"]


def ascii_lower(text: Column) -> Column:
    """text with A-Z lower-cased, and nothing else."""
    return F.translate(text, UPPER, LOWER)


def matches(text: Column, between: str) -> Column:
    """The runs of characters that between does not match, in order."""
    return F.array_remove(F.split(text, between, -1), "")


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, df): occurrences and rows that have the term; a row with a null term for groups without any."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), matches(ascii_lower(empty(text_col)), BETWEEN).alias("all"))
    # each match once for n, and each term of a row once for df
    both = F.array(F.struct(F.lit(0).alias("k"), F.col("all").alias("terms")), F.struct(F.lit(1).alias("k"), F.array_distinct("all").alias("terms")))
    parts = rows.select(*KEY, F.explode(both).alias("b")).select(*KEY, F.col("b.k").alias("k"), F.explode_outer("b.terms").alias("term"))
    of = lambda k: F.sum(F.when(F.col("k") == k, 1).otherwise(0)).cast("long")
    return parts.groupBy(*KEY, "term").agg(of(0).alias("n"), of(1).alias("df"))


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE (n + 2) / (total + 2 terms)); decimals hold what a long may not."""
    wide = lambda c: F.col(c).cast("decimal(24,0)")
    up = wide(n) + F.lit(2).cast("decimal(2,0)")
    down = wide(total) + wide(terms) + wide(terms)
    return F.call_function("div", (up * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(38,0)"), down.cast("decimal(38,0)")) + 1


def gap(p: str, q: str) -> Column:
    return F.call_function("div", (F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(p) + F.col(q))


def shares(found: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, p, q) of every group of counts and kept term of its language, zeros included."""
    terms = found.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    kept = saved(terms.where(F.col("df") >= least_docs).select("lang", "term", "n"), "kept", "zstd")
    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    within = found.where("term IS NOT NULL").join(kept.select("lang", "term"), ["lang", "term"], "left_semi")
    sums = within.groupBy(*KEY).agg(F.sum("n").alias("total"))
    groups = found.select(*KEY).distinct().join(sums, KEY, "left").join(of_lang.select("lang", "terms"), "lang").select(*KEY, F.coalesce("total", F.lit(0)).alias("total"), "terms")
    lanes = shuffle_width(found.sparkSession)
    dealt = kept.join(of_lang, "lang").select("lang", "term", share("n", "total", "terms").alias("q"), F.pmod(F.xxhash64("term"), F.lit(lanes)).alias("lane"))
    copied = groups.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
    # zeros and counts meet in one sum, with no join of all cells
    zeros = dealt.join(copied, ["lang", "lane"]).select("lang", "term", "source", F.lit(0).cast("long").alias("n"), "total", "terms", "q")
    none = F.lit(None).cast("long")
    met = zeros.unionByName(within.select("lang", "term", "source", "n", none.alias("total"), none.alias("terms"), none.alias("q"))).repartition("lang", "term")
    cells = met.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in ("total", "terms", "q")])
    out = saved(cells.select(*KEY, "term", "n", share("n", "total", "terms").alias("p"), "q"), "shares", "zstd")
    forget(kept)
    return out


def source_pairs(cells: DataFrame, found: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each source of a language and each other one."""
    side = cells.select("lang", "term", "source", "p")
    met = side.alias("a").join(side.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.term") == F.col("b.term")) & (F.col("a.source") < F.col("b.source")))
    once = met.select(F.col("a.lang").alias("lang"), F.col("a.source").alias("x"), F.col("b.source").alias("y"), gap("a.p", "b.p").alias("f")).groupBy("lang", "x", "y").agg(F.sum("f").alias("value"))
    # languages without a kept term
    bare = found.select(*KEY).distinct().join(cells.select("lang").distinct(), "lang", "left_anti")
    zero = bare.alias("a").join(bare.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") < F.col("b.source"))).select("a.lang", F.col("a.source").alias("x"), F.col("b.source").alias("y"), F.lit(0).cast("long").alias("value"))
    sides = F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item")))
    return once.unionByName(zero).select("lang", F.explode(sides).alias("s"), "value").select("lang", "s.source", "s.item", "value")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and the top terms of each against its language."""
    found = saved(counts(docs, text_col, lang_col, source_col), "counts", "zstd")
    cells = shares(found, least_docs)
    pairs = source_pairs(cells, found).withColumn("part", F.lit("pair"))
    more = cells.where((F.col("n") > 0) & (F.col("p") > F.col("q"))).select(*KEY, F.col("term").alias("item"), gap("p", "q").alias("value"), F.lit("term").alias("part"))
    order = Window.partitionBy(*KEY).orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).cast("int")
    tops = more.withColumn("rank", rank).where(F.col("rank") <= top)
    every = pairs.withColumn("rank", rank).unionByName(tops)
    return every.select(*KEY, "part", "item", F.col("value").cast("long").alias("value"), "rank")


SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
m AS (SELECT r, lang, source, unnest(t) AS term FROM rows),
kept AS (SELECT lang, term FROM m GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
grp AS (SELECT DISTINCT lang, source FROM rows),
n AS (SELECT lang, source, term, count(*) AS n FROM m JOIN kept USING (lang, term) GROUP BY ALL),
cell AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n FROM grp g JOIN kept k ON g.lang = k.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
p AS (SELECT c.*, CAST(1 + (CAST(1000000000 AS HUGEINT) * (c.n + 2)) // (sum(c.n) OVER (PARTITION BY c.lang, c.source) + 2 * v.v) AS BIGINT) AS p FROM cell c JOIN v ON v.lang = c.lang),
q AS (SELECT l.lang, l.term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (l.n + 2)) // (sum(l.n) OVER (PARTITION BY l.lang) + 2 * v.v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cell GROUP BY 1, 2) l JOIN v ON v.lang = l.lang),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) AS BIGINT) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 10
"""
