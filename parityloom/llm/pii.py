"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base spans are the matches of one pattern a kind that pass the kind's test. They
are seeds: the words to their left and right are lexical patterns, and every other
token of LEAST_LENGTH characters with a digit or an at sign that stands in such a pattern is a possible
identifier. Patterns and instances (normalised tokens) make a bipartite graph.
Rounds over it set a pattern's confidence to the mean score of its instances,
damped by DAMP for thin support, and an unseen instance's score to the complement
of the product of its patterns' doubts; a seed's score stays 1. A pattern is
confident from LEAST_CONFIDENCE on if at least LEAST_SEEDS of its instances are seeds or
stand in a pattern that was confident the round before, so that what is discovered
discovers more. Rounds end when no pattern becomes confident, or after ROUNDS of them. An occurrence
becomes a span of kind `learned` if it stands in a confident pattern. Spans added never
overlap base spans.

The graph holds each (pattern, instance) once, so copies of a text add nothing,
and each round is joins and partial aggregations over it.

Nulls: a null text is empty and has no span; a null id is kept. Repeated rows are
read each for itself, an empty table gives no rows, other columns are ignored.
Positions count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, let, saved

# One pattern a kind. A match starts where the one before it ended or
# where its run starts, so no run of characters is tried from each of its places.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a kind to be looked for.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KINDS = list(PATTERNS)
ROUNDS, DAMP, LEAST_CONFIDENCE, LEAST_SEEDS, LEAST_LENGTH = 8, 2.0, 0.6, 3, 6
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_EDGES = "\"'`()[]{}<>.,;:!?"


def found(text: Column, pattern: str) -> Column:
    """Matches of pattern as structs (s, e, m): start, end and text."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(both: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

        def add(acc: Column, i: Column) -> Column:
            s = acc["at"] + F.length(F.get(both["gaps"], i))
            m = F.get(both["hits"], i)
            e = s + F.length(m)
            one = F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"), m.alias("m"))
            return F.struct(e.cast("int").alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        n = F.size(both["hits"])
        return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), start, add, lambda acc: acc["out"])).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))

    return let(F.struct(gaps.alias("gaps"), hits.alias("hits")), placed)


def _luhn(digits: Column) -> Column:
    """The Luhn sum of the digits is a multiple of ten."""
    places = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(places, F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return let(F.regexp_replace(match, r"[\x20-]", ""), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _of_kind(k: int) -> Column:
    good = F.filter(found(F.col("text"), PATTERNS[KINDS[k]]), lambda x: passes(KINDS[k], x["m"]))
    return F.transform(good, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), x["m"].alias("m")))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, base): base spans (s, k, e, m) in order of start, then kind."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.array().cast("array<struct<s:int,k:int,e:int,m:string>>")
    parts = []
    for k, kind in enumerate(KINDS):
        hint = F.contains(F.col("text"), F.lit(HINTS[kind])) if HINTS[kind] else F.lit(True)
        parts.append(F.when(hint & F.col("text").rlike("[0-9]" if kind != "email" else "@"), _of_kind(k)).otherwise(none))
    return rows.withColumn("base", F.array_sort(F.concat(*parts)))


def _edge_word(text: Column, last: bool) -> Column:
    """The last or first word of a stretch of text, in lower case, without punctuation around it."""
    flat = F.translate(text, "\t\n\r\x0b\x0c", "     ")
    word = F.substring_index(F.rtrim(flat), " ", -1) if last else F.substring_index(F.ltrim(flat), " ", 1)
    return F.lower(F.btrim(word, F.lit(_EDGES)))


def _tokens(text: Column) -> Column:
    """Tokens with a digit or an at sign as structs (s, e, m, left, right)."""
    gaps = F.split(text, _TOKEN, -1)
    return let(
        F.struct(found(text, _TOKEN).alias("at"), gaps.alias("gaps")),
        lambda b: F.transform(b["at"], lambda x, i: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), _edge_word(F.get(b["gaps"], i), True).alias("left"), _edge_word(F.get(b["gaps"], i + 1), False).alias("right"))),
    )


def occurrences(spans: DataFrame) -> DataFrame:
    """One row for each token that may be an identifier: its place, patterns, and whether a base span is in it."""
    tokens = F.when(F.col("text").rlike("[0-9@]"), _tokens(F.col("text")))
    rows = spans.withColumn("key", F.xxhash64("doc_id", "text")).select("doc_id", "key", "base", F.explode(tokens).alias("t"))
    inside = F.exists("base", lambda x: (x["s"] < F.col("t.e")) & (x["e"] > F.col("t.s")))
    # punctuation around the token is no part of it
    bare = F.ltrim(F.col("t.m"), F.lit(_EDGES))
    s = F.col("t.s") + F.length("t.m") - F.length(bare)
    core = F.rtrim(bare, F.lit(_EDGES))
    left, right = F.col("t.left") != "", F.col("t.right") != ""
    # a pattern holds a word: the edge of a text is none
    patterns = F.array_compact(F.array(F.when(left, F.concat(F.lit("L "), "t.left")), F.when(right, F.concat(F.lit("R "), "t.right")), F.when(left & right, F.concat_ws(" ", F.lit("B"), "t.left", "t.right"))))
    named = left | right
    return rows.where(named).select("doc_id", "key", s.alias("s"), (s + F.length(core)).alias("e"), F.xxhash64(F.lower(core)).alias("instance"), F.transform(patterns, lambda p: F.xxhash64(p)).alias("patterns"), inside.alias("seed")).where((F.col("e") - F.col("s") >= LEAST_LENGTH) | F.col("seed"))


def confident_patterns(graph: DataFrame) -> DataFrame:
    """(pattern) of the confident ones, from edges (pattern, instance, seed)."""
    # saved tables: each join then has two exchanges of its own, whose hot keys Spark can split
    scores = saved(graph.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"), F.max("seed").alias("known")), "scores")
    before = -1
    for _ in range(ROUNDS):
        mean = graph.join(scores, "instance").groupBy("pattern").agg((F.sum("score") / (F.count("*") + DAMP)).alias("confidence"), F.sum(F.col("known").cast("long")).alias("support"))
        patterns = saved(mean.withColumn("good", (F.col("confidence") >= LEAST_CONFIDENCE) & (F.col("support") >= LEAST_SEEDS)), "patterns")
        good = patterns.where("good").select("pattern")
        now = good.count()
        if now == before:
            break
        before = now
        doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999))))
        score = F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(doubt))
        forget(scores)
        scores = saved(graph.join(patterns, "pattern").groupBy("instance").agg(score.alias("score"), (F.max("seed") | F.max("good")).alias("known")), "scores")
    forget(scores)
    return good


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, learned): spans of every row as arrays of (s, k, e, m)."""
    spans = saved(base_spans(docs, id_col, text_col).where(F.col("text").rlike("[0-9@]")), "spans", "zstd")
    seen = saved(occurrences(spans), "occurrences")
    graph = saved(seen.select(F.explode("patterns").alias("pattern"), "instance", "seed").groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "graph")
    good = confident_patterns(graph)
    hits = seen.where(~F.col("seed")).select("doc_id", "key", "s", "e", F.explode("patterns").alias("pattern")).join(good, "pattern", "left_semi").select("doc_id", "key", "s", "e").distinct()
    one = F.struct("s", F.lit(len(KINDS)).alias("k"), "e", F.lit("").alias("m"))
    learned = hits.groupBy("key").agg(F.array_sort(F.collect_list(one)).alias("learned"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(~F.col("text").rlike("[0-9@]")).select("doc_id")
    none = F.array().cast("array<struct<s:int,k:int,e:int,m:string>>")
    held = spans.withColumn("key", F.xxhash64("doc_id", "text")).select("doc_id", "key", "base")
    with_learned = held.join(learned, "key", "left").select("doc_id", "base", F.coalesce("learned", none).alias("learned"))
    return with_learned.unionByName(rows.select("doc_id", none.alias("base"), none.alias("learned")))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, [*KINDS, "learned"]))
    return F.array_join(F.transform(spans, lambda x: F.concat(F.get(names, x["k"]), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")
