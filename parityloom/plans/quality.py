"""Text quality of a whole table: repetition, diversity, openings, anchors, safety."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import divergence, duplicates, profile


def _fields(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """(field, text) of several text columns; empty ones are left out."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in texts])
    return df.select(F.explode(each).alias("x")).select("x.field", "x.text").where(F.length(F.trim("text")) > 0)


def trigram_repetition(df: DataFrame, texts: Sequence[str], n: int = 3) -> DataFrame:
    """Different n-grams that occur more than once, by different n-grams.

    A gram stands as two 64-bit hashes of its words: two of a billion grams have the same with a chance of 1 in 10**20.
    """

    def hashed(w: Column) -> Column:
        def one(i: Column) -> Column:
            words = [F.get(w, i + k) for k in range(n)]
            return F.struct(F.xxhash64(*words).alias("a"), F.xxhash64(F.lit(1), *words).alias("b"))

        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), one))

    each = _fields(df, texts).select(F.explode(t.let(t.tokens(F.col("text")), hashed)).alias("g"))
    grams = each.groupBy("g.a", "g.b").agg(F.count(F.lit(1)).alias("c"))
    return grams.agg(F.count(F.lit(1)).alias("grams"), F.count_if(F.col("c") > 1).alias("repeated"), F.coalesce(F.count_if(F.col("c") > 1) / F.count(F.lit(1)), F.lit(0.0)).alias("rate"))


def lexical_diversity(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """Types by tokens of each field."""
    return profile.type_token(_fields(df, texts), t.tokens(F.col("text")), ["field"])


def sentence_starters(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """Entropy of the first words of sentences, and the part of them that is different."""
    each = _fields(df, texts).select(F.explode(t.sentences(F.lower("text"))).alias("s"))
    counts = each.select(F.get(F.split("s", r"\s+"), F.lit(0)).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return divergence.entropy(counts).crossJoin(counts.agg(F.sum("n").alias("total"))).select("entropy", (F.col("categories") / F.col("total")).alias("unique_ratio"))


def opening_moves(df: DataFrame, texts: Sequence[str], patterns: Mapping[str, str] = t.OPENING_MOVES) -> DataFrame:
    return profile.shares(_fields(df, texts), t.opening_move(F.col("text"), patterns))


def constraint_classes(df: DataFrame, constraints: str, keywords: Mapping[str, Sequence[str]] = t.CONSTRAINTS) -> DataFrame:
    """Shares of keyword classes over the entries of a list column."""
    return profile.shares(df.select(F.explode(constraints).alias("c")), t.keyword_class(F.col("c"), keywords))


def classes_by_group(df: DataFrame, constraints: str, group: str, keywords: Mapping[str, Sequence[str]] = t.CONSTRAINTS) -> DataFrame:
    rows = df.select(group, F.explode(constraints).alias("c")).select(group, t.keyword_class(F.col("c"), keywords).alias("class"))
    return profile.crosstab_shares(rows, group, "class")


def top_anchors(df: DataFrame, anchors: str, k: int = 50, cap: float = 0.05) -> DataFrame:
    """The k most common values of a map column, with their shares and whether they pass the cap."""
    counts = profile.shares(df.select(F.explode(F.map_values(anchors)).alias("a")), F.col("a"))
    return counts.orderBy(F.desc("n"), "value").limit(k).withColumn("over_cap", F.col("share") > cap)


def rare_anchor_rows(df: DataFrame, row_id: str, anchors: str, frequent: DataFrame) -> DataFrame:
    """Ids of rows with an anchor that is not among the frequent values."""
    each = df.select(row_id, F.explode(F.map_values(anchors)).alias("value"))
    return each.join(frequent.select("value"), "value", "left_anti").select(row_id).distinct()


def anchor_information(df: DataFrame, anchors: str, group: str) -> DataFrame:
    return divergence.mutual_information(df.select(group, F.explode(F.map_values(anchors)).alias("anchor")), "anchor", group)


def consequences(df: DataFrame, constraints: str, text: str, words: Mapping[str, Sequence[str]]) -> DataFrame:
    """For each class of constraint, how many rows that have it mention one of its consequences."""
    rows = df.select(F.col(text).alias("text"), F.explode(F.array_distinct(F.transform(constraints, lambda c: t.keyword_class(c)))).alias("class"))
    hit = F.lit(False)
    for name, each in words.items():
        hit = F.when(F.col("class") == name, t.contains_any(F.col("text"), each)).otherwise(hit)
    return rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("hits")).withColumn("ratio", F.col("hits") / F.col("n"))


def repeated_openings(df: DataFrame, row_id: str, texts: Sequence[str]) -> DataFrame:
    """(row_id, opening, n): openings that several texts of one row share."""
    each = F.explode(F.array(*[t.opening_words(F.col(f)) for f in texts]))
    return df.select(row_id, each.alias("opening")).where("opening <> ''").groupBy(row_id, "opening").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def sensitive_claims(df: DataFrame, row_id: str, text: Column, patterns: Mapping[str, Sequence[str]]) -> DataFrame:
    """(kind, severity, n, sample) of rows in which a kind's pattern is found; stereotypes are critical."""
    low = t.lower(text)
    kinds = F.array_compact(F.array(*[F.when(low.rlike("|".join(f"(?:{p})" for p in ps)), F.lit(k)) for k, ps in patterns.items()]))
    rows = df.select(F.col(row_id).alias("id"), F.substring(low, 1, 200).alias("sample"), F.explode(kinds).alias("kind"))
    out = rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min_by("sample", "id").alias("sample"))
    return out.withColumn("severity", F.when(F.contains("kind", F.lit("stereotype")), "critical").otherwise("warning"))


def determinism(df: DataFrame, pairs: Sequence[tuple[str, str]], limit: float = 0.5) -> DataFrame:
    """(group, value, dominated_by, share) where one value of a field holds more than limit of a protected group; one pass over all pairs."""
    columns = sorted({c for p in pairs for c in p})
    each = F.array(*[F.struct(F.lit(g).alias("group"), F.col(g).alias("value"), F.lit(k).alias("field"), F.col(k).alias("by")) for g, k in pairs])
    cells = df.select(*columns).select(F.explode(each).alias("x")).select("x.*").groupBy("group", "value", "field", "by").agg(F.count(F.lit(1)).alias("n"))
    shares = profile.with_share(cells, ["group", "value", "field"])
    return shares.where(F.col("share") > limit).select("group", "value", "field", F.col("by").alias("dominated_by"), "n", "share")


def report(df: DataFrame, row_id: str, texts: Sequence[str]) -> DataFrame:
    """One row of headline figures, with a score out of 100."""
    from ..operators.common import saved

    rows = saved(df.select(row_id, *texts), "quality")
    joined = rows.select(row_id, F.concat_ws(" ", *texts).alias("text"))
    pairs, members = duplicates.similar_classes(joined, row_id, "text")
    unique = duplicates.uniqueness(pairs, members)
    diversity = lexical_diversity(rows, texts).agg(F.avg("ratio").alias("diversity"))
    got = unique.crossJoin(trigram_repetition(rows, texts)).crossJoin(sentence_starters(rows, texts)).crossJoin(diversity)
    return got.withColumn("score", duplicates.quality_score(F.col("uniqueness"), F.col("rate"), F.coalesce("diversity", F.lit(0.0))))
