"""Narratives against their own records: what is mentioned, what contradicts, which fields hold, which openings repeat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

# The woman's sex in records, what speaks of the other sex, words of either sex, and signs of years of work.
FEMALE = "Feminin"
OF_MEN = [" el ", " lui ", "bărbat", "un băiat", " el\n", " el."]
OF_WOMEN = [" ea ", " ei ", "femeie", "o fată", " ea\n", " ea."]
MALE_WORDS = ["el", "lui", "bărbat", "băiat"]
FEMALE_WORDS = ["ea", "ei", "femeie", "fată"]
YEARS_OF_WORK = ["10 ani experiență", "20 de ani de muncă", "carieră de ", "pensionar", "la pensie"]
# Words that show friction.
FRICTION = [
    "dar", "totuși", "deși", "însă", "uneori", "din când în când", "îl irită", "o irită", "îl enervează", "îi e greu", "îi e dificil",
    "nu suportă", "evită", "obosit", "stresat", "probleme", "dificultăți", "limitat", "restrictiv", "nu-și permite", "prea scump",
    "bătăi de cap", "complicații",
]


def combined(texts: Sequence[str]) -> Column:
    """The texts of a row, lower-cased, one after the other."""
    return F.lower(F.array_join(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in texts]), " "))


def _first_name(name: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(name), F.lit("")), r"^\s*(\S*)", 1))


def _any(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def mentions(df: DataFrame, texts: Sequence[str], age: str = "age", occupation: str = "occupation", region: str = "region", name: str = "name", sex: str = "sex") -> DataFrame:
    """df with issues, an array: age_missing, occupation_missing, region_missing, name_missing, other_pronoun, other_pronoun_first.

    Fields of a row are looked for in the texts of that row, as plain text. An occupation counts for
    ages of 18 to 64 and is there if one of its words of over three letters is. A null field is an empty one; an
    empty region or name is always there, and a null age never.
    """
    low = F.col("text_")
    words = F.filter(F.split(F.lower(F.coalesce(F.col(occupation), F.lit(""))), r"\s+"), lambda w: F.length(w) > 3)
    female = F.coalesce(F.col(sex) == FEMALE, F.lit(False))
    checks = {
        "age_missing": ~F.coalesce(F.contains(low, F.concat(F.col(age).cast("string"), F.lit(" ani"))), F.lit(False)),
        "occupation_missing": F.coalesce(F.col(age).between(18, 64), F.lit(False)) & ~F.exists(words, lambda w: F.contains(low, w)),
        "region_missing": ~F.contains(low, F.lower(F.coalesce(F.col(region), F.lit("")))),
        "name_missing": ~F.contains(low, _first_name(name)),
        "other_pronoun": F.when(female, _any(low, OF_MEN)).otherwise(_any(low, OF_WOMEN)),
        "other_pronoun_first": F.when(female, F.startswith(low, F.lit("el "))).otherwise(F.startswith(low, F.lit("ea "))),
    }
    each = [F.when(c, F.lit(k)) for k, c in checks.items()]
    return df.withColumn("text_", combined(texts)).withColumn("issues", F.array_compact(F.array(*each))).drop("text_")


def conflicts(df: DataFrame, texts: Sequence[str], age: str = "age", name: str = "name", sex: str = "sex") -> DataFrame:
    """df with conflicts, an array of (field, severity, message) of rows whose first text is not empty: the name is not
    there, over two kinds of words of the other sex are, or someone under 18 has years of work."""
    low = F.col("text_")
    kinds = lambda words: sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))
    male = F.coalesce(F.col(sex) == "Masculin", F.lit(False))
    other = F.when(male, kinds(FEMALE_WORDS)).otherwise(kinds(MALE_WORDS))
    one = lambda when, field, severity, message: F.when(when, F.struct(F.lit(field).alias("field"), F.lit(severity).alias("severity"), F.lit(message).alias("message")))
    each = [one(~F.contains(low, _first_name(name)), texts[0], "warning", "name is not in the text"), one(other > 2, texts[0], "warning", "words of the other sex")]
    each += [one((F.col(age) < 18) & F.contains(low, F.lit(w)), texts[min(1, len(texts) - 1)], "error", f"under 18 with: {w}") for w in YEARS_OF_WORK]
    there = F.coalesce(F.col(texts[0]), F.lit("")) != ""
    none = F.array().cast("array<struct<field:string,severity:string,message:string>>")
    return df.withColumn("text_", combined(texts)).withColumn("conflicts", F.when(there, F.array_compact(F.array(*each))).otherwise(none)).drop("text_")


def _field(name: str, least: int, most: int) -> Column:
    raw = F.regexp_replace(F.coalesce(F.col(name).cast("string"), F.lit("")), r"^\s+|\s+$", "")
    size = F.length(raw)
    marks = F.regexp_count(raw, F.lit("[ăâîșțĂÂÎȘȚ]"))
    common = F.regexp_count(F.lower(raw), F.lit(r"(?<![\p{L}\p{N}_])(?:" + "|".join(t.COMMON_WORDS) + r")(?![\p{L}\p{N}_])"))
    return F.struct(F.lit(name).alias("field"), (size > 0).alias("present"), ((size > 0) & (size < least)).alias("short"), (size > most).alias("long"), ((size > 0) & ((marks >= 2) | (common >= 3))).alias("language"), F.when(size > 0, t.institution_names(raw)).otherwise(0).alias("institutions"))


def _fields(fields: Mapping[str, tuple[int, int]]) -> Column:
    return F.array(*[_field(f, *bounds) for f, bounds in fields.items()])


def field_counters(df: DataFrame, fields: Mapping[str, tuple[int, int]]) -> DataFrame:
    """(field, n, present, missing, too_short, too_long, length_ok, language_ok, language_fail, valid) of texts with bounds of their length; one scan."""
    x = df.select(F.explode(_fields(fields)).alias("f")).select("f.*")
    fits = F.col("present") & ~F.col("short") & ~F.col("long")
    n = F.count_if
    return x.groupBy("field").agg(
        F.count(F.lit(1)).alias("n"), n("present").alias("present"), n(~F.col("present")).alias("missing"), n("short").alias("too_short"), n("long").alias("too_long"),
        n(fits).alias("length_ok"), n("language").alias("language_ok"), n(F.col("present") & ~F.col("language")).alias("language_fail"), n(fits & F.col("language")).alias("valid"),
    )


def row_counters(df: DataFrame, fields: Mapping[str, tuple[int, int]]) -> DataFrame:
    """One row of how many rows have any and all fields valid, a field too short or too long, all lengths and all languages right, and over three institutions named in all."""
    x = df.select(_fields(fields).alias("f"))
    fits = lambda f: f["present"] & ~f["short"] & ~f["long"]
    every, some = (lambda p: F.forall("f", p)), (lambda p: F.exists("f", p))
    hits = F.aggregate("f", F.lit(0), lambda a, f: a + f["institutions"])
    n = F.count_if
    return x.agg(
        F.count(F.lit(1)).alias("n"), n(some(lambda f: fits(f) & f["language"])).alias("any_valid"), n(every(lambda f: fits(f) & f["language"])).alias("all_valid"),
        n(some(lambda f: f["short"])).alias("too_short"), n(some(lambda f: f["long"])).alias("too_long"), n(every(fits)).alias("length_valid"),
        n(every(lambda f: f["language"])).alias("language_valid"), n(hits > 3).alias("potential_pii"),
    )


def not_too_rosy(df: DataFrame, group: str, text: str, markers: Sequence[str] = tuple(FRICTION)) -> DataFrame:
    """(group, n_texts, friction, words, ratio, passed): markers found in the texts of a group for each hundred words; it passes with one a text and a ratio over a half."""
    words = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != ""))
    sums = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.size(t.found_words(F.col(text), markers))).alias("friction"), F.sum(words).alias("words"))
    ratio = F.col("friction") / F.greatest(F.col("words") * 0.01, F.lit(1.0))
    return sums.withColumn("ratio", ratio).withColumn("passed", (F.col("friction") >= F.col("n_texts")) & (F.col("ratio") > 0.5))


def shared_openings(df: DataFrame, row_id: str, texts: Sequence[str]) -> DataFrame:
    """(row_id, failing): the places, from 0, of texts of a row that open like another of it; an empty text opens like any other empty one."""
    each = F.posexplode(F.array(*[t.opening_words(F.col(f)) for f in texts]))
    found = df.select(row_id, each.alias("at", "opening")).groupBy(row_id, "opening").agg(F.collect_list("at").alias("places")).where(F.size("places") > 1)
    return found.groupBy(row_id).agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("failing"))
