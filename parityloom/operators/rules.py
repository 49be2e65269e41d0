"""Declarative rules: each row gets an array of violations, which becomes a long table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """fails holds for the rows that break the rule; a null does not break it."""

    name: str
    field: str
    fails: Column
    severity: str = "error"
    message: str = ""


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """df with violations, an array of (rule, field, severity, message)."""
    each = [F.when(r.fails, F.struct(F.lit(r.name).alias("rule"), F.lit(r.field).alias("field"), F.lit(r.severity).alias("severity"), F.lit(r.message).alias("message"))) for r in rules]
    return df.withColumn("violations", F.array_compact(F.array(*each)))


def violations(df: DataFrame, rules: Sequence[Rule], row_id: str) -> DataFrame:
    """(row_id, rule, field, severity, message), one row for each violation."""
    return check(df, rules).select(row_id, F.explode("violations").alias("v")).select(row_id, "v.*")


def summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows, rows without errors and with them, and violations by severity."""
    v = check(df, rules)
    of = lambda s: F.size(F.filter("violations", lambda x: x["severity"] == s))
    return v.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(of("error") == 0).alias("valid"), F.count_if(of("error") > 0).alias("invalid"), F.coalesce(F.sum(of("error")), F.lit(0)).alias("errors"), F.coalesce(F.sum(of("warning")), F.lit(0)).alias("warnings"))


def counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of each rule that has some."""
    each = F.explode("violations")
    return check(df, rules).select(each.alias("v")).groupBy("v.rule", "v.severity").agg(F.count(F.lit(1)).alias("n"))


def domain(field: str, allowed: Sequence[str], severity: str = "error") -> Rule:
    return Rule(f"{field}_domain", field, ~F.col(field).isin(list(allowed)), severity, f"{field} is not in its domain")


def between(field: str, low: float, high: float, severity: str = "error") -> Rule:
    return Rule(f"{field}_range", field, ~F.col(field).between(low, high), severity, f"{field} is not in {low}..{high}")


def matches(field: str, pattern: str, severity: str = "error") -> Rule:
    return Rule(f"{field}_pattern", field, ~F.col(field).rlike(pattern), severity, f"{field} does not look as it should")


def present(field: str, severity: str = "error") -> Rule:
    return Rule(f"{field}_present", field, F.coalesce(F.trim(F.col(field).cast("string")), F.lit("")) == "", severity, f"{field} is missing")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dependency(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """(determinant, n_rows, n_values, low, high): the groups where a column that should depend on others has several values.

    A null is a value like any other. Values are counted before groups are, so a large group is
    one row for each of its values.
    """
    values = df.groupBy(*determinant, dependent).agg(F.count(F.lit(1)).alias("c"))
    text = F.col(dependent).cast("string")
    got = values.groupBy(*determinant).agg(F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_values"), F.min(text).alias("low"), F.max(text).alias("high"))
    return got.where("n_values > 1")


def contradictions(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """The rows whose value is not the most frequent of their group (ties: the smallest), with that value as usual."""
    values = df.groupBy(*determinant, dependent).agg(F.count(F.lit(1)).alias("c"))
    best = values.groupBy(*determinant).agg(F.min(F.struct((-F.col("c")).alias("m"), F.col(dependent).isNull().alias("null_"), F.col(dependent).alias("value"))).alias("best_"), F.count(F.lit(1)).alias("kinds_")).where("kinds_ > 1")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in determinant]
    met = df.alias("d").join(best.alias("b"), same)
    return met.where(~F.col(f"d.{dependent}").eqNullSafe(F.col("b.best_.value"))).select("d.*", F.col("b.best_.value").alias("usual"))


def dangling(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, n_rows): references that the parent table lacks; a null is none. References are counted before they are looked up."""
    used = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def childless(parent: DataFrame, parent_key: str, df: DataFrame, key: str) -> DataFrame:
    """(parent_key) that no row refers to."""
    return parent.select(parent_key).distinct().join(df.select(F.col(key).alias(parent_key)), parent_key, "left_anti")


def repeated_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns, n): rows that are equal in all of them."""
    return repeated_keys(df, *columns)


def coverage(df: DataFrame, group: str, kind: str, least: dict[str, int]) -> DataFrame:
    """(group, kind, n, least) where a group has too few rows of a kind."""
    wanted = df.sparkSession.createDataFrame(list(least.items()), f"{kind} string, least int")
    groups = df.select(group).distinct().crossJoin(F.broadcast(wanted))
    got = df.groupBy(group, kind).agg(F.count(F.lit(1)).alias("n"))
    return groups.join(got, [group, kind], "left").select(group, kind, F.coalesce("n", F.lit(0)).alias("n"), "least").where("n < least")


# What names an occupation of higher education, and what a child may be.
STUDIED = [
    "profesor", "medic", "inginer", "avocat", "judecător", "procuror", "arhitect", "farmacist", "psiholog", "economist", "programator",
    "analist", "consultant", "manager senior", "director", "doctor", "cercetător", "universitar", "jurnalist", "traducător",
]
CHILDREN = ["elev", "student", "copil"]


def person_rules(mode: str = "ADULT_18", strict_places: bool = False) -> list[Rule]:
    """The rules on a record: structure, domains, and what age allows."""
    from ..functions.scalar import age_group, least_age
    from ..plans.people import MARGINALS

    low, high = {"ADULT_18": (18, 110), "YOUTH_15_PLUS": (15, 110), "ALL_AGES": (0, 110)}[mode]
    age, education = F.col("age"), F.col("education_level")
    higher = education.isin("Superior (Licență/Master)", "Doctorat")
    work = F.lower(F.coalesce(F.col("occupation"), F.lit("")))
    named = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(work, w))
    out = [
        between("age", low, high),
        Rule("age_group_matches", "age_group", F.col("age_group") != age_group(age), message="age group does not fit the age"),
        domain("sex", list(MARGINALS["sex"])),
        domain("region", list(MARGINALS["region"])),
        domain("residence_type", list(MARGINALS["residence_type"])),
        domain("education_level", list(MARGINALS["education_level"])),
        Rule("field_of_study_missing", "field_of_study", higher & F.col("field_of_study").isNull(), "warning", "higher education without a field"),
        Rule("education_too_early", "education_level", age < least_age(education), message="too young for the education"),
        Rule("married_too_early", "marital_status", (age < 16) & (F.col("marital_status") != "Necăsătorit"), message="too young to have married"),
        Rule("occupation_needs_study", "occupation", named(STUDIED) & ~F.coalesce(higher, F.lit(False)), "warning", "an occupation of higher education without it"),
        Rule("works_too_early", "occupation", (age < 14) & ~named(CHILDREN), "warning", "too young for an occupation"),
    ]
    if strict_places:
        out += [present("district"), Rule("city_empty", "city", F.coalesce(F.col("city"), F.lit("")) != "", message="strict places carry no city")]
    return out
