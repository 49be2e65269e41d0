"""Queries on narratives and their records, kept results, and histograms against a law."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import divergence, profile, targets
from ..operators.common import shared_folder
from ..sources import cache
from . import catalogue_rules, narratives
from .catalogue import counted, long, query, r6, table

# ---- records and their narratives ----------------------------------------------------------------

# a record is made of a document: its first words are a name, a region and an occupation
RECORD_SQL = r"""w AS (SELECT *, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS w FROM documents),
r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Feminin' ELSE 'Masculin' END AS sex, 8 + doc_id % 70 AS age, coalesce(w[3], '') || ' ' || lang AS occupation,
coalesce(w[2], '') || CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE '' END AS region, coalesce(w[1], '') || CASE WHEN doc_id % 7 = 0 THEN 'y' ELSE '' END || ' Popa' AS name,
CASE WHEN doc_id % 11 = 0 THEN 'El ' WHEN doc_id % 13 = 0 THEN 'Ea ' ELSE '' END || coalesce(text, '') AS life,
CASE WHEN doc_id % 4 = 0 THEN 'Are ' || (8 + doc_id % 70) || ' ani.' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN ' O femeie, o fată, ei.' WHEN doc_id % 5 = 1 THEN ' Un bărbat cu un băiat, lui.' ELSE '' END
|| CASE WHEN doc_id % 9 = 0 THEN ' E pensionar, la pensie.' ELSE '' END AS work FROM w),
t AS (SELECT *, lower(life || ' ' || work) AS t FROM r)"""


def records(spark, sf_dir):
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+"), lambda x: x != "")
    word = lambda i: F.coalesce(F.get("w", F.lit(i)), F.lit(""))
    i = F.col("doc_id")
    age = 8 + i % 70
    added = lambda when, yes: F.when(when, F.lit(yes)).otherwise("")
    work = F.concat(
        F.when(i % 4 == 0, F.concat(F.lit("Are "), age.cast("string"), F.lit(" ani."))).otherwise(""),
        F.when(i % 5 == 0, " O femeie, o fată, ei.").when(i % 5 == 1, " Un bărbat cu un băiat, lui.").otherwise(""),
        added(i % 9 == 0, " E pensionar, la pensie."),
    )
    life = F.concat(F.when(i % 11 == 0, "El ").when(i % 13 == 0, "Ea ").otherwise(""), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").withColumn("w", words).select(
        "doc_id", F.when(i % 2 == 0, "Feminin").otherwise("Masculin").alias("sex"), age.alias("age"), F.concat(word(2), F.lit(" "), "lang").alias("occupation"),
        F.concat(word(1), added(i % 3 == 0, "x")).alias("region"), F.concat(word(0), added(i % 7 == 0, "y"), F.lit(" Popa")).alias("name"), life.alias("life"), work.alias("work"),
    )


@query(f"""WITH {RECORD_SQL}, i AS (SELECT doc_id, [
CASE WHEN NOT contains(t, age || ' ani') THEN 'age_missing' END,
CASE WHEN age >= 18 AND age < 65 AND len(list_filter(string_split(lower(occupation), ' '), lambda x: length(x) > 3 AND contains(t, x))) = 0 THEN 'occupation_missing' END,
CASE WHEN NOT contains(t, lower(region)) THEN 'region_missing' END,
CASE WHEN NOT contains(t, string_split(lower(name), ' ')[1]) THEN 'name_missing' END,
CASE WHEN sex = 'Feminin' AND (contains(t, ' el ') OR contains(t, ' lui ') OR contains(t, 'bărbat') OR contains(t, 'un băiat') OR contains(t, ' el' || chr(10)) OR contains(t, ' el.'))
OR sex <> 'Feminin' AND (contains(t, ' ea ') OR contains(t, ' ei ') OR contains(t, 'femeie') OR contains(t, 'o fată') OR contains(t, ' ea' || chr(10)) OR contains(t, ' ea.')) THEN 'other_pronoun' END,
CASE WHEN starts_with(t, CASE WHEN sex = 'Feminin' THEN 'el ' ELSE 'ea ' END) THEN 'other_pronoun_first' END] AS i FROM t)
SELECT doc_id, array_to_string(list_filter(i, lambda x: x IS NOT NULL), ',') AS issues FROM i""")
def record_mentions(spark, sf_dir):
    return narratives.mentions(records(spark, sf_dir), ["life", "work"]).select("doc_id", F.array_join("issues", ",").alias("issues"))


@query(f"""WITH {RECORD_SQL}, i AS (SELECT doc_id, life, [
CASE WHEN NOT contains(t, string_split(lower(name), ' ')[1]) THEN 'life:warning' END,
CASE WHEN sex = 'Masculin' AND len(list_filter(['ea', 'ei', 'femeie', 'fată'], lambda x: contains(t, x))) > 2 OR sex = 'Feminin' AND len(list_filter(['el', 'lui', 'bărbat', 'băiat'], lambda x: contains(t, x))) > 2 THEN 'life:warning' END,
CASE WHEN age < 18 AND contains(t, '10 ani experiență') THEN 'work:error' END, CASE WHEN age < 18 AND contains(t, '20 de ani de muncă') THEN 'work:error' END, CASE WHEN age < 18 AND contains(t, 'carieră de ') THEN 'work:error' END,
CASE WHEN age < 18 AND contains(t, 'pensionar') THEN 'work:error' END, CASE WHEN age < 18 AND contains(t, 'la pensie') THEN 'work:error' END] AS i FROM t)
SELECT doc_id, CASE WHEN life = '' THEN '' ELSE array_to_string(list_filter(i, lambda x: x IS NOT NULL), ',') END AS conflicts FROM i""")
def record_conflicts(spark, sf_dir):
    got = narratives.conflicts(records(spark, sf_dir), ["life", "work"])
    return got.select("doc_id", F.array_join(F.transform("conflicts", lambda c: F.concat(c["field"], F.lit(":"), c["severity"])), ",").alias("conflicts"))


FIELDS = {"life": (50, 4000), "work": (20, 60), "name": (6, 200)}
FIELDS_SQL = rf"""WITH {RECORD_SQL}, o AS (SELECT doc_id, repeat('Firma Alfa SRL. ', doc_id % 6) || life AS life, work, name FROM r),
f AS (SELECT doc_id, 'life' AS field, life AS x, 50 AS lo, 4000 AS hi FROM o UNION ALL SELECT doc_id, 'work', work, 20, 60 FROM o UNION ALL SELECT doc_id, 'name', name, 6, 200 FROM o),
s AS (SELECT doc_id, field, lo, hi, regexp_replace(x, '^\s+|\s+$', '', 'g') AS x FROM f),
c AS (SELECT doc_id, field, length(x) > 0 AS present, length(x) > 0 AND length(x) < lo AS short, length(x) > hi AS long, len(regexp_extract_all(x, 'Firma Alfa SRL\.')) AS pii,
length(x) > 0 AND (len(regexp_extract_all(x, '[ăâîșțĂÂÎȘȚ]')) >= 2 OR len(list_filter(regexp_extract_all(lower(x), '[\p{{L}}\p{{N}}_]+'), lambda w: w IN ('sunt', 'și', 'pentru', 'din', 'cu', 'care', 'mai', 'să', 'mă', 'te', 'se', 'în', 'la', 'pe', 'o', 'un'))) >= 3) AS lang FROM s)"""


def with_names(spark, sf_dir):
    return records(spark, sf_dir).withColumn("life", F.concat(F.repeat(F.lit("Firma Alfa SRL. "), (F.col("doc_id") % 6).cast("int")), "life"))


@query(f"""{FIELDS_SQL} SELECT field, count(*) AS n, count(*) FILTER (present) AS present, count(*) FILTER (NOT present) AS missing, count(*) FILTER (short) AS too_short, count(*) FILTER (long) AS too_long,
count(*) FILTER (present AND NOT short AND NOT long) AS length_ok, count(*) FILTER (lang) AS language_ok, count(*) FILTER (present AND NOT lang) AS language_fail, count(*) FILTER (present AND NOT short AND NOT long AND lang) AS valid FROM c GROUP BY 1""")
def field_counters(spark, sf_dir):
    return narratives.field_counters(with_names(spark, sf_dir), FIELDS)


@query(f"""{FIELDS_SQL}, r2 AS (SELECT doc_id, bool_or(present AND NOT short AND NOT long AND lang) AS any_, bool_and(present AND NOT short AND NOT long AND lang) AS all_, bool_or(short) AS s, bool_or(long) AS l, bool_and(present AND NOT short AND NOT long) AS fits, bool_and(lang) AS lang, sum(pii) AS pii FROM c GROUP BY 1)
SELECT count(*) AS n, count(*) FILTER (any_) AS any_valid, count(*) FILTER (all_) AS all_valid, count(*) FILTER (s) AS too_short, count(*) FILTER (l) AS too_long, count(*) FILTER (fits) AS length_valid, count(*) FILTER (lang) AS language_valid, count(*) FILTER (pii > 3) AS potential_pii FROM r2""")
def row_counters(spark, sf_dir):
    return narratives.row_counters(with_names(spark, sf_dir), FIELDS)


MARKERS_SQL = "['" + "', '".join(narratives.FRICTION) + "']"


@query(rf"""WITH t AS (SELECT conv_id, len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> '')) AS w, len(list_filter({MARKERS_SQL}, lambda x: contains(lower(coalesce(text, '')), x))) AS f FROM conversations)
SELECT conv_id, count(*) AS n_texts, CAST(sum(f) AS BIGINT) AS friction, CAST(sum(w) AS BIGINT) AS words, round(sum(f) / greatest(sum(w) * 0.01, 1), 6) AS ratio, sum(f) >= count(*) AND sum(f) / greatest(sum(w) * 0.01, 1) > 0.5 AS passed FROM t GROUP BY 1""")
def not_too_rosy(spark, sf_dir):
    return narratives.not_too_rosy(table(spark, sf_dir, "conversations"), "conv_id", "text").withColumn("ratio", r6("ratio"))


@query(r"""WITH t AS (SELECT doc_id, unnest([0, 1, 2, 3]) AS place, unnest([text, lang || ' ' || text, source || ' ' || text, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text || ' more' END]) AS x FROM documents),
f AS (SELECT doc_id, place, regexp_replace(array_to_string(list_filter(string_split_regex(lower(coalesce(x, '')), '\s+'), lambda w: w <> '')[1:8], ' '), '^[a-zăâîșț]+\s+', '') AS opening FROM t),
k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, opening) AS n FROM f) SELECT doc_id, string_agg(place, ',' ORDER BY place) AS failing FROM k WHERE n > 1 GROUP BY 1""")
def shared_openings(spark, sf_dir):
    x = F.col("text")
    made = table(spark, sf_dir, "documents").select("doc_id", x.alias("a"), F.concat("lang", F.lit(" "), x).alias("b"), F.concat("source", F.lit(" "), x).alias("c"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(x, F.lit(" more"))).alias("d"))
    return narratives.shared_openings(made, "doc_id", ["a", "b", "c", "d"]).select("doc_id", F.array_join(F.col("failing").cast("array<string>"), ",").alias("failing"))


# ---- kept results --------------------------------------------------------------------------------


@query("""WITH a AS (SELECT c_mktsegment AS row, count(*) / sum(count(*)) OVER () AS p FROM customer GROUP BY 1), b AS (SELECT o_orderpriority AS col, count(*) / sum(count(*)) OVER () AS q FROM orders GROUP BY 1)
SELECT row, col, round(p * q, 6) AS p, FALSE AS first_found, TRUE AS again_found FROM a, b""")
def cached_crosstab(spark, sf_dir):
    """A cross-tabulation from two marginals, computed once and found the second time."""
    a, b = counted(table(spark, sf_dir, "customer"), "c_mktsegment"), counted(table(spark, sf_dir, "orders"), "o_orderpriority")
    folder = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
    get = lambda: cache.kept(spark, folder, "segment_by_priority", cache.table_signature(a, b), lambda: targets.independent(a, b))
    _, first = get()
    out, again = get()
    return out.select("row", "col", r6("p").alias("p"), F.lit(first).alias("first_found"), F.lit(again).alias("again_found"))


# ---- histograms against a law --------------------------------------------------------------------


def erf_tail(z: str) -> str:
    t = f"(1 / (1 + 0.3275911 * abs({z}) / sqrt(2)))"
    return f"(((((1.061405429 * {t} - 1.453152027) * {t} + 1.421413741) * {t} - 0.284496736) * {t} + 0.254829592) * {t} * exp(-({z}) * ({z}) / 2) / 2)"


def cdf(z: str) -> str:
    return f"(CASE WHEN {z} >= 0 THEN 1 - {erf_tail(z)} ELSE {erf_tail(z)} END)"


LAW_SQL = f"""WITH g AS (SELECT c_nationkey, count(*) AS n, avg(c_acctbal) AS mean, stddev_pop(c_acctbal) AS std FROM customer GROUP BY 1),
b AS (SELECT *, unnest(range(22)) AS bin FROM g), z AS (SELECT *, (-1000 + 500.0::DOUBLE * bin - mean) / std AS z0, (-1000 + 500.0::DOUBLE * (bin + 1) - mean) / std AS z1 FROM b WHERE std > 0),
m AS (SELECT c_nationkey, bin, {cdf('z1')} - {cdf('z0')} AS mass FROM z), h AS (SELECT c_nationkey, least(CAST(floor((c_acctbal + 1000) / 500) AS INTEGER), 21) AS bin, count(*) AS c FROM customer WHERE c_acctbal BETWEEN -1000 AND 10000 GROUP BY 1, 2),
p AS (SELECT m.c_nationkey, mass / sum(mass) OVER (PARTITION BY m.c_nationkey) AS p, coalesce(c, 0) / sum(coalesce(c, 0)) OVER (PARTITION BY m.c_nationkey) AS q FROM m LEFT JOIN h ON m.c_nationkey = h.c_nationkey AND m.bin = h.bin),
s AS (SELECT *, (p + 1e-10) / sum(p + 1e-10) OVER (PARTITION BY c_nationkey) AS a, (q + 1e-10) / sum(q + 1e-10) OVER (PARTITION BY c_nationkey) AS b FROM p),
d AS (SELECT c_nationkey, sum(a * ln(a / b)) AS kl, sum(a * ln(2 * a / (a + b)) + b * ln(2 * b / (a + b))) / 2 AS js, max(abs(p - q)) AS max_error, avg(abs(p - q)) AS mean_error FROM s GROUP BY 1)
SELECT c_nationkey, n, round(mean, 4) AS mean, round(std, 4) AS std, round(kl, 6) AS kl, round(js, 6) AS js, round(max_error, 6) AS max_error, round(mean_error, 6) AS mean_error, std * std < 9000000 AS collapsed FROM g LEFT JOIN d USING (c_nationkey)"""


@query(LAW_SQL)
def law_by_nation(spark, sf_dir):
    got = divergence.against_normal(table(spark, sf_dir, "customer"), "c_acctbal", ["c_nationkey"], -1000, 10000, 22, least_variance=9_000_000)
    return got.select("c_nationkey", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std")], *[r6(c).alias(c) for c in ("kl", "js", "max_error", "mean_error")], "collapsed")


# ---- cues, ages, paths ---------------------------------------------------------------------------


@query(rf"""WITH {catalogue_rules.TRAITS_SQL}
SELECT c_custkey, CASE WHEN c >= 65 THEN 'planifică cu săptămâni/luni în avans, liste și reminder-e' WHEN c >= 45 THEN 'planifică câteva zile înainte, dar adaptabil' ELSE 'decide spontan, preferă flexibilitate' END AS planning_horizon,
CASE WHEN c >= 65 THEN 'rutină strictă, aceleași ore pentru masă/somn' WHEN c >= 45 THEN 'rutină generală cu excepții ocazionale' ELSE 'fără rutină fixă, variază de la zi la zi' END AS routine_tolerance,
CASE WHEN e >= 65 THEN 'contactează primul, propune ieșiri, inițiază conversații' WHEN e >= 45 THEN 'răspunde invitațiilor, mai rar inițiază' ELSE 'așteaptă să fie invitat, preferă să fie abordat' END AS social_initiation,
CASE WHEN a >= 65 AND n <= 50 THEN 'caută compromis, evită confruntarea directă' WHEN a <= 40 AND e >= 60 THEN 'spune direct ce gândește, fără ocolișuri' WHEN n >= 60 THEN 'retrage-se din conflict, ruminează după' ELSE 'negociază pragmatic, dă și ia' END AS conflict_style,
CASE WHEN o + e - c >= 80 THEN 'încearcă constant lucruri noi, se plictisește rapid de rutină' WHEN o + e - c >= 40 THEN 'deschis la noutate, dar cu măsură' WHEN o + e - c >= 0 THEN 'echilibrat între vechi și nou' ELSE 'preferă ce-i familiar, schimbare doar când e necesar' END AS novelty_budget,
array_to_string(list_concat(CASE WHEN n >= 60 THEN ['insomnie ocazională', 'ruminație', 'întreabă pe alții dacă totul e ok'] WHEN n >= 40 THEN ['se plânge de oboseală', 'caută activități relaxante'] ELSE ['păstrează calm aparent', 'rezolvă pas cu pas'] END, CASE WHEN c >= 60 AND n >= 50 THEN ['micromanagement când e stresat'] ELSE [] END)[1:3], '|') AS stress_signals,
CASE WHEN c >= 60 THEN 'cântărește pro/contra' ELSE 'decide intuitiv' END || '|' || CASE WHEN o >= 60 THEN 'întreabă părerea altora' ELSE 'se bazează pe experiență proprie' END AS decision_cues,
CASE WHEN e >= 70 THEN 'câștigă energie din interacțiuni, petrece mult timp cu alții' WHEN e >= 50 THEN 'echilibrat, socializează dar are nevoie și de timp singur' WHEN e >= 30 THEN 'socializare în doze mici, apoi are nevoie de liniște' ELSE 'interacțiunile sociale îl/o obosesc, preferă solitudinea' END AS social_energy FROM t""")
def conduct_cues(spark, sf_dir):
    got = table(spark, sf_dir, "customer").select("c_custkey", scalar.cues(catalogue_rules.traits()).alias("c")).select("c_custkey", "c.*")
    return got.withColumns({k: F.array_join(k, "|") for k in ("stress_signals", "decision_cues")})


@query("""WITH a AS (SELECT CAST(p_size * 2 AS INTEGER) AS age, count(*) AS c FROM part GROUP BY 1), g AS (SELECT CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS category, sum(c) AS n FROM a WHERE age >= 18 GROUP BY 1)
SELECT category, CAST(n AS BIGINT) AS n, round(n / sum(n) OVER (), 6) AS p FROM g""")
def adult_ages(spark, sf_dir):
    ages = table(spark, sf_dir, "part").groupBy((F.col("p_size") * 2).cast("int").alias("age")).agg(F.count(F.lit(1)).alias("count"))
    return profile.adult_shares(ages).select("category", long("n").alias("n"), r6("p").alias("p"))
