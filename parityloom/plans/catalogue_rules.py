"""More of the catalogue: scores, places, texts, targets, checks and exports, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import math, nested, scalar, text
from ..operators import divergence, profile, rules, sampling, targets
from ..sources import writers
from . import quality
from .catalogue import EVEN, PRIORITY_SQL, SEGMENTS, WORDS_SQL, counted, long, query, r6, table

# ---- trait scores made from keys ------------------------------------------------------------------

STEPS = dict(zip(scalar.TRAITS, (37, 53, 71, 89, 97), strict=True))
TRAITS_SQL = "t AS (SELECT c_custkey, " + ", ".join(f"CAST((c_custkey * {p} + {p}) % 101 AS INTEGER) AS {k[0]}" for k, p in STEPS.items()) + " FROM customer)"


def traits():
    return {k: ((F.col("c_custkey") * p + p) % 101).cast("int") for k, p in STEPS.items()}


@query(f"""WITH {TRAITS_SQL} SELECT c_custkey,
CASE WHEN o - n > 20 THEN 'high' WHEN o - n > 0 THEN 'moderate' WHEN o - n > -20 THEN 'low' ELSE 'very_low' END AS risk_tolerance,
CASE WHEN c > 65 AND o < 45 THEN 'deliberative' WHEN o > 65 AND c < 50 THEN 'intuitive' WHEN c > 65 AND o > 65 THEN 'balanced' WHEN e > 65 THEN 'consultative' ELSE 'pragmatic' END AS decision_style,
CASE WHEN a > 65 AND n < 45 THEN 'accommodating' WHEN a < 40 AND e > 60 THEN 'competing' WHEN o > 60 AND a > 50 THEN 'collaborating' WHEN n > 60 THEN 'avoiding' ELSE 'compromising' END AS conflict_style,
CASE WHEN e > 70 THEN 'gregarious' WHEN e > 50 THEN 'outgoing' WHEN e > 30 THEN 'selective' ELSE 'reserved' END AS social_pattern,
CASE WHEN o + e - c > 80 THEN 'explorer' WHEN o + e - c > 40 THEN 'curious' WHEN o + e - c > 0 THEN 'balanced' ELSE 'traditional' END AS novelty_seeking,
round(least(0.6::DOUBLE, greatest(0.02::DOUBLE, 0.05 + 0.35 * (1 - a / 100) + 0.1 * e / 100)), 6) AS will_say_no_probability,
CASE WHEN n > 65 AND a < 45 THEN 'high' WHEN n > 55 OR a < 40 THEN 'moderate' WHEN a > 65 THEN 'low' ELSE 'rare' END AS complaint_likelihood,
CASE WHEN c > 70 THEN 'long_term' WHEN c > 55 THEN 'medium_term' WHEN o > 70 THEN 'visionary' ELSE 'short_term' END AS planning_horizon FROM t""")
def behaviour_contract(spark, sf_dir):
    b = table(spark, sf_dir, "customer").select("c_custkey", scalar.behaviour(traits()).alias("b")).select("c_custkey", "b.*")
    return b.withColumn("will_say_no_probability", r6("will_say_no_probability"))


@query(f"""WITH {TRAITS_SQL}, s AS (SELECT c_custkey, CAST(least(100, greatest(0, round_even(50 + 10 * (o - 50) / 15, 0))) AS INTEGER) AS t_score, o FROM t)
SELECT c_custkey, t_score, CASE WHEN t_score >= 60 THEN 'high' WHEN t_score >= 40 THEN 'average' ELSE 'low' END AS label, o AS score_0_100 FROM s""")
def trait_t_scores(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", scalar.trait_struct(traits()["openness"]).alias("t")).select("c_custkey", "t.*")


@query(f"""WITH {TRAITS_SQL}, j AS (SELECT *, CAST(18 + c_custkey % 67 AS INTEGER) AS age, c_custkey % 2 = 0 AS woman, c_custkey % 3 AS job, c_custkey % 5 = 0 AS higher FROM t)
SELECT c_custkey, CAST(least(100, greatest(0, o + CASE WHEN higher THEN 8 ELSE 0 END)) AS INTEGER) AS openness,
CAST(least(100, greatest(0, c + CAST(trunc((age - 30) * 0.5) AS INTEGER) + CASE WHEN higher THEN 5 ELSE 0 END + CASE WHEN job = 1 THEN 5 ELSE 0 END)) AS INTEGER) AS conscientiousness,
CAST(least(100, greatest(0, a + CAST(trunc((age - 30) * 0.2) AS INTEGER) + CASE WHEN woman THEN 3 ELSE 0 END)) AS INTEGER) AS agreeableness,
CAST(least(100, greatest(0, n + CAST(trunc((age - 30) * -0.3) AS INTEGER) + CASE WHEN woman THEN 2 ELSE 0 END + CASE WHEN job = 1 THEN 5 ELSE 0 END)) AS INTEGER) AS neuroticism FROM j""")
def trait_adjustment(spark, sf_dir):
    key = F.col("c_custkey")
    sex = F.when(key % 2 == 0, "Feminin").otherwise("Masculin")
    education = F.when(key % 5 == 0, "Superior (Licență/Master)").otherwise("none")
    job = F.when(key % 3 == 1, "Pompier").otherwise("other")
    got = scalar.adjusted_traits(traits(), (18 + key % 67).cast("int"), sex, education, job)
    return table(spark, sf_dir, "customer").select("c_custkey", *[got[k].alias(k) for k in scalar.TRAITS if k != "extraversion"])


@query(f"""WITH {TRAITS_SQL} SELECT c_custkey, array_to_string(list_filter([CASE WHEN o >= 70 THEN 'openness' END, CASE WHEN c >= 70 THEN 'conscientiousness' END, CASE WHEN e >= 70 THEN 'extraversion' END, CASE WHEN a >= 70 THEN 'agreeableness' END, CASE WHEN n >= 70 THEN 'neuroticism' END], lambda x: x IS NOT NULL), ',') AS high,
abs(o - c) <= 25 AND abs(e - a) <= 25 AS close, CAST(greatest(abs(o - c), abs(e - a), abs(n - o)) AS INTEGER) AS deviation FROM t""")
def trait_extremes(spark, sf_dir):
    t = traits()
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.array_join(scalar.traits_beyond(t, 70, True), ",").alias("high"),
        scalar.within(F.array(t["openness"], t["extraversion"]), F.array(t["conscientiousness"], t["agreeableness"]), 25).alias("close"),
        text.deviation([t["openness"], t["extraversion"], t["neuroticism"]], [t["conscientiousness"], t["agreeableness"], t["openness"]]).alias("deviation"),
    )


@query(f"""WITH {TRAITS_SQL} SELECT c_custkey, array_to_string(list_filter([CASE WHEN o >= 70 THEN 'high openness' WHEN o <= 30 THEN 'low openness' END, CASE WHEN c >= 70 THEN 'high conscientiousness' WHEN c <= 30 THEN 'low conscientiousness' END, CASE WHEN e >= 70 THEN 'high extraversion' WHEN e <= 30 THEN 'low extraversion' END, CASE WHEN a >= 70 THEN 'high agreeableness' WHEN a <= 30 THEN 'low agreeableness' END, CASE WHEN n >= 70 THEN 'high neuroticism' WHEN n <= 30 THEN 'low neuroticism' END], lambda x: x IS NOT NULL), ', ') AS summary FROM t""")
def trait_summaries(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", scalar.trait_summary(traits()).alias("summary"))


@query("""SELECT p_partkey, CASE p_size % 8 WHEN 1 THEN 6 WHEN 2 THEN 10 WHEN 3 THEN 14 WHEN 4 THEN 14 WHEN 5 THEN 18 WHEN 6 THEN 25 END AS least, CASE WHEN p_size * 2 < 18 THEN NULL ELSE 1 END AS adult FROM part""")
def education_ages(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ("none", "Primar", "Gimnazial", "Liceal", "Profesional/Tehnic", "Superior (Licență/Master)", "Doctorat", "other")])
    return table(spark, sf_dir, "part").select("p_partkey", scalar.least_age(F.get(names, F.col("p_size") % 8)).alias("least"), F.when(F.col("p_size") * 2 >= 18, 1).alias("adult"))


@query("SELECT c_custkey, sha256('{\"c_mktsegment\":\"' || c_mktsegment || '\",\"c_nationkey\":' || c_nationkey || '}') AS signature FROM customer")
def row_signatures(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", scalar.row_signature("c_nationkey", "c_mktsegment").alias("signature"))


# ---- places and texts ----------------------------------------------------------------------------

PLACE_SQL = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({}), '\b(municipiul|municipiu)\b', 'mun', 'g'), '\bmun\.\s*', 'mun ', 'g'), '[.,]', '', 'g'), '\s+', ' ', 'g'))"


@query(f"""WITH p AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Municipiul ' WHEN 1 THEN 'mun.' WHEN 2 THEN 'MUNICIPIU  ' ELSE 'Submunicipiul, ' END || c_mktsegment AS place FROM customer) SELECT c_custkey, {PLACE_SQL.format('place')} AS place FROM p""")
def place_names(spark, sf_dir):
    key = F.col("c_custkey") % 4
    place = F.concat(F.when(key == 0, "Municipiul ").when(key == 1, "mun.").when(key == 2, "MUNICIPIU  ").otherwise("Submunicipiul, "), F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.normalise_place(place).alias("place"))


@query("""SELECT c_custkey, c_custkey % 5 IN (0, 1, 2) AS total FROM customer""")
def total_labels(spark, sf_dir):
    key = F.col("c_custkey") % 5
    label = F.when(key == 0, "Total pe țară").when(key == 1, "  Populația totală: urban").when(key == 2, "the Whole Country").when(key == 3, "Ambele sexe").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.is_total(label).alias("total"))


@query(r"""SELECT doc_id, regexp_matches(text, '[A-Z][a-z]+\s+(SRL|SA|Institut|Spital|Școală|Liceul|Universitate)') AS named, length(text) BETWEEN 50 AND 4000 AS length_ok FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Firma Alfa SRL. ' ELSE '' END || coalesce(text, '') AS text FROM documents)""")
def narrative_flags(spark, sf_dir):
    made = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.when(F.col("doc_id") % 3 == 0, "Firma Alfa SRL. ").otherwise(""), F.coalesce("text", F.lit(""))).alias("text"))
    got = made.select("doc_id", text.narrative_checks(F.col("text"), F.lit("Alfa")).alias("c"))
    return got.select("doc_id", F.col("c.personal_data").alias("named"), F.col("c.length_ok").alias("length_ok"))


@query(f"""WITH a AS (SELECT doc_id, {WORDS_SQL} AS w, lower(coalesce(text, '')) AS t FROM documents), m AS (SELECT unnest(['the', 'not', 'but', 'que']) AS m)
SELECT doc_id, round(CAST(list_sum(list_transform(['the', 'not', 'but', 'que'], lambda x: CASE WHEN contains(t, x) THEN 1 ELSE 0 END)) AS DOUBLE) / greatest(len(w) * 0.01, 1.0), 6) AS friction,
array_to_string(list_filter(['the', 'not', 'but', 'que'], lambda x: contains(t, x))[1:2], ',') AS listed FROM a""")
def marker_friction(spark, sf_dir):
    words = ["the", "not", "but", "que"]
    return table(spark, sf_dir, "documents").select("doc_id", r6(text.friction(F.col("text"), words)).alias("friction"), F.array_join(text.listed_keywords(F.col("text"), words, 2), ",").alias("listed"))


@query(r"""SELECT conv_id, turn, regexp_replace(array_to_string(list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda x: x <> '')[1:8], ' '), '^[a-zăâîșț]+\s+', '') AS opening FROM conversations""")
def openings(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.opening_words(F.col("text")).alias("opening"))


@query(r"""WITH o AS (SELECT conv_id, regexp_replace(array_to_string(list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda x: x <> '')[1:8], ' '), '^[a-zăâîșț]+\s+', '') AS opening FROM conversations) SELECT conv_id, opening, count(*) * 2 AS n FROM o WHERE opening <> '' GROUP BY 1, 2""")
def repeated_openings(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "text", F.col("text").alias("again"))
    return quality.repeated_openings(c, "conv_id", ["text", "again"]).select("conv_id", "opening", long("n").alias("n"))


@query("""SELECT doc_id, CAST(len(list_filter(['The', 'QUE', 'zzz'], lambda a: contains(lower(coalesce(text, '')), lower(a)))) AS BIGINT) AS hits FROM documents""")
def anchors_named(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", long(text.anchor_hits(F.col("text"), F.array(*map(F.lit, ["The", "QUE", "zzz"])))).alias("hits"))


@query(r"""SELECT item_id, regexp_replace(text, '^[\s-]+|[\s-]+$', '', 'g') AS intro, regexp_replace('b ' || text, '^[\s-]+|[\s-]+$', '', 'g') AS body FROM benchmark""")
def section_parser(spark, sf_dir):
    made = table(spark, sf_dir, "benchmark").select("item_id", F.concat(F.lit("[INTRO] - "), F.col("text"), F.lit(" [BODY] b "), F.col("text")).alias("t"))
    return made.select("item_id", text.section(F.col("t"), "INTRO", ["INTRO", "BODY"]).alias("intro"), text.section(F.col("t"), "BODY", ["INTRO", "BODY"]).alias("body"))


@query("""SELECT c_custkey, 'Dear ' || c_name || ' of ' || c_mktsegment || '.' AS prompt FROM customer""")
def prompts_filled(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.prompt("Dear {name} of {segment}.", {"name": F.col("c_name"), "segment": F.col("c_mktsegment")}).alias("prompt"))


@query(r"""WITH d AS (SELECT doc_id, substr(lower(coalesce(text, '')), 1, 200) AS sample, lower(coalesce(text, '')) AS low FROM documents), k AS (SELECT doc_id, sample, unnest(list_filter([CASE WHEN regexp_matches(low, 'the|que') THEN 'function' END, CASE WHEN regexp_matches(low, '[0-9]{4}') THEN 'stereotype_year' END], lambda x: x IS NOT NULL)) AS kind FROM d)
SELECT kind, count(*) AS n, min_by(sample, doc_id) AS sample, CASE WHEN contains(kind, 'stereotype') THEN 'critical' ELSE 'warning' END AS severity FROM k GROUP BY 1""")
def sensitive_claims(spark, sf_dir):
    got = quality.sensitive_claims(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), {"function": ["the", "que"], "stereotype_year": ["[0-9]{4}"]})
    return got.select("kind", long("n").alias("n"), "sample", "severity")


# ---- nested --------------------------------------------------------------------------------------


@query("SELECT event_id, props AS whole, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.none'), 'x') AS missing FROM (SELECT event_id, coalesce(props, '{}') AS props FROM events)")
def lenient_fields(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.coalesce("props", F.lit("{}")).alias("whole"))
    noisy = F.concat(F.lit("Here it is: "), F.col("whole"), F.lit(" - done"))
    return e.select("event_id", "whole", F.when(F.get_json_object("whole", "$.k").isNotNull(), nested.lenient_field(noisy, "k")).alias("k"), nested.lenient_field(noisy, "none", "x").alias("missing"))


@query("SELECT c_custkey, '[\"' || c_mktsegment || '\",\"' || c_name || '\"]' AS as_json, c_mktsegment || '|' || c_name AS as_text, CAST(2 AS BIGINT) AS back FROM customer")
def list_texts(spark, sf_dir):
    both = F.array("c_mktsegment", "c_name")
    return table(spark, sf_dir, "customer").select("c_custkey", nested.list_to_json(both).alias("as_json"), nested.list_to_text(both).alias("as_text"), long(F.size(nested.text_to_list(nested.list_to_json(both)))).alias("back"))


@query("SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2")
def nested_leaves(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(long(F.count(F.lit(1))).alias("n"))
    inner = counts.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("m"))
    got = nested.leaves(inner.select(F.create_map("c_nationkey", "m").alias("tree")), "tree")
    return got.select(F.col("outer").alias("c_nationkey"), F.col("inner").alias("c_mktsegment"), F.col("value").alias("n"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN CASE c_custkey % 2 WHEN 0 THEN 0.5 ELSE 0.25 END WHEN 'BUILDING' THEN CASE c_custkey % 2 WHEN 0 THEN 0.75 ELSE 0 END ELSE 0 END::DOUBLE AS p FROM customer")
def nested_lookup(spark, sf_dir):
    pair = lambda d: F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])
    tree = F.create_map(F.lit("AUTOMOBILE"), pair({"0": 0.5, "1": 0.25}), F.lit("BUILDING"), pair({"0": 0.75}))
    return table(spark, sf_dir, "customer").select("c_custkey", nested.lookup(tree, F.col("c_mktsegment"), (F.col("c_custkey") % 2).cast("string")).alias("p"))


@query("SELECT c_custkey, 'name' AS key, c_name AS value FROM customer WHERE length(c_name) < 5 OR length(c_name) > 17 UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer WHERE length(c_mktsegment) > 8")
def bounded_map_fields(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")).alias("m"))
    bounds = spark.createDataFrame([("name", 5, 17), ("segment", 1, 8)], "key string, least int, most int")
    return nested.bounded_fields(c, "m", bounds).select("c_custkey", "key", "value")


# ---- targets, divergences, draws -----------------------------------------------------------------


@query("""WITH c AS (SELECT c_nationkey AS d, c_mktsegment AS x, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY c_nationkey) AS p FROM customer WHERE c_nationkey % 3 = 0 GROUP BY 1, 2),
s AS (SELECT s_nationkey AS d, CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'credit' END AS x, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY s_nationkey) AS p FROM supplier WHERE s_nationkey % 2 = 0 GROUP BY 1, 2)
SELECT d AS dist, x AS category, round(p, 6) AS p, 0 AS priority FROM c UNION ALL SELECT d, x, round(p, 6), 1 FROM s WHERE d NOT IN (SELECT d FROM c)
UNION ALL SELECT n_nationkey, n_name, 1, 2 FROM nation WHERE n_nationkey NOT IN (SELECT d FROM c) AND n_nationkey NOT IN (SELECT d FROM s)""")
def source_priority(spark, sf_dir):
    """A nation's distribution from its customers, else its suppliers, else a built-in one; the first two know some nations only."""
    debt = F.when(F.col("s_acctbal") < 0, "debt").otherwise("credit")
    c = profile.crosstab_shares(table(spark, sf_dir, "customer").where("c_nationkey % 3 = 0"), "c_nationkey", "c_mktsegment").select(F.col("c_nationkey").alias("dist"), F.col("c_mktsegment").alias("category"), F.col("share").alias("p"))
    s = profile.crosstab_shares(table(spark, sf_dir, "supplier").where("s_nationkey % 2 = 0").withColumn("x", debt), "s_nationkey", "x").select(F.col("s_nationkey").alias("dist"), F.col("x").alias("category"), F.col("share").alias("p"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("dist"), F.col("n_name").alias("category"), F.lit(1.0).alias("p"))
    return targets.by_priority([c, s, n]).select("dist", "category", r6("p").alias("p"), "priority")


@query("SELECT c_nationkey AS given, c_mktsegment AS category, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY c_nationkey), 6) AS p FROM customer GROUP BY 1, 2")
def joint_to_conditional(spark, sf_dir):
    cells = profile.joint(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment").withColumn("p", F.col("n").cast("double"))
    return targets.to_conditional(cells, "c_nationkey", "c_mktsegment").select("given", "category", r6("p").alias("p"))


@query("WITH s AS (SELECT o_orderpriority AS category, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM orders GROUP BY 1) SELECT round(sum(p), 6) AS total, abs(sum(p) - 1) <= 0.02 AS valid FROM s")
def shares_valid(spark, sf_dir):
    return targets.valid(counted(table(spark, sf_dir, "orders"), "o_orderpriority")).select(r6("total").alias("total"), "valid")


@query(f"WITH s AS (SELECT o_orderpriority AS category, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM orders GROUP BY 1) SELECT t.category, round(abs(coalesce(s.p, 0) - t.q), 6) AS error FROM {PRIORITY_SQL} LEFT JOIN s USING (category) ORDER BY abs(coalesce(s.p, 0) - t.q) DESC, t.category LIMIT 3")
def worst_strata(spark, sf_dir):
    seen = counted(table(spark, sf_dir, "orders"), "o_orderpriority")
    return divergence.strata_gaps(seen, targets.distribution(spark, EVEN), 3).select("category", r6("error").alias("error"))


STRATA_SQL = """WITH s AS (SELECT c_nationkey, c_mktsegment, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM customer GROUP BY 1, 2), q AS (SELECT n_nationkey AS c_nationkey, m AS c_mktsegment, 0.2 / count(*) OVER (PARTITION BY m) AS q FROM nation, (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS m)),
b AS (SELECT coalesce(p, 0) AS p, coalesce(q, 0) AS q FROM s FULL JOIN q USING (c_nationkey, c_mktsegment)), n AS (SELECT p, q, (p + 1e-10) / sum(p + 1e-10) OVER () AS a, (q + 1e-10) / sum(q + 1e-10) OVER () AS z FROM b)
SELECT round(sum(a * ln(a / z)), 6) AS kl, round(sum(a * ln(a / ((a + z) / 2)) + z * ln(z / ((a + z) / 2))) / 2, 6) AS js, round(max(abs(p - q)), 6) AS max_error, round(avg(abs(p - q)), 6) AS mean_error, count(*) AS cells, sum(a * ln(a / z)) <= 0.1 AND max(abs(p - q)) <= 0.05 AS acceptable FROM n"""


@query(STRATA_SQL)
def strata_divergence(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("c_nationkey"))
    target = nations.select("c_nationkey", F.explode(F.array(*map(F.lit, SEGMENTS))).alias("c_mktsegment"), F.lit(0.2).alias("s"))
    target = profile.with_share(target, ["c_mktsegment"], "s").select("c_nationkey", "c_mktsegment", (F.col("share") * 0.2).alias("p"))
    counts = profile.joint(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")
    got = divergence.strata_divergence(counts, target, ["c_nationkey", "c_mktsegment"])
    return got.select(*[r6(c).alias(c) for c in ("kl", "js", "max_error", "mean_error")], long("cells").alias("cells"), "acceptable")


@query("""WITH n AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) SELECT c_nationkey, round(least(1.0, greatest(0.03 * 0.8, 2 * 1.96 * 0.5 / sqrt(n))), 6) AS strict, round(least(1.0, greatest(0.06 * 1.5, 2 * 1.96 * 0.5 / sqrt(n))), 6) AS estimated FROM n""")
def js_thresholds(spark, sf_dir):
    n = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return n.select("c_nationkey", r6(math.js_threshold(F.col("n"), "HIGH_STAKES", "super")).alias("strict"), r6(math.js_threshold(F.col("n"), "ANALYSIS_ONLY", "", True)).alias("estimated"))


@query("""WITH m AS (SELECT c_mktsegment AS metric, count(*)::DOUBLE / sum(count(*)) OVER () AS value FROM customer GROUP BY 1), d AS (SELECT metric, round(value, 6) AS value, 0.2 AS base, abs(value - 0.2) AS change FROM m)
SELECT metric, value, base, round(change, 6) AS change, CASE WHEN change >= 0.004 THEN 'critical' WHEN change > 0.002 THEN 'warning' ELSE 'ok' END AS level FROM d""")
def baseline_drift(spark, sf_dir):
    seen = counted(table(spark, sf_dir, "customer"), "c_mktsegment").select(F.col("category").alias("metric"), F.col("p").alias("value"))
    base = spark.createDataFrame([(k, 0.2, 0.002) for k in SEGMENTS], "metric string, base double, threshold double")
    return divergence.against_baseline(seen, base).select("metric", r6("value").alias("value"), "base", r6("change").alias("change"), "level")


@query("SELECT c_custkey, ['a', 'b', 'c'][1 + CAST(floor(u * 3) AS INTEGER)] AS item, round(CASE WHEN u < 0.25 THEN sqrt(u * 8 * 2) ELSE 8 - sqrt((1 - u) * 8 * 6) END, 5) AS spread FROM (SELECT c_custkey, ('0x' || substr(md5('42:i:' || c_custkey), 1, 8))::BIGINT / 4294967296.0 AS u FROM customer)")
def uniform_items(spark, sf_dir):
    u = sampling.hash01(42, F.col("c_custkey"), "i")
    return table(spark, sf_dir, "customer").select("c_custkey", sampling.uniform_item(["a", "b", "c"], u).alias("item"), F.round(sampling.triangular(F.lit(0.0), F.lit(8.0), F.lit(2.0), u), 5).alias("spread"))


@query("""WITH w AS (SELECT o_orderkey AS id, CAST(round(o_totalprice * 100) AS BIGINT) AS w, ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 3))::INTEGER AS lane FROM orders), c AS (SELECT *, sum(w) OVER (ORDER BY lane, id ROWS UNBOUNDED PRECEDING) AS upto, sum(w) OVER () AS total FROM w WHERE w > 0),
p AS (SELECT id, CAST(floor((upto - w)::DOUBLE / total::DOUBLE * 1000 + 0.5) AS BIGINT) AS a, CAST(floor(upto::DOUBLE / total::DOUBLE * 1000 + 0.5) AS BIGINT) AS b FROM c) SELECT id AS source_id, b - a AS times FROM p WHERE b > a""")
def pps_resample(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("w"))
    return sampling.resample(o, "o_orderkey", "w", 1000).groupBy("source_id").agg(long(F.count(F.lit(1))).alias("times"))


# ---- checks, summaries, exports ------------------------------------------------------------------


@query("""WITH r AS (SELECT o_orderkey AS id, CAST(o_orderkey % 130 AS INTEGER) AS age, o_custkey % 4 AS e FROM orders)
SELECT id, rule FROM (SELECT id, unnest(list_filter([CASE WHEN age NOT BETWEEN 18 AND 110 THEN 'age_range' END, CASE WHEN e = 1 AND age < 18 THEN 'education_too_early' WHEN e = 2 AND age < 25 THEN 'education_too_early' END, CASE WHEN e IN (1, 2) AND id % 3 <> 0 THEN 'field_of_study_missing' END, CASE WHEN age < 16 AND id % 2 = 0 THEN 'married_too_early' END, CASE WHEN id % 5 = 0 AND e NOT IN (1, 2) THEN 'occupation_needs_study' END, CASE WHEN age < 14 AND id % 5 <> 1 THEN 'works_too_early' END], lambda x: x IS NOT NULL)) AS rule FROM r)""")
def record_rules(spark, sf_dir):
    key = F.col("o_orderkey")
    e = F.col("o_custkey") % 4
    rows = table(spark, sf_dir, "orders").select(
        key.alias("id"), (key % 130).cast("int").alias("age"), F.lit("Feminin").alias("sex"), F.lit("Sud").alias("region"), F.lit("Urban").alias("residence_type"),
        F.when(e == 1, "Superior (Licență/Master)").when(e == 2, "Doctorat").otherwise("Fără studii").alias("education_level"),
        F.when(key % 3 == 0, "Drept").alias("field_of_study"), F.when(key % 2 == 0, "Căsătorit").otherwise("Necăsătorit").alias("marital_status"), F.when(key % 5 == 0, "Inginer șef").when(key % 5 == 1, "Elev").otherwise("x").alias("occupation"),
    ).withColumn("age_group", scalar.age_group(F.col("age")))
    return rules.violations(rows, rules.person_rules(), "id").select("id", "rule")


@query("""SELECT c_nationkey AS row, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS p FROM customer GROUP BY 1""")
def row_marginals(spark, sf_dir):
    cells = profile.joint(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")
    return profile.marginal(cells, "c_nationkey").select(F.col("c_nationkey").alias("row"), long("n").alias("n"), r6("share").alias("p"))


@query("""WITH s AS (SELECT event_type AS source, min(ts) AS oldest FROM events GROUP BY 1 UNION ALL SELECT 'orders', min(o_orderdate) FROM orders) SELECT min(oldest) AS oldest, min_by(source, (oldest, source)) AS source FROM s""")
def oldest_source(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("timestamp_ntz").alias("ts"))
    o = table(spark, sf_dir, "orders").select(F.lit("orders").alias("source"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts"))
    return profile.oldest(e.unionByName(o), "source", "ts")


@query("SELECT c_custkey, days, CASE WHEN days IS NULL THEN 'stale' WHEN days > 60 THEN 'critical' WHEN days > 30 THEN 'stale' WHEN days > 7 THEN 'aging' ELSE 'fresh' END AS class, coalesce(days > 30, true) AS told FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 > 0 THEN CAST(c_custkey % 90 AS INTEGER) END AS days FROM customer)")
def missing_times(spark, sf_dir):
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    ts = F.when(F.col("c_custkey") % 9 > 0, now - F.make_dt_interval(days=(F.col("c_custkey") % 90).cast("int")))
    days = scalar.age_days(ts, now)
    return table(spark, sf_dir, "customer").select("c_custkey", days.alias("days")).select("c_custkey", "days", scalar.freshness(F.col("days")).alias("class"), scalar.stale_for(F.col("days"), "NARRATIVE_REQUIRED").alias("told"))


@query("SELECT c_custkey::VARCHAR AS uuid, c_mktsegment AS occupation, c_nationkey::VARCHAR AS municipality, 'orders' AS source FROM customer")
def public_fields(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("uuid"), F.col("c_mktsegment").alias("occupation"), F.col("c_nationkey").cast("string").alias("district"), F.lit(1).alias("trace_id"), F.lit("x").alias("ethnicity"))
    got = writers.public(c, {"table": "orders"})
    return got.select(*[x for x in got.columns if x != "_source"], F.col("_source.table").alias("source"))


@query("""SELECT c_mktsegment || '_total{segment="' || c_mktsegment || '",text="a\\"b"} ' || count(*) AS line FROM customer GROUP BY c_mktsegment""")
def metrics_lines(spark, sf_dir):
    n = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(long(F.count(F.lit(1))).alias("value"))
    rows = n.select(F.concat("c_mktsegment", F.lit("_total")).alias("name"), "value", F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("text"), F.lit('a"b')).alias("tags"))
    return writers.metrics_text(rows)


@query("SELECT c_mktsegment AS stratum, n, round(std, 6) AS std, std < 100 AS collapsed FROM (SELECT c_mktsegment, count(*) AS n, stddev_pop(c_acctbal) AS std FROM customer GROUP BY 1)")
def variance_collapse(spark, sf_dir):
    got = divergence.collapsed(table(spark, sf_dir, "customer"), "c_acctbal", 100.0, ["c_mktsegment"])
    return got.select(F.col("c_mktsegment").alias("stratum"), long("n").alias("n"), r6("std").alias("std"), "collapsed")


@query("""WITH t AS (SELECT unnest(['AUTOMOBILE', 'BUILDING', 'NOWHERE']) AS category), s AS (SELECT c_mktsegment AS category, count(*) AS n FROM customer GROUP BY 1)
SELECT t.category, s.n IS NOT NULL AS present, coalesce(s.n, 0) AS n FROM t LEFT JOIN s USING (category)""")
def required_categories(spark, sf_dir):
    wanted = spark.createDataFrame([(x,) for x in ("AUTOMOBILE", "BUILDING", "NOWHERE")], "category string")
    return divergence.required(table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("category")).agg(F.count(F.lit(1)).alias("n")), wanted).select("category", "present", long("n").alias("n"))


@query("""WITH d AS (SELECT conv_id, turn, lower(coalesce(text, '')) AS t FROM conversations) SELECT conv_id, turn, (CASE WHEN regexp_matches(t, '\\b(he)\\b') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(t, '\\b(him)\\b') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(t, '\\b(his)\\b') THEN 1 ELSE 0 END) > 2 AS opposite FROM d""")
def pronoun_kinds(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", (text.kinds_found(F.col("text"), ["he", "him", "his"]) > 2).alias("opposite"))
