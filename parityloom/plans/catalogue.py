"""The catalogue: each query over the driver's tables, with the SQL that says the same.

Doubles are rounded to six places on both sides, and counts cast to long.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nested, scalar, text
from ..functions.math import adaptive_tolerance
from ..operators import divergence, duplicates, joins, profile, raking, rules, sampling, targets
from ..operators.common import saved, shared_folder, small
from ..sources import readers, writers
from ..streaming import streams
from . import people, quality, report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def counted(df: DataFrame, *keys: str) -> DataFrame:
    """(category, n, p) of a column, its nulls left out."""
    return profile.shares(df, F.col(keys[0])).withColumnRenamed("value", "category").withColumnRenamed("share", "p")


EVEN = {p: 0.2 for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")}
SEGMENTS = {"AUTOMOBILE": 0.25, "BUILDING": 0.15, "FURNITURE": 0.2, "HOUSEHOLD": 0.2, "MACHINERY": 0.2}
PRIORITY_SQL = "(VALUES ('1-URGENT',0.2),('2-HIGH',0.2),('3-MEDIUM',0.2),('4-NOT SPECIFIED',0.2),('5-LOW',0.2)) t(category,q)"
SEGMENT_SQL = "(VALUES ('AUTOMOBILE',0.25),('BUILDING',0.15),('FURNITURE',0.2),('HOUSEHOLD',0.2),('MACHINERY',0.2)) t(category,q)"
WORDS_SQL = r"regexp_extract_all(lower(coalesce(text,'')), '[\p{L}\p{M}\p{N}_]+')"


# ---- distributions -------------------------------------------------------------------------------


@query("SELECT c_mktsegment AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM customer GROUP BY 1")
def scan_profile(spark, sf_dir):
    return profile.shares(table(spark, sf_dir, "customer"), F.col("c_mktsegment")).select("value", long("n").alias("n"), r6("share").alias("share"))


@query("""SELECT field, value, n, round(n / sum(n) OVER (PARTITION BY field), 6) AS share FROM (
SELECT 'l_returnflag' AS field, l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 2
UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2)""")
def multi_field_shares(spark, sf_dir):
    got = profile.field_shares(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])
    return got.select("field", "value", long("n").alias("n"), r6("share").alias("share"))


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def merge_partial_counts(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return profile.merged_counts([daily.select("value", "n")]).select("value", long("n").alias("n"))


@query("SELECT l_returnflag AS value, round(sum(l_quantity), 2) AS n, round(sum(l_quantity) / sum(sum(l_quantity)) OVER (), 6) AS share FROM lineitem GROUP BY 1")
def weighted_shares(spark, sf_dir):
    got = profile.shares(table(spark, sf_dir, "lineitem"), F.col("l_returnflag"), F.col("l_quantity"))
    return got.select("value", F.round("n", 2).alias("n"), r6("share").alias("share"))


@query("""SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def joint_counts(spark, sf_dir):
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return profile.joint(both, "c_mktsegment", "o_orderpriority").select("c_mktsegment", "o_orderpriority", long("n").alias("n"), r6("share").alias("share"))


@query("""SELECT c_mktsegment, o_orderstatus, o_orderpriority, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def strata_counts(spark, sf_dir):
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return both.groupBy("c_mktsegment", "o_orderstatus", "o_orderpriority").agg(long(F.count(F.lit(1))).alias("n"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag) * 2 + grouping(l_linestatus) AS set_id FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_returnflag, l_linestatus))")
def grouping_sets(spark, sf_dir):
    keys = ["l_returnflag", "l_linestatus"]
    got = profile.grouping_sets(table(spark, sf_dir, "lineitem"), [keys[:1], keys[1:], keys], keys)
    return got.select(*keys, long("n").alias("n"), long("set_id").alias("set_id"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def cube(spark, sf_dir):
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(long(F.count(F.lit(1))).alias("n"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("double").alias("total"))


ORACLE["cube"] = "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)"


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(long(F.count(F.lit(1))).alias("n"))


@query("""SELECT n_name, c_mktsegment, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY n_name), 6) AS share
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def row_normalised_crosstab(spark, sf_dir):
    both = table(spark, sf_dir, "customer").join(small(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return profile.crosstab_shares(both, "n_name", "c_mktsegment").select("n_name", "c_mktsegment", long("n").alias("n"), r6("share").alias("share"))


@query("""SELECT r_name AS category, round(count(*) / sum(count(*)) OVER (), 6) AS p
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def rollup_marginal(spark, sf_dir):
    nations = counted(table(spark, sf_dir, "customer"), "c_nationkey")
    up = table(spark, sf_dir, "nation").join(small(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("category"), F.col("r_name").alias("parent"))
    return targets.rolled_up(nations.select("category", "p"), up, strict=True).select("category", r6("p").alias("p"))


@query("SELECT c_mktsegment AS category, round(count(*) / sum(count(*)) OVER (), 6) AS p FROM customer GROUP BY 1")
def mixture_marginal(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    given = profile.crosstab_shares(c, "c_nationkey", "c_mktsegment").select(F.col("c_nationkey").alias("given"), F.col("c_mktsegment").alias("category"), F.col("share").alias("p"))
    return targets.mixture(counted(c, "c_nationkey"), given).select("category", r6("p").alias("p"))


@query("SELECT o_orderpriority AS category, round(count(*) / sum(count(*)) OVER (), 6) AS p FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1")
def drop_renormalise(spark, sf_dir):
    p = counted(table(spark, sf_dir, "orders"), "o_orderpriority").select("category", "p")
    return targets.without(p, F.col("category") == "4-NOT SPECIFIED").select("category", r6("p").alias("p"))


@query("SELECT CAST(least(floor((value - 0) / 10), 9) AS BIGINT) AS bin, count(*) AS n FROM events WHERE value BETWEEN 0 AND 100 GROUP BY 1")
def bucket_hist(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "events"), scalar.fixed_bin(F.col("value"), 0, 100, 10)).select(long("bin").alias("bin"), long("n").alias("n"))


@query("SELECT CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 25 THEN 'middle' WHEN p_size < 40 THEN 'large' ELSE 'huge' END AS size_class, count(*) AS n FROM part GROUP BY 1")
def bin_labels(spark, sf_dir):
    label = scalar.bucketize(F.col("p_size"), (10, 25, 40), ("small", "middle", "large", "huge"))
    return table(spark, sf_dir, "part").groupBy(label.alias("size_class")).agg(long(F.count(F.lit(1))).alias("n"))


@query("""WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, max(CASE WHEN i = least(n // 2, n - 1) THEN value END) AS p50, max(CASE WHEN i = least(CAST(floor(0.95 * n) AS BIGINT), n - 1) THEN value END) AS p95,
max(CASE WHEN i = least(CAST(floor(0.99 * n) AS BIGINT), n - 1) THEN value END) AS p99 FROM r GROUP BY 1""")
def nearest_rank_percentiles(spark, sf_dir):
    return profile.nearest_rank(table(spark, sf_dir, "events"), "value", (0.5, 0.95, 0.99), ["event_type"])


@query("""SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, min(l_extendedprice) AS low, max(l_extendedprice) AS high, round(stddev_pop(l_extendedprice), 4) AS std FROM lineitem GROUP BY 1""")
def numeric_summary(spark, sf_dir):
    return profile.summary(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"]).select("l_returnflag", long("n").alias("n"), F.round("mean", 4).alias("mean"), "low", "high", F.round("std", 4).alias("std"))


@query(f"""SELECT lang, count(*) AS tokens, count(DISTINCT w) AS types, round(count(DISTINCT w) / count(*), 6) AS ratio
FROM (SELECT lang, unnest({WORDS_SQL}) AS w FROM documents) GROUP BY 1""")
def distinct_and_ttr(spark, sf_dir):
    got = profile.type_token(table(spark, sf_dir, "documents"), text.tokens(F.col("text")), ["lang"])
    return got.select("lang", long("tokens").alias("tokens"), long("types").alias("types"), r6("ratio").alias("ratio"))


@query()
def type_token_approx(spark, sf_dir):
    return profile.type_token(table(spark, sf_dir, "documents"), text.tokens(F.col("text")), ["lang"], exact=False)


@query("""SELECT o_orderstatus, count(*) AS n_rows, count(*) FILTER (o_totalprice > 200000) AS n_dear, count(*) FILTER (o_orderpriority = '1-URGENT') AS n_urgent,
count(*) FILTER (o_totalprice > 200000 OR o_orderpriority = '1-URGENT') AS n_any, count(*) FILTER (o_totalprice > 200000 AND o_orderpriority = '1-URGENT') AS n_all FROM orders GROUP BY 1""")
def flag_counts(spark, sf_dir):
    flags = {"dear": F.col("o_totalprice") > 200000, "urgent": F.col("o_orderpriority") == "1-URGENT"}
    got = profile.flag_counts(table(spark, sf_dir, "orders"), flags, ["o_orderstatus"])
    return got.select("o_orderstatus", *[long(c).alias(c) for c in got.columns[1:]])


@query("SELECT count(value) AS n, round(avg(value), 6) AS mean, abs(avg(value) - 50) <= 5 AS stable FROM events")
def mean_drift(spark, sf_dir):
    return profile.mean_drift(table(spark, sf_dir, "events"), "value", 50, 5).select(long("n").alias("n"), r6("mean").alias("mean"), "stable")


# ---- ranking and sets ----------------------------------------------------------------------------


@query("""SELECT c_nationkey, c_mktsegment, n FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS k FROM customer GROUP BY 1, 2) WHERE k = 1""")
def argmax_per_group(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return profile.arg_max(counts, ["c_nationkey"], "n", "c_mktsegment").select("c_nationkey", "c_mktsegment", long("n").alias("n"))


@query("""SELECT p_brand, p_type, n, rank FROM (SELECT p_brand, p_type, count(*) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rank FROM part GROUP BY 1, 2) WHERE rank <= 3""")
def topk_per_group(spark, sf_dir):
    counts = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return profile.top_per_group(counts, ["p_brand"], "n", "p_type", 3).select("p_brand", "p_type", long("n").alias("n"), long("rank").alias("rank"))


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 50")
def top_k(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(long(F.count(F.lit(1))).alias("n")).orderBy(F.desc("n"), "l_partkey").limit(50)


@query("""WITH w AS (SELECT CAST(o_totalprice AS DOUBLE) AS w, row_number() OVER (ORDER BY o_totalprice DESC) AS i, count(*) OVER () AS n FROM orders)
SELECT round(sum(w) FILTER (i <= greatest(1, CAST(floor(0.05 * n) AS BIGINT))) / sum(w), 6) AS top_share FROM w""")
def top5pct_weight_share(spark, sf_dir):
    return divergence.weight_quality(table(spark, sf_dir, "orders"), "o_totalprice").select(r6("top_share").alias("top_share"))


@query("""SELECT count(*) AS n, round(sum(o_totalprice) ^ 2 / sum(o_totalprice ^ 2) / count(*), 6) AS ess_ratio, round(1 - sum(o_totalprice) ^ 2 / sum(o_totalprice ^ 2) / count(*), 6) AS information_loss, round(max(o_totalprice) / avg(o_totalprice), 6) AS concentration FROM orders""")
def ess(spark, sf_dir):
    got = divergence.weight_quality(table(spark, sf_dir, "orders"), "o_totalprice")
    return got.select(long("n").alias("n"), r6("ess_ratio").alias("ess_ratio"), r6("information_loss").alias("information_loss"), r6("concentration").alias("concentration"))


@query("""WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), s AS (SELECT *, n / sum(n) OVER (PARTITION BY p_brand) AS share, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS k FROM c)
SELECT p_brand, p_type, n, round(share, 6) AS share FROM s WHERE k <= 3 AND share > 0.04""")
def dominant_share_gate(spark, sf_dir):
    return profile.dominant_groups(table(spark, sf_dir, "part"), "p_brand", "p_type", 0.04).select("p_brand", "p_type", long("n").alias("n"), r6("share").alias("share"))


@query("SELECT c_custkey, c_mktsegment FROM (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS k FROM customer) WHERE k <= 10")
def stratified_first_k(spark, sf_dir):
    return profile.first_per_stratum(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"], "c_custkey", 10).select("c_custkey", "c_mktsegment")


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
SELECT arg_min(n, day) AS first, arg_max(n, day) AS last, round(arg_max(n, day) / arg_min(n, day), 6) AS ratio, arg_max(n, day) / arg_min(n, day) > 1.5 AS drifts FROM d""")
def first_last_drift(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return profile.first_last(daily, "day", "n").select(long("first").alias("first"), long("last").alias("last"), r6("ratio").alias("ratio"), "drifts")


@query("""WITH d AS (SELECT event_type, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, round(regr_slope(n, day), 6) AS slope, count(*) AS n FROM d GROUP BY 1""")
def trend_slope(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy("event_type", F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return profile.trend(daily, F.col("day"), F.col("n"), ["event_type"]).select("event_type", r6("slope").alias("slope"), long("n").alias("n"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def first_of_key(spark, sf_dir):
    return profile.first_of_key(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT o_custkey AS custkey FROM orders UNION SELECT c_custkey FROM customer")
def set_union(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey")).union(table(spark, sf_dir, "customer").select("c_custkey")).distinct()


@query("SELECT o_custkey AS custkey FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def set_intersect(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey")).intersect(table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey"))


@query("SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders")
def set_except(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey")).subtract(table(spark, sf_dir, "orders").select("o_custkey"))


@query("SELECT l_partkey AS k FROM lineitem EXCEPT ALL SELECT p_partkey FROM part")
def bag_except(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k")).exceptAll(table(spark, sf_dir, "part").select("p_partkey"))


@query("SELECT 'c' AS src, count(*) AS n FROM customer UNION ALL SELECT 's', count(*) FROM supplier")
def bag_union(spark, sf_dir):
    c, s = (table(spark, sf_dir, t).select(F.lit(t[0]).alias("src")) for t in ("customer", "supplier"))
    return c.unionByName(s).groupBy("src").agg(long(F.count(F.lit(1))).alias("n"))


# ---- divergence and tests ------------------------------------------------------------------------


@query(f"""WITH o AS (SELECT o_orderpriority AS category, count(*) / sum(count(*)) OVER () AS p FROM orders GROUP BY 1),
j AS (SELECT coalesce(p, 0) AS p, coalesce(q, 0) AS q, (coalesce(p, 0) + coalesce(q, 0)) / 2 AS m FROM o FULL JOIN {PRIORITY_SQL} USING (category))
SELECT round(sum(abs(p - q)), 6) AS l1, round(sum(abs(p - q)) / 2, 6) AS tv, round(max(abs(p - q)), 6) AS max_error,
round(sum(CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / m) ELSE 0 END) / 2, 6) AS js FROM j""")
def marginal_drift(spark, sf_dir):
    observed = counted(table(spark, sf_dir, "orders"), "o_orderpriority")
    got = divergence.distances(divergence.aligned(observed, targets.distribution(spark, EVEN)))
    return got.select(*[r6(c).alias(c) for c in ("l1", "tv", "max_error", "js")])


@query(f"""WITH o AS (SELECT c_mktsegment AS category, count(*) / sum(count(*)) OVER () AS p FROM customer GROUP BY 1),
j AS (SELECT p, q, (p + q) / 2 AS m FROM o JOIN {SEGMENT_SQL} USING (category))
SELECT round(sum(p * log2(p / m) + q * log2(q / m)) / 2, 6) AS js FROM j""")
def js_divergence(spark, sf_dir):
    observed = counted(table(spark, sf_dir, "customer"), "c_mktsegment")
    return divergence.distances(divergence.aligned(observed, targets.distribution(spark, SEGMENTS))).select(r6("js").alias("js"))


@query(f"""WITH o AS (SELECT c_mktsegment AS category, count(*) / sum(count(*)) OVER () AS p FROM customer GROUP BY 1),
j AS (SELECT p + 1e-10 AS p, q + 1e-10 AS q FROM o JOIN {SEGMENT_SQL} USING (category)), k AS (SELECT p / sum(p) OVER () AS p, q / sum(q) OVER () AS q FROM j)
SELECT round(sum(p * ln(p / q)), 6) AS kl, round(sum(p * ln(2 * p / (p + q)) + q * ln(2 * q / (p + q))) / 2, 6) AS js FROM k""")
def kl_smoothed(spark, sf_dir):
    observed = counted(table(spark, sf_dir, "customer"), "c_mktsegment")
    return divergence.smoothed_divergence(divergence.aligned(observed, targets.distribution(spark, SEGMENTS))).select(r6("kl").alias("kl"), r6("js").alias("js"))


@query(f"""WITH o AS (SELECT c_mktsegment AS category, count(*) AS n FROM customer GROUP BY 1), t AS (SELECT sum(n) AS t FROM o),
j AS (SELECT coalesce(n, 0) AS n, q * t AS e FROM {SEGMENT_SQL} LEFT JOIN o USING (category), t)
SELECT round(sum((n - e) ^ 2 / e), 6) AS statistic, count(*) - 1 AS df FROM j WHERE e >= 5""")
def chi_square_gof(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return divergence.chi_square(counts, targets.distribution(spark, SEGMENTS)).select(r6("statistic").alias("statistic"), long("df").alias("df"))


# with four degrees of freedom the tail is exp(-x / 2) (1 + x / 2)
@query(f"""WITH o AS (SELECT c_mktsegment AS category, count(*) AS n FROM customer GROUP BY 1), t AS (SELECT sum(n) AS t FROM o), j AS (SELECT coalesce(n, 0) AS n, q * t AS e FROM {SEGMENT_SQL} LEFT JOIN o USING (category), t),
s AS (SELECT sum((n - e) ^ 2 / e) AS x, count(*) - 1 AS df FROM j WHERE e >= 5) SELECT round(x, 6) AS statistic, df, CASE WHEN df = 4 THEN round(exp(-x / 2) * (1 + x / 2), 6) END AS p_value FROM s""")
def chi_square_p_value(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return divergence.chi_square(counts, targets.distribution(spark, SEGMENTS)).select(r6("statistic").alias("statistic"), long("df").alias("df"), r6("p_value").alias("p_value"))


@query("""WITH j AS (SELECT n_regionkey AS a, c_mktsegment AS b, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), t AS (SELECT sum(n) AS t FROM j),
a AS (SELECT a, sum(n) AS na FROM j GROUP BY 1), b AS (SELECT b, sum(n) AS nb FROM j GROUP BY 1),
c AS (SELECT coalesce(n, 0) AS n, na * nb / t AS e FROM a CROSS JOIN b CROSS JOIN t LEFT JOIN j USING (a, b))
SELECT round(sum((n - e) ^ 2 / e), 6) AS statistic, count(*) - 1 AS df FROM c WHERE e >= 5""")
def chi_square_joint(spark, sf_dir):
    both = table(spark, sf_dir, "customer").join(small(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    cells = targets.independent(counted(both, "n_regionkey"), counted(both, "c_mktsegment"))
    return divergence.joint_chi_square(both, "n_regionkey", "c_mktsegment", cells).select(r6("statistic").alias("statistic"), long("df").alias("df"))


@query("""WITH c AS (SELECT count(*) AS n FROM customer GROUP BY c_nationkey), p AS (SELECT n / sum(n) OVER () AS p FROM c)
SELECT round(-sum(p * log2(p)), 6) AS entropy, count(*) AS categories FROM p""")
def entropy(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return divergence.entropy(counts).select(r6("entropy").alias("entropy"), long("categories").alias("categories"))


@query("""WITH j AS (SELECT c_nationkey AS a, c_mktsegment AS b, count(*) AS n FROM customer GROUP BY 1, 2), t AS (SELECT sum(n) AS t FROM j),
m AS (SELECT n / t AS p, sum(n) OVER (PARTITION BY a) / t AS pa, sum(n) OVER (PARTITION BY b) / t AS pb FROM j, t) SELECT round(sum(p * log2(p / (pa * pb))), 6) AS mi FROM m""")
def mutual_information(spark, sf_dir):
    return divergence.mutual_information(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment").select(r6("mi").alias("mi"))


@query(f"""WITH o AS (SELECT c_mktsegment AS category, count(*) / sum(count(*)) OVER () AS p, sum(count(*)) OVER () AS n FROM customer GROUP BY 1)
SELECT category, round(p, 6) AS p, round(q, 6) AS q, round(abs(p - q), 6) AS error, round(1.96 * 0.5 / sqrt(n), 6) AS tolerance, abs(p - q) <= 1.96 * 0.5 / sqrt(n) AS ok FROM o JOIN {SEGMENT_SQL} USING (category)""")
def adaptive_tolerance_gate(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    got = divergence.within_tolerance(counted(c, "c_mktsegment"), targets.distribution(spark, SEGMENTS), c.count())
    return got.select("category", *[r6(x).alias(x) for x in ("p", "q", "error", "tolerance")], "ok")


@query(f"""WITH o AS (SELECT c_mktsegment AS category, count(*) / sum(count(*)) OVER () AS p FROM customer GROUP BY 1)
SELECT category, round(p, 6) AS actual, round(q, 6) AS target, round(abs(p - q), 6) AS error FROM o JOIN {SEGMENT_SQL} USING (category) WHERE abs(p - q) > 0.03""")
def drift_cells(spark, sf_dir):
    got = divergence.drift_cells(counted(table(spark, sf_dir, "customer"), "c_mktsegment"), targets.distribution(spark, SEGMENTS), 0.03)
    return got.select("category", *[r6(x).alias(x) for x in ("actual", "target", "error")])


@query("""WITH a AS (SELECT n_regionkey AS row, count(*) / sum(count(*)) OVER () AS pa FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
b AS (SELECT c_mktsegment AS col, count(*) / sum(count(*)) OVER () AS pb FROM customer GROUP BY 1) SELECT row, col, round(pa * pb, 6) AS p FROM a, b""")
def independence_crosstab(spark, sf_dir):
    both = table(spark, sf_dir, "customer").join(small(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return targets.independent(counted(both, "n_regionkey"), counted(both, "c_mktsegment")).select("row", "col", r6("p").alias("p"))


TRUST_SQL = f"""WITH t AS (SELECT 'o_orderpriority' AS field, category, q::DOUBLE AS q FROM {PRIORITY_SQL} UNION ALL SELECT 'o_orderstatus', s, p::DOUBLE FROM (VALUES ('F', 0.49), ('O', 0.49), ('P', 0.02)) v(s, p)),
c AS (SELECT 'o_orderpriority' AS field, o_orderpriority AS category, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY 2), s AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY field) AS p FROM c),
b AS (SELECT field, coalesce(p, 0) AS p, coalesce(q, 0) AS q, coalesce(n, 0) AS n, (SELECT count(*) FROM orders) AS total FROM s FULL JOIN t USING (field, category))
SELECT field, max(total) AS n, round(sum(abs(p - q)), 6) AS l1, round(sum(abs(p - q)) / 2, 6) AS tv, round(max(abs(p - q)), 6) AS max_error, round(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 6) AS js,
round(sum(CASE WHEN q * total >= 5 THEN (n - q * total) ^ 2 / (q * total) ELSE 0 END), 4) AS statistic, count(*) FILTER (q * total >= 5) - 1 AS df FROM b GROUP BY field"""


@query(TRUST_SQL)
def trust_marginals(spark, sf_dir):
    got = report.marginal_errors(table(spark, sf_dir, "orders"), {"o_orderpriority": EVEN, "o_orderstatus": {"F": 0.49, "O": 0.49, "P": 0.02}})
    return got.select("field", long("n").alias("n"), *[r6(c).alias(c) for c in ("l1", "tv", "max_error", "js")], F.round("statistic", 4).alias("statistic"), long("df").alias("df"))


@query("""WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n, 1.0::DOUBLE AS w FROM lineitem GROUP BY 1, 2),
ta AS (SELECT a, CASE a WHEN 'A' THEN 0.3 WHEN 'N' THEN 0.4 ELSE 0.3 END AS t FROM (SELECT DISTINCT a FROM c)), tb AS (SELECT b, 0.5 AS t FROM (SELECT DISTINCT b FROM c)),
w1 AS (SELECT a, b, n, least(5, greatest(0.2, w * ta.t / (sum(n * w) OVER (PARTITION BY a) / sum(n * w) OVER ()))) AS w FROM c JOIN ta USING (a)),
w2 AS (SELECT a, b, n, least(5, greatest(0.2, w * tb.t / (sum(n * w) OVER (PARTITION BY b) / sum(n * w) OVER ()))) AS w FROM w1 JOIN tb USING (b)),
w3 AS (SELECT a, b, n, least(5, greatest(0.2, w * ta.t / (sum(n * w) OVER (PARTITION BY a) / sum(n * w) OVER ()))) AS w FROM w2 JOIN ta USING (a)),
w4 AS (SELECT a, b, n, least(5, greatest(0.2, w * tb.t / (sum(n * w) OVER (PARTITION BY b) / sum(n * w) OVER ()))) AS w FROM w3 JOIN tb USING (b))
SELECT a AS l_returnflag, b AS l_linestatus, n, round(w, 6) AS weight FROM w4""")
def rake_two_way(spark, sf_dir):
    goal = {"l_returnflag": {"A": 0.3, "N": 0.4, "R": 0.3}, "l_linestatus": {"F": 0.5, "O": 0.5}}
    got = raking.rake(table(spark, sf_dir, "lineitem"), goal, rounds=2, tolerance=0.0)
    return got.rows.groupBy("l_returnflag", "l_linestatus").agg(long(F.count(F.lit(1))).alias("n"), r6(F.min("weight")).alias("weight"))


# ---- rules ---------------------------------------------------------------------------------------


def order_rules() -> list[rules.Rule]:
    return [
        rules.domain("o_orderstatus", ["F", "O"]),
        rules.between("o_totalprice", 1000, 300000, "warning"),
        rules.matches("o_orderpriority", "^[1-4]-"),
    ]


@query("""SELECT o_orderkey, 'o_orderstatus_domain' AS rule, 'error' AS severity FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT o_orderkey, 'o_totalprice_range', 'warning' FROM orders WHERE NOT o_totalprice BETWEEN 1000 AND 300000
UNION ALL SELECT o_orderkey, 'o_orderpriority_pattern', 'error' FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-4]-')""")
def rule_violations(spark, sf_dir):
    return rules.violations(table(spark, sf_dir, "orders"), order_rules(), "o_orderkey").select("o_orderkey", "rule", "severity")


@query("""WITH v AS (SELECT (o_orderstatus NOT IN ('F', 'O'))::INT + (NOT regexp_matches(o_orderpriority, '^[1-4]-'))::INT AS e, (NOT o_totalprice BETWEEN 1000 AND 300000)::INT AS w FROM orders)
SELECT count(*) AS n_rows, count(*) FILTER (e = 0) AS valid, count(*) FILTER (e > 0) AS invalid, sum(e)::BIGINT AS errors, sum(w)::BIGINT AS warnings FROM v""")
def violation_summary(spark, sf_dir):
    got = rules.summary(table(spark, sf_dir, "orders"), order_rules())
    return got.select(*[long(c).alias(c) for c in got.columns])


@query("SELECT s_nationkey AS nationkey, count(*) AS n FROM supplier GROUP BY 1 HAVING count(*) > 3")
def repeated_keys(spark, sf_dir):
    return rules.repeated_keys(table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nationkey"), "nationkey").where("n > 3").select("nationkey", long("n").alias("n"))


@query("""SELECT n_regionkey, c_mktsegment, n FROM (SELECT n_regionkey, c_mktsegment, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1, 2) WHERE n < CASE c_mktsegment WHEN 'BUILDING' THEN 60 ELSE 70 END""")
def coverage_gaps(spark, sf_dir):
    both = table(spark, sf_dir, "customer").join(small(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return rules.coverage(both, "n_regionkey", "c_mktsegment", {"BUILDING": 60, "MACHINERY": 70}).where("n > 0").select("n_regionkey", "c_mktsegment", long("n").alias("n"))


# ---- joins ---------------------------------------------------------------------------------------


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def dimension_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.lookup(table(spark, sf_dir, "customer"), nation, ["c_nationkey"], strict=True).select("c_custkey", "n_name")


@query("""SELECT c_custkey, coalesce(s.name, n_name) AS label, CASE WHEN s.name IS NULL THEN 1 ELSE 0 END AS fell_back FROM customer
LEFT JOIN (SELECT s_nationkey, min(s_name) AS name FROM supplier WHERE s_suppkey < 30 GROUP BY 1) s ON c_nationkey = s_nationkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_chain(spark, sf_dir):
    first = table(spark, sf_dir, "supplier").where("s_suppkey < 30").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_name").alias("label"))
    then = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("label"))
    return joins.lookup_chain(table(spark, sf_dir, "customer"), [(first, "c_nationkey"), (then, "c_nationkey")], "label").select("c_custkey", "label", "fell_back")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def anti_categories(spark, sf_dir):
    return joins.missing(table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey")), "n_nationkey").select("n_nationkey", "n_name")


@query("SELECT DISTINCT user_id FROM events WHERE event_type NOT IN (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 3)")
def semi_rare(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    common = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type").limit(3)
    return joins.missing(e, common, "event_type").select("user_id").distinct()


@query("""WITH c AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS m FROM supplier GROUP BY 1)
SELECT k AS category, round(coalesce(n, 0) / (SELECT sum(n) FROM c), 6) AS p, round(coalesce(m, 0) / (SELECT sum(m) FROM s), 6) AS q FROM c FULL JOIN s USING (k)""")
def full_outer_align(spark, sf_dir):
    got = divergence.aligned(counted(table(spark, sf_dir, "customer"), "c_nationkey"), counted(table(spark, sf_dir, "supplier"), "s_nationkey"))
    return got.select("category", r6("p").alias("p"), r6("q").alias("q"))


@query("SELECT 'missing' AS side, n_nationkey AS category FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def category_mismatch(spark, sf_dir):
    got = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("category")).distinct()
    return divergence.mismatched(got, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("category"))).select("side", "category")


RANGES = [(0.0, 9.5, "low"), (9.0, 25.0, "middle"), (25.0, 60.0, "high")]


@query("SELECT label, count(*) AS n FROM part JOIN (VALUES (0.0, 9.5, 'low'), (9.0, 25.0, 'middle'), (25.0, 60.0, 'high')) r(low, high, label) ON p_size BETWEEN low AND high GROUP BY 1")
def range_bin_join(spark, sf_dir):
    ranges = spark.createDataFrame(RANGES, "low double, high double, label string")
    return joins.in_ranges(table(spark, sf_dir, "part"), "p_size", ranges, 8.0).groupBy("label").agg(long(F.count(F.lit(1))).alias("n"))


@query("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey AND abs(a.p_retailprice - b.p_retailprice) <= 0.25")
def theta_pairs(spark, sf_dir):
    return joins.close_pairs(table(spark, sf_dir, "part"), "p_partkey", "p_retailprice", 0.25, ["p_brand"])


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'done' ELSE 'more' END AS origin FROM orders")
def resume_merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    done, more = (df.select("o_orderkey", F.lit(x).alias("origin")) for df, x in ((o.where("o_totalprice > 100000"), "done"), (o, "more")))
    return joins.resumed(done, more, "o_orderkey")


# ---- text ----------------------------------------------------------------------------------------


@query(f"SELECT doc_id, CAST(len({WORDS_SQL}) AS BIGINT) AS n FROM documents")
def token_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", long(F.size(text.tokens(F.col("text")))).alias("n"))


@query(f"""WITH w AS (SELECT {WORDS_SQL} AS w FROM documents WHERE length(trim(text)) > 0), g AS (SELECT unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) AS g FROM w WHERE len(w) >= 3), c AS (SELECT count(*) AS c FROM g GROUP BY g)
SELECT count(*) AS grams, count(*) FILTER (c > 1) AS repeated, round(count(*) FILTER (c > 1) / count(*), 6) AS rate FROM c""")
def trigram_repetition(spark, sf_dir):
    got = quality.trigram_repetition(table(spark, sf_dir, "documents"), ["text"])
    return got.select(long("grams").alias("grams"), long("repeated").alias("repeated"), r6("rate").alias("rate"))


@query("""WITH s AS (SELECT trim(unnest(string_split_regex(lower(text), '[.!?]+'))) AS s FROM documents WHERE length(trim(text)) > 0), w AS (SELECT string_split_regex(s, '\\s+')[1] AS w FROM s WHERE s <> ''), c AS (SELECT count(*) AS n FROM w GROUP BY w), p AS (SELECT n, n / sum(n) OVER () AS p FROM c)
SELECT round(-sum(p * log2(p)), 6) AS entropy, round(count(*) / sum(n), 6) AS unique_ratio FROM p""")
def sentence_entropy(spark, sf_dir):
    got = quality.sentence_starters(table(spark, sf_dir, "documents"), ["text"])
    return got.select(r6("entropy").alias("entropy"), r6("unique_ratio").alias("unique_ratio"))


OPENINGS = {"article": "^(the|le|la|el|der|die|das)\\b", "preposition": "^(in|of|de|en|von)", "short": "^\\w{1,4}\\b"}


@query(r"""WITH f AS (SELECT CASE WHEN contains(lower(text), '.') THEN split_part(lower(text), '.', 1) ELSE substr(lower(text), 1, 50) END AS f FROM documents WHERE length(trim(text)) > 0),
c AS (SELECT CASE WHEN regexp_matches(f, '^(the|le|la|el|der|die|das) ') THEN 'article' WHEN regexp_matches(f, '^(in|of|de|en|von)') THEN 'preposition' ELSE 'other' END AS value FROM f)
SELECT value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM c GROUP BY 1""")
def opening_class(spark, sf_dir):
    moves = {"article": "^(the|le|la|el|der|die|das) ", "preposition": "^(in|of|de|en|von)"}
    return quality.opening_moves(table(spark, sf_dir, "documents"), ["text"], moves).select("value", long("n").alias("n"), r6("share").alias("share"))


@query("""SELECT role, CASE WHEN contains(lower(text), 'the') OR contains(lower(text), 'and') THEN 'english' WHEN contains(lower(text), 'que') THEN 'romance' ELSE 'other' END AS class, count(*) AS n FROM conversations GROUP BY 1, 2""")
def keyword_class(spark, sf_dir):
    kinds = {"english": ["the", "and"], "romance": ["que"]}
    return table(spark, sf_dir, "conversations").groupBy("role", text.keyword_class(F.col("text"), kinds).alias("class")).agg(long(F.count(F.lit(1))).alias("n"))


@query(r"""SELECT doc_id, regexp_matches(text, '[0-9]{3}') AS digits, regexp_matches(text, '[\w.+-]+@[\w-]+\.\w+') AS mail, CAST(len(regexp_extract_all(text, '[.!?]')) AS BIGINT) AS stops FROM documents""")
def regex_flags(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", t.rlike("[0-9]{3}").alias("digits"), t.rlike(r"[\w.+-]+@[\w-]+\.\w+").alias("mail"), long(text.count_matches(t, "[.!?]")).alias("stops"))


@query("""SELECT doc_id, array_to_string(list_filter(['license', 'copyright', 'ing the', 'password'], lambda w: contains(lower(text), w)), ',') AS found FROM documents""")
def banned_words(spark, sf_dir):
    words = ["license", "copyright", "ing the", "password"]
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.found_words(F.col("text"), words), ",").alias("found"))


SCORE_WORDS = {"plain": (["the", "and", "of", "to"], ["que", "la", "de"]), "late": (["est", "une", "pour"], ["ist", "die", "ein", "und"])}


@query(f"""WITH w AS (SELECT doc_id, list_distinct({WORDS_SQL}) AS w, len({WORDS_SQL}) AS n FROM documents),
h AS (SELECT *, len(list_intersect(w, ['the','and','of','to'])) AS u1, len(list_intersect(w, ['que','la','de'])) AS d1, len(list_intersect(w, ['est','une','pour'])) AS u2, len(list_intersect(w, ['ist','die','ein','und'])) AS d2 FROM w)
SELECT doc_id, CAST(50 + CASE WHEN u1 + d1 < 2 THEN greatest(-10, least(10, 5 * (u1 - d1))) ELSE greatest(-20, least(20, 5 * (u1 - d1))) END AS INTEGER) AS plain,
CAST(50 + CASE WHEN u2 + d2 < 2 THEN greatest(-10, least(10, 5 * (u2 - d2))) ELSE greatest(-20, least(20, 5 * (u2 - d2))) END AS INTEGER) AS late,
round(CASE WHEN n = 0 THEN 0 ELSE least(1, (u1 + d1 + u2 + d2) / greatest(1, n * 0.1)) END, 6) AS confidence FROM h""")
def keyword_score(spark, sf_dir):
    got = table(spark, sf_dir, "documents").select("doc_id", text.trait_scores(F.col("text"), SCORE_WORDS).alias("s"))
    return got.select("doc_id", "s.plain", "s.late", r6("s.confidence").alias("confidence"))


@query(r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(translate(lower(text), 'ăâîșşțţéèêëàáçíïóôöúùûüñä', 'aaisstteeeeaaciiooouuuuna'), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS norm FROM documents""")
def normalise_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalise(F.col("text")).cast("binary")).alias("norm"))


@query(r"""SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS paragraphs FROM pages""")
def marker_sections(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"), long(text.count_matches(F.col("html"), "<p[ >]")).alias("paragraphs"))


@query("""WITH a AS (SELECT doc_id, text, list_filter(list_transform(['the ', 'que ', 'ing '], lambda w: instr(lower(text), w)), lambda p: p > 0) AS places FROM documents)
SELECT doc_id, array_to_string(list_filter(list_transform(places, lambda p: trim(substr(text, CAST(greatest(1, p - 30) AS BIGINT), CAST(least(p - 1, 30) + 100 AS BIGINT)), ' ')), lambda c: length(c) > 10), '|') AS windows FROM a""")
def context_window(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.context_windows(F.col("text"), ["the ", "que ", "ing "]), "|").alias("windows"))


@query()
def unicode_fold(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(text.nfkd(F.col("text")).cast("binary")).alias("folded"))


# ---- near duplicates -----------------------------------------------------------------------------

SHINGLES_SQL = f"""w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), s AS (SELECT doc_id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) AS s FROM w WHERE len(w) >= 3),
g AS (SELECT doc_id, list_transform(range(0, 20), lambda i: list_min(list_transform(s, lambda x: md5(x || '_' || i)))) AS sig FROM s)"""


@query(f"WITH {SHINGLES_SQL} SELECT doc_id, array_to_string(sig, '') AS sig FROM g")
def minhash_signature(spark, sf_dir):
    return duplicates.signed(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", F.array_join("sig", "").alias("sig"))


SAME_SQL = "len(list_filter(range(1, 21), lambda i: x.sig[i] = y.sig[i]))"


@query(f"WITH {SHINGLES_SQL}, c AS (SELECT min(doc_id) AS id, sig FROM g GROUP BY sig) SELECT x.id AS a, y.id AS b, round({SAME_SQL} / 20, 6) AS similarity FROM c x JOIN c y ON x.id < y.id WHERE {SAME_SQL} > 16")
def near_dup_pairs(spark, sf_dir):
    return duplicates.similar_classes(table(spark, sf_dir, "documents"), "doc_id", "text")[0].withColumn("similarity", r6("similarity"))


@query(f"WITH {SHINGLES_SQL} SELECT x.doc_id, min(y.doc_id) AS class FROM g x JOIN g y ON x.sig = y.sig GROUP BY 1")
def near_dup_classes(spark, sf_dir):
    return duplicates.similar_classes(table(spark, sf_dir, "documents"), "doc_id", "text")[1].select("doc_id", "class")


@query(f"""WITH {SHINGLES_SQL} SELECT x.doc_id AS a, y.doc_id AS b, round(len(list_filter(range(1, 21), lambda i: x.sig[i] = y.sig[i])) / 20, 6) AS similarity FROM g x JOIN g y ON x.doc_id % 10 = 0 AND y.doc_id > x.doc_id AND y.doc_id < x.doc_id + 10""")
def similarity_dist(spark, sf_dir):
    return duplicates.neighbour_similarity(table(spark, sf_dir, "documents"), "doc_id", "text").select("a", "b", r6("similarity").alias("similarity"))


@query()
def text_quality_report(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"), "doc_id", ["text"])


# ---- nested --------------------------------------------------------------------------------------


@query("SELECT a.vec_id, round(sqrt(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ^ 2))), 6) AS distance FROM embeddings a, embeddings b WHERE b.vec_id = 0")
def embedding_distance(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    origin = e.where("vec_id = 0").select(F.col("embedding").alias("o"))
    return e.crossJoin(F.broadcast(origin)).select("vec_id", r6(scalar.distance(F.col("embedding"), F.col("o"))).alias("distance"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT event_id, props IS NOT NULL AND list_has_all(['k'], json_keys(props)) AND json_type(props, '$.k') = 'VARCHAR' AS ok FROM events")
def json_strict(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", nested.strict_object(F.col("props"), ["k"]).isNotNull().alias("ok"))


@query("SELECT label, i AS pos, round(avg(x::DOUBLE), 6) AS mean FROM (SELECT label, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS i FROM embeddings) GROUP BY 1, 2")
def array_ops(spark, sf_dir):
    each = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    return each.groupBy("label", long("pos").alias("pos")).agg(r6(F.avg(F.col("x").cast("double"))).alias("mean"))


@query("SELECT k AS key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY 1")
def explode_map(spark, sf_dir):
    return nested.object_fields(table(spark, sf_dir, "events").select("props"), "props").groupBy("key").agg(long(F.count(F.lit(1))).alias("n"))


@query(f"SELECT doc_id, coalesce(list_zip(w, w[2:])[1][1] || ' ' || list_zip(w, w[2:])[1][2], '') AS pair FROM (SELECT doc_id, {WORDS_SQL} AS w FROM documents) WHERE len(w) > 1")
def zip_arrays(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("w")).where(F.size("w") > 1)
    pairs = joins.zipped(F.col("w"), F.slice("w", 2, 1_000_000_000))
    return d.select("doc_id", F.concat_ws(" ", F.get(pairs, F.lit(0))["x"], F.get(pairs, F.lit(0))["y"]).alias("pair"))


# ---- time ----------------------------------------------------------------------------------------


@query("""WITH a AS (SELECT o_orderkey, CAST(floor(epoch(TIMESTAMP '1998-08-02 00:00:00' - o_orderdate) / 86400) AS INTEGER) AS days FROM orders)
SELECT CASE WHEN days > 60 THEN 'critical' WHEN days > 30 THEN 'stale' WHEN days > 7 THEN 'aging' ELSE 'fresh' END AS class, count(*) AS n, max(days) AS oldest FROM a GROUP BY 1""")
def freshness_class(spark, sf_dir):
    days = scalar.age_days(F.col("o_orderdate").cast("timestamp"), F.lit("1998-08-02 00:00:00").cast("timestamp"))
    return table(spark, sf_dir, "orders").select(days.alias("days")).groupBy(scalar.freshness(F.col("days")).alias("class")).agg(long(F.count(F.lit(1))).alias("n"), F.max("days").alias("oldest"))


@query("SELECT time_bucket(INTERVAL 1 day, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling(spark, sf_dir):
    e = streams.timed(table(spark, sf_dir, "events"), "ts")
    got = streams.tumbling(e, "ts", "1 day", ["event_type"], F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return got.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", long("n").alias("n"), F.round("total", 4).alias("total"))


@query("""SELECT start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 12 hour, ts), time_bucket(INTERVAL 12 hour, ts) - INTERVAL 12 hour]) AS start FROM events) GROUP BY 1""")
def sliding(spark, sf_dir):
    got = streams.sliding(streams.timed(table(spark, sf_dir, "events"), "ts"), "ts", "24 hours", "12 hours", [], F.count(F.lit(1)).alias("n"))
    return got.select(F.col("start").cast("timestamp_ntz").alias("start"), long("n").alias("n"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 minute THEN 0 ELSE 1 END AS s FROM events), k AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM k GROUP BY user_id, k""")
def session(spark, sf_dir):
    got = streams.sessions(streams.timed(table(spark, sf_dir, "events"), "ts"), "ts", "30 minutes", ["user_id"], F.count(F.lit(1)).alias("n"))
    return got.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), long("n").alias("n"))


@query("SELECT time_bucket(INTERVAL 1 day, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_tumbling_available_now(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    got = streams.tumbling(streams.timed(source, "ts"), "ts", "1 day", ["event_type"], F.count(F.lit(1)).alias("n"))
    out = streams.run_all(got, "daily_" + uuid.uuid4().hex[:8], checkpoint=f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", long("n").alias("n"))


# ---- draws ---------------------------------------------------------------------------------------

U_SQL = "(('0x' || substr(md5('42:{step}:' || c_custkey), 1, 8))::BIGINT / 4294967296.0)"


@query(f"SELECT c_custkey, round({U_SQL.format(step='u')}, 6) AS u FROM customer")
def hash_uniform(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", r6(sampling.hash01(42, F.col("c_custkey"), "u")).alias("u"))


@query(f"SELECT c_custkey, CASE WHEN u < 0.2 THEN 'a' WHEN u < 0.7 THEN 'b' ELSE 'c' END AS drawn FROM (SELECT c_custkey, {U_SQL.format(step='d')} AS u FROM customer)")
def categorical_draw(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", sampling.draw({"a": 2, "b": 5, "c": 3}, sampling.hash01(42, F.col("c_custkey"), "d")).alias("drawn"))


GIVEN = {"AUTOMOBILE": {"x": 0.5, "y": 0.5}, "BUILDING": {"x": 0.25, "y": 0.75}}
GIVEN_SQL = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0.5 WHEN 'BUILDING' THEN 0.25 ELSE {other} END"


@query(f"SELECT c_custkey, CASE WHEN u < {GIVEN_SQL.format(other=0)} THEN 'x' ELSE 'y' END AS drawn FROM (SELECT *, {U_SQL.format(step='c')} AS u FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING'))")
def conditional_draw(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin(*GIVEN))
    return sampling.draw_given(c, "c_mktsegment", targets.conditional(spark, GIVEN), sampling.hash01(42, F.col("c_custkey"), "c"), "drawn").select("c_custkey", "drawn")


@query(f"SELECT c_custkey, CASE WHEN u < {GIVEN_SQL.format(other=0.125)} THEN 'x' ELSE 'y' END AS drawn, c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING') AS fell_back FROM (SELECT *, {U_SQL.format(step='f')} AS u FROM customer)")
def fallback_draw(spark, sf_dir):
    national = targets.distribution(spark, {"x": 0.125, "y": 0.875})
    got = sampling.draw_given(table(spark, sf_dir, "customer"), "c_mktsegment", targets.conditional(spark, GIVEN), sampling.hash01(42, F.col("c_custkey"), "f"), "drawn", national)
    return got.select("c_custkey", "drawn", "fell_back")


@query()
def population(spark, sf_dir):
    return people.population(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))


@query("""SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0) AS valid, count(*) FILTER (o_orderkey % 7 = 0) + count(*) FILTER (o_orderkey % 11 = 0) AS errors FROM orders""")
def population_rules(spark, sf_dir):
    """Drawn records break no rule; some are given an age too low, some a sex that is none."""
    rows = people.population(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))
    young = F.col("id") % 7 == 0
    fixed = {"age": 17, "education_level": "Primar", "marital_status": "Necăsătorit", "occupation": ""}
    rows = rows.withColumns({k: F.when(young, F.lit(v)).otherwise(F.col(k)) for k, v in fixed.items()})
    rows = rows.withColumn("age_group", F.when(young, scalar.age_group(F.col("age"))).otherwise(F.col("age_group"))).withColumn("sex", F.when(F.col("id") % 11 == 0, "none").otherwise(F.col("sex")))
    return rules.summary(rows, rules.person_rules()).select(long("n_rows").alias("n_rows"), long("valid").alias("valid"), long("errors").alias("errors"))


@query()
def corrected_population(spark, sf_dir):
    return people.corrected(spark, table(spark, sf_dir, "orders").count())[0]


# ---- sinks ---------------------------------------------------------------------------------------


def agreed(rows: DataFrame, copies: list[DataFrame]) -> DataFrame:
    """rows, if each of the copies holds just these; a row of which any holds more or fewer comes once too often."""
    every = rows.withColumn("copy_", F.lit(0))
    for i, copy in enumerate(copies, 1):
        every = every.unionByName(copy.withColumn("copy_", F.lit(i)))
    numbers = [F.count_if(F.col("copy_") == i) for i in range(len(copies) + 1)]
    counted = every.groupBy(rows.columns).agg(numbers[0].alias("n_"), F.array_max(F.array(*numbers)).alias("most_"), F.array_min(F.array(*numbers)).alias("least_"))
    times = F.when(F.col("most_") == F.col("least_"), F.col("n_")).otherwise(F.col("n_") + 1)
    return counted.select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("time_")).drop("time_")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    folder = f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"
    paths = writers.write_all(c, folder, "customer", ["csv", "jsonl", "json", "parquet"])
    return agreed(c, [readers.read(spark, p, c.schema) for p in paths.values()])


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name AS name, '' AS missing FROM customer")
def schema_projection(spark, sf_dir):
    return writers.ordered(table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "missing"], {"c_name": "name"})


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def partitioned_sink(spark, sf_dir):
    path = f"{shared_folder(spark)}/by-priority-{uuid.uuid4().hex}"
    writers.write(table(spark, sf_dir, "orders"), path, "parquet", partition_by=["o_orderpriority"])
    return spark.read.parquet(path).groupBy("o_orderpriority").agg(long(F.count(F.lit(1))).alias("n"))
