"""Known answers, edges and round trips of the library."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parityloom.functions import math as m
from parityloom.functions import nested, scalar, text
from parityloom.operators import divergence, duplicates, joins, profile, raking, rules, sampling, targets
from parityloom.plans import gates, people
from parityloom.sources import readers, writers
from parityloom.streaming import streams


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_chi_square_known_answers(spark):
    def run(counts, shares):
        df = spark.createDataFrame(list(counts.items()), "category string, n long")
        return divergence.chi_square(df, targets.distribution(spark, shares)).first()

    same = run({"A": 500, "B": 300, "C": 200}, {"A": 0.5, "B": 0.3, "C": 0.2})
    assert same["statistic"] == pytest.approx(0, abs=1e-9) and same["p_value"] == pytest.approx(1)
    off = run({"A": 70, "B": 30}, {"A": 0.5, "B": 0.5})
    assert off["statistic"] == pytest.approx(16) and off["p_value"] == pytest.approx(6.334e-5, rel=1e-3)
    three = run({"A": 120, "B": 50, "C": 30}, {"A": 0.5, "B": 0.3, "C": 0.2})
    assert three["df"] == 2 and three["p_value"] == pytest.approx(math.exp(-8.166666 / 2), rel=1e-4)


def test_tails():
    assert m.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert m.chi2_sf(0.5, 4) == pytest.approx(math.exp(-0.25) * 1.25, rel=1e-9)
    assert m.normal_bins(50, 15, 0, 100, 10).sum() == pytest.approx(1)


def test_tolerance_and_normal(spark):
    assert one(spark, m.adaptive_tolerance(F.lit(100))) == pytest.approx(0.098)
    assert one(spark, m.adaptive_tolerance(F.lit(100), 0.99)) == pytest.approx(0.1288)
    assert one(spark, m.normal_sf(F.lit(1.96))) == pytest.approx(0.025, rel=1e-3)


def test_scores(spark):
    assert [one(spark, scalar.t_score(F.lit(x))) for x in (50, 65)] == [50, 60]
    empty = one(spark, text.trait_scores(F.lit("")))
    assert empty["openness"] == 50 and empty["confidence"] == 0
    some = one(spark, text.trait_scores(F.lit("Este creativ, curios si sociabil.")))
    assert some["openness"] == 60 and some["extraversion"] == 55


def test_texts(spark):
    assert one(spark, text.ngrams(text.tokens(F.lit("a b")), 3)) == []
    assert one(spark, text.tokens(F.lit(None).cast("string"))) == []
    assert one(spark, text.sentences(F.lit(" One two.  Three! "))) == ["One two", "Three"]
    assert one(spark, text.opening_move(F.lit("Deși plouă, iese."))) == "contrast"
    assert one(spark, text.normalise(F.lit("  Chișinău, (mun.)  Țara "))) == "chisinau mun tara"
    assert one(spark, text.section(F.lit("[A] - one [B] two"), "A", ["A", "B"])) == "one"
    assert one(spark, text.parsed_sections(F.lit("Work:\nfarmer\nHobby:\nchess"), ["A"])) == {"Work": "farmer", "Hobby": "chess"}
    assert one(spark, text.context_windows(F.lit("I know how to cook well"), ["cook"], 4, 4, longer_than=0)) == ["to cook"]


def test_nested(spark):
    ok = lambda s, **k: one(spark, nested.strict_object(F.lit(s), ["a", "b"], **k)) is not None
    assert ok('{"a":"x"}') and not ok('{"a":1}') and not ok('{"c":"x"}') and not ok('{"a":"x"}', require_all=True) and not ok("no")
    assert one(spark, nested.lenient_field(F.lit('said {"a": "x"} so'), "a")) == "x"
    assert one(spark, nested.text_to_list(F.lit('["a","b"]'))) == ["a", "b"] and one(spark, nested.text_to_list(F.lit("a"))) == ["a"]


def test_two_way_fitting():
    got = raking.fit_two_way([0.6, 0.4], [0.3, 0.7])
    assert np.allclose(got, [[0.18, 0.42], [0.12, 0.28]])
    seeded = raking.fit_two_way([0.6, 0.4], [0.3, 0.7], np.array([[5, 1], [1, 5.0]]))
    assert np.allclose(seeded.sum(1), [0.6, 0.4]) and np.allclose(seeded.sum(0), [0.3, 0.7], atol=1e-5)


def test_rake_reaches_targets_and_keeps_nulls(spark):
    df = spark.createDataFrame([("a", "x")] * 60 + [("a", "y")] * 10 + [("b", "x")] * 20 + [("b", "y")] * 10 + [(None, "x")], "f string, g string")
    got = raking.rake(df, {"f": {"a": 0.5, "b": 0.5}, "g": {"x": 0.6, "y": 0.4}})
    assert got.rows.count() == 101 and got.drift["f"][1] < got.drift["f"][0]
    assert raking.rake(df.limit(0), {"f": {"a": 1.0}}).rows.count() == 0


def test_resample_is_exact_and_fair(spark):
    df = spark.range(50).withColumn("w", F.col("id") % 7)
    got = sampling.resample(df, "id", "w", 500).groupBy("source_id", "w").count().collect()
    total = sum(i % 7 for i in range(50))
    assert sum(r["count"] for r in got) == 500
    assert all(abs(r["count"] - r["w"] * 500 / total) < 1 for r in got)


def test_draws_do_not_depend_on_partitions(spark):
    rows = lambda n: people.population(spark.range(200).repartition(n)).orderBy("id").collect()
    assert rows(1) == rows(7)


def test_population_follows_rules_and_targets(spark):
    df = people.generate(spark, 1000)
    assert rules.summary(df, rules.person_rules()).first()["errors"] == 0
    sex = {r["value"]: r["share"] for r in profile.shares(df, F.col("sex")).collect()}
    assert sex["Feminin"] == pytest.approx(0.528, abs=0.05)


def test_corrected_population_is_closer(spark):
    rows, raked = people.corrected(spark, 500)
    assert rows.count() == 500 and rows.select("uuid").distinct().count() == 500
    assert all(after <= before + 1e-9 for before, after in raked.drift.values())


def test_statistics_document(spark, tmp_path):
    body = '{"columns":[{"code":"Ani","text":"Ani","type":"d"},{"code":"Sexe","text":"Sexe","type":"d"},{"code":"Population","text":"P","type":"c"}],"data":[{"key":["2024","1"],"values":["1000"]},{"key":["2024","2"],"values":["1200"]},{"key":["2024","2"],"values":[".."]}]}'
    p = tmp_path / "s.json"
    p.write_text(body)
    got = {r["category"]: r["p"] for r in readers.read_statistics(spark, str(p), "Sexe", {"1": "M", "2": "F"}).collect()}
    assert got["M"] == pytest.approx(1000 / 2200) and got["F"] == pytest.approx(1200 / 2200)
    with pytest.raises(ValueError, match="not found"):
        readers.read_statistics(spark, str(p), "Sex")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "jsonl"])
def test_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, 'a "q", b'), (2, "é\n"), (3, None)], "id int, t string")
    path = writers.write(df, f"{tmp_path}/x.{fmt}", fmt)
    assert sorted(r["id"] for r in readers.read(spark, path, df.schema).collect()) == [1, 2, 3]


def test_unknown_ending(spark):
    with pytest.raises(ValueError):
        readers.read(spark, "x.foo")


def test_close_pairs_against_brute_force(spark):
    values = [0.0, 0.1, 0.9, 1.0, 1.05, 1.1, 2.0, 2.0]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    want = {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if i < j and abs(a - b) <= 0.25}
    got = [tuple(r) for r in joins.close_pairs(df, "id", "v", 0.25).collect()]
    assert set(got) == want and len(got) == len(want)


def test_minhash_classes(spark):
    t = "one two three four five six seven eight"
    df = spark.createDataFrame([(1, t), (2, t), (3, "other words stand here now and then"), (4, ""), (5, None)], "id long, t string")
    pairs, members = duplicates.similar_classes(df, "id", "t")
    assert {tuple(r) for r in members.collect()} == {(1, 1), (2, 1), (3, 3)} and pairs.count() == 0
    assert duplicates.uniqueness(pairs, members).first()["duplicate_pairs"] == 1


def test_gates():
    d = gates.decide(gates.Metrics(mean_l1=0.02, max_error=0.03), "HIGH_STAKES")
    assert d.verdict == "PASS" and d.structured_tier == "A"
    bad = gates.decide(gates.Metrics(mean_l1=0.3, ess_ratio=0.2), "HIGH_STAKES")
    assert bad.verdict == "REJECT" and "ESS_TOO_LOW" in bad.codes and bad.codes[0] == "ESS_TOO_LOW"
    warn = gates.Metrics(mean_l1=0.08)
    assert gates.decide(warn, "HIGH_STAKES").verdict == "PASS_WITH_WARNINGS" and gates.decide(warn, "HIGH_STAKES", strict=True).verdict == "REJECT"
    assert gates.payload(bad)["confidence"] == "low" and gates.payload(d)["confidence"] == "high"
    capped = gates.payload(d, "HIGH_STAKES", "hardcoded_fallback")
    assert capped["confidence"] == "medium" and capped["monotonicity_applied"]


def test_sliced_generation_resumes(spark, tmp_path):
    make = lambda ids: people.population(ids, 1).select("id", "sex", "age")
    path = f"{tmp_path}/s"
    streams.generate_sliced(spark, make, 50, 25, path, 1)
    streams.generate_sliced(spark, make, 100, 25, path, 1)
    got = spark.read.parquet(f"{path}/*").orderBy("id").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in make(spark.range(100)).orderBy("id").collect()]
    with pytest.raises(ValueError):
        streams.generate_sliced(spark, make, 10, 5, path, 1)


def test_rules_on_empty_table(spark):
    df = people.generate(spark, 1).limit(0)
    assert rules.summary(df, rules.person_rules()).first()["n_rows"] == 0
    assert profile.field_shares(df, ["sex", "region"]).count() == 0


def test_checkpoints_are_listed(spark, tmp_path):
    path = str(tmp_path / "slices")
    assert streams.checkpoints(spark, path).count() == 0
    streams.generate_sliced(spark, lambda ids: ids, 25, 10, path, seed=7)
    rows = streams.checkpoints(spark, path).orderBy("first").collect()
    assert [(r["first"], r["end"], r["complete"]) for r in rows] == [(0, 10, True), (10, 20, True), (20, 25, True)]
    got = streams.checkpoint_summary(spark, path, 50).first()
    assert (got["seed"], got["slices"], got["rows"], got["part"]) == (7, 3, 25, 0.5) and got["latest"] in {r["name"] for r in rows}


def test_employment_follows_the_age_group(spark):
    got = people.population(spark.range(2000), employment={"35-44": {"employed": 1.0}})
    here = {r[0] for r in got.where("age_group = '35-44'").select("employment_status").distinct().collect()}
    there = {r[0] for r in got.where("age_group = '45-54'").select("employment_status").distinct().collect()}
    assert here == {"employed"} and {"employed", "homemaker", "other_inactive"} <= there


def test_variables_are_found_without_marks():
    some = [{"code": "a", "text": "Raioane și municipii", "values": [1]}, {"code": "b", "text": "RAIOANE  SI-MUNICIPII (toate)", "values": [1, 2]}]
    assert readers.find_variable(some, "raioane si municipii")["code"] == "b"


def test_running_sums_by_range(spark):
    rows = [(g, v, 1 + v % 3) for g in ("x", None) for v in range(200)]
    got = profile.running(spark.createDataFrame(rows, "g string, v int, c int"), "c", ["g"], F.col("v").asc()).collect()
    assert len(got) == 400 and all(r["upto"] == sum(1 + v % 3 for v in range(r["v"] + 1)) and r["total"] == 399 for r in got)
