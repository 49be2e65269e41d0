"""Narratives, decomposition, kept results and laws against plain Python."""

import math
import random
import unicodedata
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from parityloom.functions import fold, text
from parityloom.operators import divergence, targets
from parityloom.plans import narratives
from parityloom.sources import cache


def test_every_code_point_decomposes(spark):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and c != 0x1F]
    rows = [(i, "".join(map(chr, points[i : i + 997]))) for i in range(0, len(points), 997)]
    got = {r["i"]: r["d"] for r in spark.createDataFrame(rows, "i int, s string").select("i", fold.decomposed(F.col("s")).alias("d")).collect()}
    bad = [i for i, s in rows if got[i] != "".join(c for x in s for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))]
    assert bad == []


def test_decomposition_of_texts(spark):
    texts = ["", None, "ascii", "Ça Éß ﬁ №5 ½ ｆｕｌｌ ĐĦ 각 Å̊ 𝒜 é́", "ȚĂRAN  Bălți."]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(text.nfkd(F.col("s"))).collect()]
    assert got == [t if t is None else "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c)) for t in texts]
    assert spark.range(1).select(text.normalise_place(F.lit(" Ōsaka, Mun. Kraków"))).head()[0] == "osaka mun krakow"


def test_openings(spark):
    texts = ["3 copii au mers la mare azi și mâine dimineață", "Ion  lucrează\nla fermă", "singur", "", None, "Ștefan are", "É are", "a b c d e f g h i"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(text.opening_words(F.col("s"))).collect()]
    assert got == ["3 copii au mers la mare azi și", "lucrează la fermă", "singur", "", "", "are", "é are", "b c d e f g h"]
    df = spark.createDataFrame([(1, "Ana merge", "Ion merge", "", None), (2, "a b", "c d", "e f", "x")], "id int, a string, b string, c string, d string")
    assert [tuple(r) for r in narratives.shared_openings(df, "id", ["a", "b", "c", "d"]).collect()] == [(1, [0, 1, 2, 3])]


RECORDS = "id int, age int, occupation string, region string, name string, sex string, one string, two string"


def test_mentions(spark):
    rows = [
        (1, 30, "Medic veterinar", "Nord", "Ana Rusu", "Feminin", "Ana, medic din Nord, are 30 ani.", "Ea merge."),
        (2, 30, "Om de om", "Sud", "Ion", "Masculin", "El are ani.", "O fată și o femeie. Ea merge"),
        (3, None, None, None, None, None, None, None),
        (4, 70, "pensionar", "", "  Vasile  P", None, "ea spune: vasile", ""),
        (5, 17, "elev", "x", "Q", "Feminin", "el are 17 ani", ""),
    ]
    got = {r["id"]: r["issues"] for r in narratives.mentions(spark.createDataFrame(rows, RECORDS), ["one", "two"]).collect()}
    assert got == {
        1: [],
        2: ["age_missing", "occupation_missing", "region_missing", "name_missing", "other_pronoun"],
        3: ["age_missing"],
        4: ["age_missing", "other_pronoun_first"],
        5: ["region_missing", "name_missing", "other_pronoun_first"],
    }


def test_conflicts(spark):
    rows = [
        (1, 17, "", "", "Ana", "Feminin", "Ana e la pensie", "pensionar"),
        (2, 40, "", "", "Ion", "Masculin", "o fată, o femeie", "ea și ei"),
        (3, 10, "", "", "Ion", "Feminin", "", "la pensie"),
        (4, None, "", "", None, None, "text", None),
    ]
    got = {r["id"]: [(c["field"], c["severity"]) for c in r["conflicts"]] for r in narratives.conflicts(spark.createDataFrame(rows, RECORDS), ["one", "two"]).collect()}
    assert got == {1: [("two", "error")] * 2, 2: [("one", "warning")] * 2, 3: [], 4: []}


def test_counters_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(None, "  "), ("ă ș text", "x" * 30)], "a string, b string")
    fields = {"a": (3, 10), "b": (1, 20)}
    got = {r["field"]: r.asDict() for r in narratives.field_counters(df, fields).collect()}
    assert got["a"] == {"field": "a", "n": 2, "present": 1, "missing": 1, "too_short": 0, "too_long": 0, "length_ok": 1, "language_ok": 1, "language_fail": 0, "valid": 1}
    assert (got["b"]["missing"], got["b"]["too_long"], got["b"]["language_fail"]) == (1, 1, 1)
    r = narratives.row_counters(df, fields).head()
    assert (r["n"], r["any_valid"], r["all_valid"], r["too_long"], r["length_valid"]) == (2, 1, 0, 1, 0)
    assert narratives.row_counters(df.limit(0), fields).head()["n"] == 0


def test_rosy_texts(spark):
    df = spark.createDataFrame([("a", "uneori e greu, dar merge"), ("a", None), ("b", "totul e bine " * 200), ("c", "dar " + "cuvânt " * 400)], "g string, s string")
    got = {r["g"]: (r["n_texts"], r["friction"], r["words"], r["passed"]) for r in narratives.not_too_rosy(df, "g", "s").collect()}
    assert got == {"a": (2, 2, 5, True), "b": (1, 0, 600, False), "c": (1, 1, 401, False)}


# ---- kept results --------------------------------------------------------------------------------


def test_results_are_computed_once(spark, tmp_path):
    made = []

    def compute():
        made.append(1)
        return spark.range(3)

    a = {"row": {"x": 0.1 + 0.2, "y": 0.7}, "col": {"p": 1.0}}
    same = {"col": {"p": 1.0}, "row": {"y": 0.7, "x": 0.3}}
    assert cache.signature(a) == cache.signature(same) != cache.signature({"row": a["row"], "col": {"p": 0.9}})
    get = lambda inputs, **k: cache.kept(spark, str(tmp_path), "n", cache.signature(inputs), compute, **k)
    assert [get(a)[1], get(same)[1], get({"row": {"x": 1}})[1]] == [False, True, False] and len(made) == 2
    table, found = get(a, days=1)
    assert found and table.count() == 3
    assert not get(a, days=-1)[1] and len(made) == 3  # it has aged
    assert cache.aged_out(spark, str(tmp_path), "n", 1) == [] and len(cache.aged_out(spark, str(tmp_path), "n", -1)) == 2
    assert not get(a)[1] and cache.aged_out(spark, str(tmp_path), "none", 1) == []


def test_a_half_written_result_is_none(spark, tmp_path):
    (tmp_path / "n" / "key").mkdir(parents=True)
    table, found = cache.kept(spark, str(tmp_path), "n", "key", lambda: spark.range(2))
    assert not found and table.count() == 2


def test_table_signatures(spark):
    a = targets.distribution(spark, {"x": 0.25, "y": 0.75})
    b = targets.distribution(spark, {"y": 0.75, "x": 0.25}).repartition(3)
    c = spark.createDataFrame([("x", 0.25 + 1e-14), ("y", 0.75)], "category string, p double")
    d = spark.createDataFrame([("x", 0.25), ("x", 0.25), ("y", 0.75)], "category string, p double")
    assert cache.table_signature(a) == cache.table_signature(b) == cache.table_signature(c) != cache.table_signature(d)
    assert cache.table_signature(a, d) != cache.table_signature(d, a) and cache.table_signature(a.limit(0)) != cache.table_signature(a)


# ---- laws ----------------------------------------------------------------------------------------


def test_normal_law(spark):
    zs = [-9.0, -2.5, -1.0, -1e-9, 0.0, 0.3, 1.96, 4.0, 40.0]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(divergence.normal_cdf(F.col("z"))).collect()]
    assert got == pytest.approx([NormalDist().cdf(z) for z in zs], abs=1e-7)


def test_groups_against_the_law(spark):
    rng = random.Random(1)
    rows = [("normal", rng.gauss(50, 15)) for _ in range(4000)] + [("flat", rng.uniform(0, 100)) for _ in range(4000)] + [("one", 50.0)] * 9 + [("null", None)] + [("narrow", rng.gauss(50, 3)) for _ in range(500)] + [("out", 500.0), ("out", 900.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in divergence.against_normal(df, "v", ["g"], 0, 100, 10).collect()}
    assert set(got) == {"normal", "flat", "one", "narrow", "out"}
    assert got["normal"]["js"] < 0.002 < 0.01 < got["flat"]["js"] and got["one"]["kl"] is None and got["one"]["collapsed"]
    assert got["narrow"]["collapsed"] and not got["flat"]["collapsed"]
    values = [v for g, v in rows if g == "flat"]
    mean = sum(values) / 4000
    law = NormalDist(mean, math.sqrt(sum((v - mean) ** 2 for v in values) / 4000))
    p = [law.cdf(10 * i + 10) - law.cdf(10 * i) for i in range(10)]
    q = [sum(10 * i <= v < 10 * i + 10 for v in values) / 4000 for i in range(10)]
    assert got["flat"]["max_error"] == pytest.approx(max(abs(a / sum(p) - b) for a, b in zip(p, q)), abs=1e-6)
    fixed = {r["g"]: r for r in divergence.against_normal(df, "v", ["g"], 0, 100, 10, 50.0, 15.0).collect()}
    assert fixed["narrow"]["kl"] > 0.5 and fixed["one"]["kl"] > 0.5


def test_paths(spark):
    paths = {
        "https://x.md/PxWeb/pxweb/ro/20%20Populatia/20%20Populatia__POP010/a.px/?rxid=1": "20 Populatia/POP010/a.px",
        "pxweb/ro/A/b__c": "pxweb/ro/A/b/c",
        "/pxweb/en/Ă b/A B__c__d/e": "A B/c/d/e",
        "http://x.md/PxWeb/api/v1/ro/one/two+three.px": "one/two+three.px",
        " /a//b/ ": "a/b",
        "": "",
    }
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").select(text.clean_path(F.col("p"))).collect()]
    assert got == list(paths.values()) and spark.range(1).select(text.clean_path(F.lit(None).cast("string"))).head()[0] == ""
