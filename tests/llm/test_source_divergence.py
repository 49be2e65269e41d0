"""Source divergence against SQL on hard tables."""

import pytest

from oracle import connect, difference

from parityloom.llm import queries, source_divergence

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def against_sql(spark, rows, schema=DOCS):
    df = spark.createDataFrame(rows, schema)
    con = connect("/root/testdata/sf0.001")
    con.register("given", df.toArrow())
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM given")
    return source_divergence.audit(df), con, source_divergence.SQL


def test_lower_casing_changes_only_ascii(spark):
    texts = ["ABC xyz", "É À Straße ÄB", "İI ΣΑΣ K Å", "ⒶⅫ Ǆ", "ÑandÚ", "naïve–A", "", "𐐀A"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(source_divergence.ascii_lower(source_divergence.F.col("t"))).collect()
    assert [r[0] for r in got] == ["".join(c.lower() if c.isascii() else c for c in t) for t in texts]


def test_nulls_empties_ties_repeats_and_bare_languages(spark):
    rows = [(i % 3, "The cat É sat. The" + " dog" * (i % 2), "en", f"s{i % 4}", 1) for i in range(40)]
    rows += [(None, "the CAT", "en", "s1", 1)] * 12 + [(7, None, None, "s0", 0)] * 3 + [(8, "", None, None, 0), (9, "rare words", "xx", "b", 1), (9, "rare", "xx", "a", 1), (5, "1 2 3", "en", "bare", 1)]
    rows += [(i, "ça va " * i, "fr", "solo", 1) for i in range(12)] + [(1, "un deux " * 50_000, "fr", "solo", 1)]
    df, con, sql = against_sql(spark, rows)
    assert difference(df, con, sql) == ""
    got = {(r["lang"], r["source"], r["part"], r["item"]): r["value"] for r in df.collect()}
    assert got["xx", "a", "pair", "b"] == 0 and got["", "s0", "pair", ""] == 0


def test_large_counts_stay_exact(spark):
    n, total, terms = 10**13 + 7, 3 * 10**13 + 1, 10**9
    got = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long").select(source_divergence.share("n", "total", "terms")).head()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * terms)
    assert spark.createDataFrame([(10**9, 3)], "p long, q long").select(source_divergence.gap("p", "q")).head()[0] == (10**9 - 3) ** 2 // (10**9 + 3)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_empty(spark, rows):
    df, con, sql = against_sql(spark, rows)
    assert difference(df, con, sql) == "" and df.count() == 0


def test_clashing_columns(spark):
    rows = [(i, "some text", "en", f"s{i % 2}", "x", 1, 2, 3) for i in range(20)]
    plain, clash = (source_divergence.audit(spark.createDataFrame(r, s)).collect() for r, s in ((rows, "doc_id long, text string, lang string, source string, term string, n long, p long, lane long"), ([r[:4] for r in rows], "doc_id long, text string, lang string, source string")))
    assert sorted(plain) == sorted(clash)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    assert difference(queries.op11_source_divergence(spark, sf), connect(sf), queries.ORACLE["op11_source_divergence"]) == ""
