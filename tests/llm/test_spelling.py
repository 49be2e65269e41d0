"""Spelling variants against SQL and brute force."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from oracle import connect, difference

from parityloom.llm import queries, spelling

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])


def brute(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(x, key=lambda y: (-n[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if n[b] >= 2 * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def found(spark, rows, schema="doc_id long, text string"):
    return {tuple(r) for r in spelling.variants(spark.createDataFrame(rows, schema)).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_random_words(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(4, 8))) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(words, [1 + 9 * (j % 5 == 0) for j in range(400)], k=60))) for i in range(120)]
    rows += [(None, "Aabba ÀÉabb aabba " * 5), (3, None), (4, ""), (4, "aabba"), (4, "aabba"), (5, "x" * 100_000 + " ñandúes " * 3 + "ñandues " * 9)]
    want = brute(rows)
    assert found(spark, rows) == want and len({r[2] for r in want}) < len(want)
    # the smallest blocks give the same
    words = spelling.dictionary(spark.createDataFrame(rows, "doc_id long, text string"))
    pairs = [{tuple(sorted((r["a"], r["b"]))) for r in got} for got in (spelling.near(words, 2).collect(), spelling.near(words, 10_000).collect())]
    assert pairs[0] == pairs[1] == {tuple(sorted((w[0], x[0]))) for w in want for x in want if one_edit(w[0], x[0])}
    assert spelling.near(words, 2).count() == len(pairs[0])


def test_one_block_is_subdivided(spark):
    # all share their first half; and a frequent form with many variants
    words = ["abcdef" + a + b + "x" for a in "abcdefghijklmnop" for b in "abcdefghijklmnop"]
    rows = [(1, " ".join(words * 3)), (2, "abcdefaax " * 50)]
    assert found(spark, rows) == brute(rows)
    entries = spelling.blocks(spelling.dictionary(spark.createDataFrame(rows, "doc_id long, text string")), 20)
    assert entries.where("hi - lo > 1").groupBy(*spelling.KEY).count().where("count > 20").isEmpty()


def test_chains_lead_to_the_last_form(spark):
    chain = {"abcdea": 3, "abcdeb": 6, "abcdxb": 12, "abzdxb": 24, "qbzdxb": 48, "qbzdxbs": 96}
    doc = next(d for d in range(99) if all(crc32(f"{d}:{w}".encode()) % 97 for w in chain))
    rows = [(doc, " ".join(w for w, c in chain.items() for _ in range(c)))]
    got = found(spark, rows)
    assert got == brute(rows) and {r[2] for r in got} == {"qbzdxbs"}


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "a b c 1 2 3")]])
def test_nothing(spark, rows):
    assert found(spark, rows) == set()


def test_clashing_columns(spark):
    rows = [(1, "spelling speling " * 4, 1, 2, "x", "y", 3)]
    assert found(spark, rows, "doc_id long, text string, n long, L int, word string, block string, lo int") == brute([r[:2] for r in rows])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op13_spelling_variants(spark, sf)
    assert difference(got, connect(sf), queries.ORACLE["op13_spelling_variants"]) == ""
    assert got.count() > 100
