"""The suffix tree against the same model in plain dictionaries."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from parityloom.llm import queries, suffix_tree

DOCS = "doc_id long, text string"


def in_training(doc):
    return doc is not None and crc32(str(doc).encode()) % 10 != 0


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w] + ["</s> "]


def model(rows, least, gain, k=suffix_tree.K):
    """(N, known words, base, log10 of the chance of w after t and u)."""
    one, two, three, docs = Counter(), Counter(), Counter(), 0
    for doc, text in rows:
        if in_training(doc):
            line = [None, "<s> ", *words(text)]
            docs += 1
            one.update(line[2:])
            two.update(zip(line[1:], line[2:]))
            three.update(zip(line[0:], line[1:], line[2:]))
    n, v = sum(one.values()), len(one)
    base = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    often = lambda c: {g: x for g, x in c.items() if x >= suffix_tree.LEAST_COUNT}

    def states(seen, totals, parent):
        kept, rest = {}, {}
        for ctx in {g[:-1] for g in seen}:
            of = {g[-1]: x for g, x in seen.items() if g[:-1] == ctx}
            total = totals[ctx]
            if total < least:
                continue
            b = total - sum(of.values()) + k
            d = sum(x * math.log10((x - 1 + b * parent(ctx, w)) / (parent(ctx, w) * (total - 1 + k))) for w, x in of.items()) + (total - sum(of.values())) * math.log10(b / (total - 1 + k))
            if d > gain:
                kept[ctx], rest[ctx] = of, (b, total + k)
        return kept, rest

    one_of = {(w,): x for w, x in one.items()} | {("<s> ",): docs}
    kept1, rest1 = states(often(two), one_of, lambda ctx, w: base(w))
    after = lambda u, w: (kept1[(u,)].get(w, 0) + rest1[(u,)][0] * base(w)) / rest1[(u,)][1]
    often3 = {g: x for g, x in often(three).items() if g[0] is not None and g[1:2] in kept1 and two[g[:2]] >= least}
    kept2, rest2 = states(often3, two, lambda ctx, w: after(ctx[1], w))

    def chance(t, u, w):
        if (u,) not in kept1:
            return base(w)
        if (t, u) in kept2:
            return (kept2[t, u].get(w, 0) + rest2[t, u][0] * after(u, w)) / rest2[t, u][1]
        return after(u, w)

    return n, one, base, chance, kept1, kept2


def brute(rows, least, gain):
    n, one, base, chance, _, kept2 = model(rows, least, gain)
    out = []
    for doc, text in rows:
        line = [None, "<s> ", *words(text)]
        b = sum(math.log10(base(w)) for w in line[2:])
        s = sum(math.log10(chance(t, u, w)) for t, u, w in zip(line, line[1:], line[2:]))
        out.append((doc, in_training(doc), len(line) - 2, sum(one[w] > 0 for w in line[2:]), n, round(b, 6), round(s, 6)))
    return Counter(out), kept2


def train(c=None):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) != 0, F.lit(False))


def scores(spark, rows, least=4, gain=0.5, schema=DOCS):
    got = suffix_tree.scored(spark.createDataFrame(rows, schema), train(), least, gain)
    return Counter((r["doc_id"], r["trained"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got.collect())


def corpus(n=150, seed=1):
    rng = random.Random(seed)
    lines = [" ".join(rng.choices(["the", "Cat", "sat", "on", "É", "mat.", "dog"], k=6)) for _ in range(8)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randrange(0, 9))) + " " + " ".join(rng.choices([f"w{j}" for j in range(40)], k=5))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (None, "the cat\tsat"), (5, rows[5][1]), (5, rows[5][1]), (6, "other text of a known id"), (1010, "na " * 3000), (1030, "unseen words only")]


def test_equals_dictionaries(spark):
    rows = corpus()
    want, kept2 = brute(rows, 4, 0.5)
    assert kept2
    got = scores(spark, rows)
    assert {r[:5] for r in got} == {r[:5] for r in want}
    for x, y in zip(sorted(got.elements(), key=str), sorted(want.elements(), key=str)):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], abs=2e-6)


def test_lanes_and_filters_change_nothing(spark, monkeypatch):
    rows = corpus(60, 2)
    plain = scores(spark, rows)
    monkeypatch.setattr(suffix_tree, "LANES", 3)
    monkeypatch.setattr(suffix_tree, "LANE", 40)  # words before many tokens go to several lanes
    monkeypatch.setattr(suffix_tree, "BLOCK", 50)
    monkeypatch.setattr(suffix_tree, "HEAVY", 4)  # most words are joined
    assert sorted(map(str, scores(spark, rows).elements())) == sorted(map(str, plain.elements()))


def test_states_sum_to_one():
    rows = corpus()
    _, one, base, chance, kept1, kept2 = model(rows, 4, 0.5)
    unknown = 1 - sum(base(w) for w in one)
    for u in [k[0] for k in kept1][:5]:
        assert sum(chance("?", u, w) for w in one) + unknown * chance("?", u, "?") / base("?") == pytest.approx(1)
    for t, u in list(kept2)[:5]:
        assert sum(chance(t, u, w) for w in one) + unknown * chance(t, u, "?") / base("?") == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    assert scores(spark, []) == Counter()
    held = next(i for i in range(100) if not in_training(i))
    assert scores(spark, [(held, "a b c"), (None, None)]) == Counter([(held, False, 4, 0, 0, 0.0, 0.0), (None, False, 1, 0, 0, 0.0, 0.0)])


def test_clashing_columns(spark):
    rows = [(*r, "x", 1, 2, 3.0) for r in corpus(40, 3)]
    assert scores(spark, rows, schema="doc_id long, text string, h string, row long, u long, score double") == scores(spark, [r[:2] for r in rows])


def test_query(spark):
    rows = queries.op12_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want, _ = brute(docs, suffix_tree.LEAST_CONTEXT, suffix_tree.LEAST_GAIN)
    got = {r["doc_id"]: tuple(r) for r in rows}
    assert len(rows) == len(docs)
    for doc, trained, n, known, total, base, score in want:
        assert got[doc][:5] == (doc, not trained, n, known, total)
        assert got[doc][5:] == pytest.approx((base, score), abs=1e-5)


@pytest.mark.parametrize("texts", [[""], [], ["a"], ["a b", "", " ", "c"], ["The the THE", "\x00 \x00\x00 É\xa0é \x0b\x0c\r\nx"], ["ab", "cd", "abcd"], [" lead", "trail ", ""]])
def test_hashes_stand_for_words(texts):
    import pyarrow as pa

    for cut in (0, 1):
        n, h = suffix_tree.tokens(pa.array(["zz"] * cut + texts, pa.string()).slice(cut))
        flat = [w for t in texts for w in words(t)]
        assert n.tolist() == [len(words(t)) for t in texts] and len(h) == len(flat)
        assert len(set(zip(h.tolist(), flat))) == len(set(flat)) == len(set(h.tolist()))


def test_long_words_are_hashed_in_parts(monkeypatch):
    import pyarrow as pa

    text = "a" * 5000 + " b " + "a" * 4999 + " c" * 3000 + " " + "a" * 5000
    whole = suffix_tree.tokens(pa.array([text]))[1].tolist()
    monkeypatch.setattr(suffix_tree, "SPAN", 100)
    assert suffix_tree.tokens(pa.array([text]))[1].tolist() == whole and whole[0] == whole[-2] != whole[2]


def test_more_than_2_to_the_30_tokens(spark, monkeypatch):
    """All counts times a number: sums of 2**30 to 2**31 tokens and more; chances of what was learnt hardly differ between the two."""
    counted, rows = suffix_tree.counted, corpus(60, 2)[:60]
    total, one, *_ = model(rows, 4, 0.5)
    monkeypatch.setattr(suffix_tree, "LANE", 40)  # some words are before very many
    found = []
    for least in (2**30, 2**32):
        times = least // total + 1
        monkeypatch.setattr(suffix_tree, "counted", lambda *a, by=times: counted(*a).withColumn("n", F.col("n") * by))
        got = {r[0]: r for r in scores(spark, rows)}
        for doc, text in rows:
            line = words(text)
            base = sum(math.log10((one[w] * times + 0.1) / (total * times + 0.1 * (len(one) + 1))) for w in line)
            assert got[doc][2:5] == (len(line), sum(one[w] > 0 for w in line), total * times) and got[doc][5] == pytest.approx(base, abs=2e-6)
        found.append({doc: r[6] for doc, r in got.items() if r[1]})
    assert found[0] == pytest.approx(found[1], abs=1e-3) and any(got[doc][6] > got[doc][5] + 1 for doc in got)
