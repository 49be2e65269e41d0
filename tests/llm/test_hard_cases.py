"""Broken, very long, repetitive, empty and clashing input; and the queries on tables of their own."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from parityloom.llm import decontamination, html_text, line_dedup, neighbours, pii, queries, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def within(seconds, call, *args):
    start = time.perf_counter()
    out = call(*args)
    assert time.perf_counter() - start < seconds
    return out


def test_broken_and_long_pages_end():
    assert within(20, html_text.main_text, "<div>" * 100_000 + "x") in ("x", "")
    many = "<p>A block of some words, with a full stop.</p>" * 50_000 + "<nav>" + "<a>x</a><br>" * 50_000 + "</nav>"
    assert within(40, html_text.main_text, many).count("\n") == 49_999
    within(20, html_text.main_text, "<b>" * 50_000 + "</i></div>" * 50_000)
    for tag in ("<svg><p>x", "<select>", "<head><body>x", "<object><canvas>", "<script>"):
        within(8, html_text.main_text, tag * 100_000)
    assert html_text.main_text("<svg>" + "<p>Text after it, with a full stop.</p>" * 3).count("Text") == 3


def cut_cost(labels, logits, edges):
    return sum(max(0.0, x) for x, keep in zip(logits, labels) if not keep) + sum(max(0.0, -x) for x, keep in zip(logits, labels) if keep) + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_cut_is_least():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randrange(1, 9)
        logits = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        least = min(cut_cost([bool(m >> i & 1) for i in range(n)], logits, edges) for m in range(1 << n))
        assert cut_cost(html_text.minimum_cut(logits, edges), logits, edges) == pytest.approx(least)


def test_segments_are_found_in_one_pass():
    hits = [(3 * i, 1.0) for i in range(200_000)]
    for ordinary in (-0.4999, -0.5, -0.6):
        within(10, toxicity.maximal_segments, hits, ordinary)
    rng = random.Random(3)
    for _ in range(200):  # against all intervals
        score = [rng.choice([2.0, 1.0, -1.0, -1.5]) for _ in range(rng.randrange(1, 14))]
        got = toxicity.maximal_segments([(i, s) for i, s in enumerate(score)], -1.0)
        want, parts = [], [(0, len(score))]
        while parts:
            a, b = parts.pop()
            best = max(((sum(score[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            if best[0] > 0:
                i, j = -best[2], -best[2] - best[1]
                want.append(best[0])
                parts += [(a, i), (j, b)]
        assert sorted(x[2] for x in got) == pytest.approx(sorted(want))


def test_scale_of_the_law():
    rng = np.random.default_rng(1)
    n = rng.integers(50, 500, 4000)
    best = np.log(0.02 * n / rng.exponential(1, 4000)) / 1.5  # exp(-K n e^(-lambda S)) for K = .02
    assert toxicity._scale(list(zip(n.tolist(), best.tolist())), 1.5) == pytest.approx(0.02, rel=0.1)


def test_repetitive_texts_are_tiled_soon():
    assert sum(n for *_, n in within(10, decontamination.tiles, np.zeros(60, int), np.zeros(20_000, int))) == 60


def test_a_pattern_needs_a_word(spark):
    rows = [(i, f"{a}111 1111 1111 1111") for i, a in enumerate("44444")] + [(9, "version2024x released yesterday")]
    rows = [(i, t.replace("4111", "4111")) for i, t in rows]
    got = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(not r["learned"] for r in got) and sum(len(r["base"]) for r in got) == 5


def test_discovered_identifiers_discover_more(spark):
    def card(i):
        body = f"41{i:013d}"
        total = sum(sum(divmod(2 * int(c), 10)) if k % 2 == 0 else int(c) for k, c in enumerate(body))
        return body + str(-total % 10)

    rows = [(100 + i, f"the account {card(i)} belongs here") for i in range(30)]
    rows += [(10 + i, f"the account K{i}X90210 belongs here") for i in range(10)]
    rows += [(30 + i, f"customer reference K{i}X90210 noted today") for i in range(10)]
    rows += [(60, "customer reference Z7Q55120 noted today"), (61, "chapter number Z7Q99999 of the book")]
    got = {r["doc_id"]: len(r["learned"]) for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[10] == 1 and got[60] == 1 and got[61] == 0


def test_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two three\nfour five", "mine", 7, "r"), (2, "one two three", "too", 8, "s")], "doc_id long, text string, kept string, n_lines int, row string")
    out = {r["doc_id"]: r for r in line_dedup.without_later(df).collect()}
    assert out[2]["text"] == "" and out[2]["kept"] == "too" and out[1]["n_lines"] == 7 and out[1]["row"] == "r"
    empty = df.limit(0)
    assert line_dedup.decisions(empty).count() == 0 and line_dedup.without_later(empty).columns == df.columns
    assert pii.personal_data(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(none, F.col("id") % 50 == 0).count() == 0


def test_similar_lines_against_all_pairs(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    lines = []
    for _ in range(40):
        base = rng.sample(words, rng.choice([1, 2, 3, 4, 5, 9, 15, 24]))
        for _ in range(6):
            new = list(base)
            for _ in range(rng.randrange(4)):
                change = rng.random()
                if change < 0.4 and len(new) > 1:
                    new.pop(rng.randrange(len(new)))
                elif change < 0.7:
                    new.append(rng.choice(words))
                else:
                    new[rng.randrange(len(new))] = rng.choice(words)
            rng.shuffle(new)
            lines.append(" ".join(new))
    rng.shuffle(lines)
    docs = [(i, "\n".join(lines[6 * i : 6 * i + 6])) for i in range(len(lines) // 6)]
    sets = [frozenset(x.split()) for x in lines]
    gone = {i for i, s in enumerate(sets) if any(5 * len(s & o) >= 4 * len(s | o) for o in sets[:i])}
    got = line_dedup.decisions(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {6 * r["doc_id"] + n for r in got for n in r["kept"]} == set(range(len(lines))) - gone


@pytest.mark.parametrize("dim", [64, 128])
def test_recall_of_hashing(spark, dim):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(2500, dim))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("id") % 50 == 0).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 2500, 50):
        s = u @ u[q]
        s[q] = -2
        hit += len(set(np.argsort(-s)[:5].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hit >= 0.9 * 5 * 50


def test_queries_on_a_table_of_their_own(spark, tmp_path):
    rows = [(1, "write to ann@example.org or 10.0.0.1", "en", "a", 5), (2, None, None, None, None), (3, "", "en", "b", 0), (4, "a b c d e f g h", "en", "b", 15), (5, "a b c d e f g h", "en", "c", 15), (6, "a b c d e f g h\nx", "en", "c", 17)]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    one = {r["doc_id"]: r for r in queries.op1_pii(spark, str(tmp_path)).collect()}
    assert (one[1]["n_email"], one[1]["n_ip"], one[1]["n_card"], one[1]["n_phone"], one[1]["spans"]) == (1, 1, 0, 0, "email:9:24,ip:28:36")
    import hashlib

    assert one[1]["base_sha256"] == hashlib.sha256(b"email:9:24,ip:28:36").hexdigest() and one[2]["base_sha256"] == hashlib.sha256(b"").hexdigest() and len(one) == 6
    two = {r["doc_id"]: r for r in queries.op2_simhash(spark, str(tmp_path)).collect()}
    assert two[5]["component_id"] == 4 and two[2]["component_id"] == two[3]["component_id"] == 2 and two[3]["fingerprint"] == "0" * 16
    four = {r["doc_id"]: r for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()}
    assert (four[4]["kept"], four[5]["kept"], four[6]["kept"], four[6]["n_lines"]) == ("0", "", "1", 2)
    three = queries.op3_packing(spark, str(tmp_path)).collect()
    from zlib import crc32

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    ids = {r[0]: plain.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    for r in three:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == crc32(np.array(part, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]]) and len(part) == r["length"]
    assert sum(r["length"] for r in three) == sum(map(len, ids.values()))
    seven = {r["doc_id"]: r for r in queries.op7_token_file(spark, str(tmp_path)).collect()}
    bpe, start = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json")), 0
    for r in rows:
        want = bpe.encode(r[1] or "", add_special_tokens=False).ids + [2]
        assert (seven[r[0]]["start"], seven[r[0]]["n_tokens"], seven[r[0]]["ids_crc32"]) == (start, len(want), crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
