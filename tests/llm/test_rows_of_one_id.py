"""Null and repeated ids: each row is a document of its own."""

import random
from collections import Counter

import pytest

from parityloom.llm import line_dedup

SCHEMA = "doc_id long, text string"


def test_rows_of_null_id_keep_their_own_lines(spark):
    got = {r["text"]: r["kept"] for r in line_dedup.decisions(spark.createDataFrame([(None, "x\ny"), (None, "y2\nx")], SCHEMA)).collect()}
    assert got in ({"x\ny": [0, 1], "y2\nx": [0]}, {"x\ny": [1], "y2\nx": [0, 1]})


@pytest.mark.parametrize("ids", [(None, 5), (None, 3, 3, 9), (3,)])
def test_lines_of_rows_that_share_ids(spark, ids):
    rng = random.Random(len(ids))
    words = "a b c d e f g h i j k l".split()
    rows = [(rng.choice(ids), "\n".join(" ".join(rng.sample(words, rng.choice([1, 5, 6]))) for _ in range(rng.randrange(5)))) for _ in range(60)] + [(ids[0], None), (ids[0], "")]
    rows += rows[:9]
    got = line_dedup.decisions(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    sets = [{n: frozenset(x.split()) for n, x in enumerate((r["text"] or "").split("\n")) if x.split()} for r in got]
    near = lambda s, o: 5 * len(s & o) >= 4 * len(s | o)
    key = lambda i: -(2**63) if i is None else i
    for a, (r, mine) in enumerate(zip(got, sets, strict=True)):
        assert r["kept"] == sorted(set(r["kept"])) and set(r["kept"]) <= set(mine) and r["n_lines"] == len(mine)
        for n, s in mine.items():
            before = [o for b, q in enumerate(got) if key(q["doc_id"]) < key(r["doc_id"]) for o in sets[b].values()] + [o for m, o in mine.items() if m < n]
            if any(near(s, o) for o in before):
                assert n not in r["kept"]
            # what goes has an earlier one like it: before it, or in another row of its id
            elif n not in r["kept"]:
                assert any(near(s, o) for b, q in enumerate(got) if b != a and q["doc_id"] == r["doc_id"] for o in sets[b].values())
    for i in set(ids):  # equal lines stay once in all rows of an id at most
        stay = Counter(sets[b][n] for b, q in enumerate(got) if q["doc_id"] == i for n in q["kept"])
        assert all(c == 1 for c in stay.values())
    text = line_dedup.without_later(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(text) == len(rows) and sum(len([x for x in (r["text"] or "").split("\n") if x.split()]) for r in text) == sum(len(r["kept"]) for r in got)


def test_one_row_of_each_group_of_near_copies_stays(spark):
    import corpus_pipeline

    alone = "a text that no other row has anything like in any of its many words"
    many = "one two three four five six seven eight nine ten eleven twelve"
    cases = [
        ([(None, many), (None, many), (7, many), (7, many), (None, alone)], [(7, many), (None, alone)]),
        ([(None, many), (None, many), (8, alone)], [(8, alone), (None, many)]),
        # the only one of its group has the id of another group's later copy
        ([(1, many), (2, many), (2, alone)], [(1, many), (2, alone)]),
        ([(1, many), (2, many), (3, alone)], [(1, many), (3, alone)]),
    ]
    for rows, want in cases:
        docs = spark.createDataFrame(rows, SCHEMA)
        got = corpus_pipeline.without_near_copies(spark, docs, "")
        assert got.columns == docs.columns
        assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(want)
