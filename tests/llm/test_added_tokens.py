"""Texts that hold added tokens, against a tokenizer as its file gives it."""

import random
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from parityloom.llm import queries
from parityloom.llm.encoding import Encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ROWS = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "plain words only."), (4, "x<|startoftext|><|endoftext|>  y \n<|endoftext|>"), (5, None), (6, " <|endoftext |> <|ENDOFTEXT|>, <|<|endoftext|>|>"), (7, "after")]


def untouched(name):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer(name))
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def crc(ids):
    return crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", FILES)
def test_added_tokens_in_any_surroundings(name):
    rng, encode = random.Random(11), untouched(name)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\t", "word", "It's", "é", "É", "😀", ",", ".", "x.", " the", "12", " "]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(3000)] + [t or "" for _, t in ROWS]
    got = [np.frombuffer(x, "<u4").tolist() for x in Encoder(queries.tokenizer(name), literal=False).encode(texts)]
    assert got == [encode(t) for t in texts]


def test_queries_give_added_tokens_their_ids(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    encode = untouched(FILES[0])
    want = {i: crc([*encode(t), 0]) for i, t in ROWS}
    # the rests are short: at most the last window cuts one, so ids are compared where a piece is a whole document
    for rows in (queries.op3_packing(spark, str(tmp_path)).collect(), corpus_pipeline.packed(spark, docs, "").selectExpr("*", "crc32(ids) AS ids_crc32").collect()):
        assert {r["doc_id"]: r["doc_tokens"] for r in rows} == {i: len(encode(t)) + 1 for i, t in ROWS}
        whole = [r for r in rows if r["length"] == r["doc_tokens"]]
        assert len(whole) >= 3 and all(r["ids_crc32"] == want[r["doc_id"]] for r in whole)
    encode, start = untouched(FILES[1]), 0
    got = {r["doc_id"]: r for r in queries.op7_token_file(spark, str(tmp_path)).collect()}
    for i, t in ROWS:
        ids = [*encode(t), 2]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
