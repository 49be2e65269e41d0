"""Ids by chunks against those the library gives for whole texts."""

import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parityloom.llm.encoding import Encoder

PARTS = ["a", "Word", "don't", "it's", "'s", "x.", ".\n", "\n", "\n\n", " ", "  ", "\t", "é", "é", "́", "İ", "İ.", "ǅ,", "&&&", "$$", "...", "'", "''", "12", "3.5", "中文", "中.", " ", "^ ^", "^", "\r\n", "<|endoftext|>", "<", "̸", "fiﬁ", "ß!", "Σ", "Σ.", "_", "word_word", "‍", "\x1c", "ab̊?", "y" * 70]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("literal", [False, True])
def test_chunks_give_the_ids_of_whole_texts(name, literal):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS + [" "] * 12 + ["\n"] * 4, k=rng.randrange(30))) for _ in range(5_000)]
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    whole.encode_special_tokens = literal
    got = Encoder(public_tokenizers.path(name), literal).encode(texts)
    assert [x for x, g in zip(texts, got, strict=True) if array("I", whole.encode(x, add_special_tokens=False).ids).tobytes() != g] == []
