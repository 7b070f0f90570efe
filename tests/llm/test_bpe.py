import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from folioforge.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(library, text):
    v = bpe.vocabulary()
    want = library.encode(text, add_special_tokens=False).ids
    got = v.encode(text)
    assert [int.from_bytes(got[k:k + 4], "little") for k in range(0, len(got), 4)] == want
    assert v.decode(got) == library.decode(want, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", [
    "", " ", "a", "\n\n  \t x", "don't we'll I'M", "x<|endoftext|>y<|endoftext|>", "<|endoftext|", "日本語のテキスト" * 300,
    "a" * 5000, "ab" * 3333, " " * 1001 + "z", "=" * 999, "0123456789" * 400, "é́🙂👩‍👩‍👧 ñ\x00\x85\xa0 z", "_-" * 700])
def test_same_as_the_library(library, text):
    check(library, text)


def test_random_unsplit_texts(library):
    rng = random.Random(5)
    for _ in range(60):
        letters = rng.choice(["ab", "aeiouthnrs", "abcdefghijklmnopqrstuvwxyz", "éèñüabc", "日本語中文"])
        check(library, "".join(rng.choice(letters) for _ in range(rng.choice([129, 257, 1000, 4097]))))


def test_rows(spark):
    rows = [(1, "Hello world", 9), (1, "Hello world", 9), (None, None, 1), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.text) for r in out) == [(0, 0, ""), (1, 2, "Hello world"), (1, 2, "Hello world"), (3, 0, "")]
    assert bpe.encode(docs.limit(0)).count() == 0
