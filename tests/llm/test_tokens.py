"""Encoding against the public library and exact round trips."""

import random
from pathlib import Path

import pytest

from plotweave.llm import tokens

FOLDER = Path(tokens.TOKENIZERS)
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no vocabulary files")
TEXTS = [None, "", " ", "\n", "<|endoftext|> hi", "a\r\n\r\n  b\n\n\n c  \n", "x" * 5000, "　\n \xa0\n日本語 don't I'LL we've\t\t\n", "é́👩‍👩‍👧 ​ ﻿",
         "\x85\n a\x0b\n b c\n", "'s\n's", "a\0b \0\n\0", "1²３Ⅳ½", "0123456789 " * 900]


@pytest.fixture(scope="module")
def codec():
    return tokens.Codec(str(FOLDER / "byte_bpe_50k.json"), memo=500)


def test_same_as_the_library(codec):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(str(FOLDER / "byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rng = random.Random(1)
    letters = list(" \n\t\r'sdtré日①1​\xa0 .-#🙂A\x1c\x85ñ한ﬁ")
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    got = codec.encode_batch(texts)
    assert got[:2] == [[], []]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [codec.decode(x) for x in got] == [t or "" for t in texts]


def test_rank_file(codec):
    other = tokens.Codec(str(FOLDER / "byte_bpe_50k.tiktoken"))
    assert other.encode_batch(TEXTS) == codec.encode_batch(TEXTS)


def test_corpus(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(df).collect()}
    codec = tokens.Codec(str(FOLDER / "byte_bpe_50k.json"))
    assert got == {i: codec.encode(t) for i, t in enumerate(TEXTS)}
    assert tokens.encode_corpus(df.limit(0)).count() == 0


def test_every_document(spark, tiny):
    """All documents of the smallest test data and, in pieces, of the next."""
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(str(FOLDER / "byte_bpe_50k.json"))
    library.encode_special_tokens = True
    for folder in (tiny, tiny.replace("0.001", "0.01")):
        if not Path(folder).exists():
            continue
        documents = spark.read.parquet(f"{folder}/documents.parquet")
        texts = {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
        got = {r.doc_id: r.ids for r in tokens.encode_corpus(documents).collect()}
        order = sorted(texts)
        want = library.encode_batch([texts[i] for i in order], add_special_tokens=False)
        assert got == {i: w.ids for i, w in zip(order, want)} and len(got) == len(order)
