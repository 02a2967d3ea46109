from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vendaval.llm.tokens import Counter, read_merges, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDGES = [
    "",
    "a",
    "<|endoftext|>",
    "a<|endoftext|><|endoftext|> b",
    "  \n\n x  y z　 ",
    "I'll we've 'S 123٣٤ ½ ２",
    "a" * 5000,
    "日本語 한국어 \U0001f600\U0001f600 é",
    "\x00\x1f﻿",
    "x\r\n\r\n  y\t\tz",
    "!!!???...---",
    " " * 300 + "a",
    " a\u0085b",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_edges_and_random_text(library):
    counter, chance = Counter(read_merges(PATH), memory=50), random.Random(3)

    def letter():
        return chr(chance.choice([chance.randrange(1, 256), chance.randrange(0x300, 0x3000), 32, 10, 97]))

    for text in [*EDGES, *("".join(letter() for _ in range(150)) for _ in range(300))]:
        assert counter.count(text) == library(text), text[:80]


def test_whole_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts(docs, PATH).collect():
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), library(text))
        assert r.over_limit == (r.n_tokens > 512)


def test_odd_rows(documents, odd_rows, library):
    found = token_counts(documents(odd_rows, clashing=True), PATH).collect()
    wanted = sorted((str(i), library(t or "")) for i, t in odd_rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == wanted
    assert token_counts(documents([]), PATH).collect() == []


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        read_merges(public_tokenizers.path("word_bpe_49k.json"))
