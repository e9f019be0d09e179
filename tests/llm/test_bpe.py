"""Chunked byte-level BPE against the tiktoken library, and the exact round trip."""

import hashlib
import random

import public_tokenizers
import pytest

from packetloom.llm import bpe, queries


@pytest.fixture(scope="module")
def vocabulary():
    return queries.byte_bpe()


def test_chunks_of_odd_texts(spark, vocabulary):
    rnd = random.Random(1)
    parts = ["a", "b ", " ", "\n", "é", "1", "'s", "'", "!", "  ", "日本", " the", " don't"]

    def text(n):
        return "".join(rnd.choice(parts) for _ in range(n))

    rows = [(1, None), (2, ""), (3, "hello world"), (4, "a" * 3000), (None, text(700)), (5, text(5000)), (5, text(5000))]
    rows += [(6, " " * 900), (7, "x" * 200 + " " + text(400) + "  " * 300 + "b"), (8, "<|endoftext|> hi")]
    rows += [(9 + i, text(400 + i)) for i in range(12)] + [(9, "same " * 99)] * 2
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, ids int, raw string")
    out = bpe.decode(bpe.encode(df, *vocabulary, chunk=64, overlap=32), *vocabulary).collect()
    encoding, _ = bpe._codec(*vocabulary)
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.raw)) for r in out)
    assert got == sorted((str(i), encoding.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)


def test_empty_table(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.decode(bpe.encode(df, *vocabulary), *vocabulary)).count() == 0


def test_query_against_the_library(spark, vocabulary, docs_dir):
    rows = {r.doc_id: r for r in queries.op9_byte_bpe(spark, docs_dir).collect()}
    encoding, _ = bpe._codec(*vocabulary)
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = encoding.encode_ordinary(d.text or "")
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_vocabulary_is_the_public_one(vocabulary):
    assert vocabulary[1] == public_tokenizers.PATTERN
