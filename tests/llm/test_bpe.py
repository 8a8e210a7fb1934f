from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from zoneflow.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
TEXTS = [
    None, "", " ", "hello world", "Hello  world\n\n\t tabs", "schön über größer ñandú été", "日本語のテキスト 中文", "<|endoftext|>",
    "x" * 3000, "ab" * 400 + "#" * 200 + "\n" * 300, "don't we'll 12345 67890123456", "a\u0300 👩‍👩‍👧 \u200b\xa0z", "hello world",
    " ".join(f"word{i}" for i in range(20_000)),
]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_round_trip_against_library(spark, reference):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "hello")], "doc_id long, text string").withColumn("ids", F.lit("x"))
    got = {r.doc_id: r for r in bpe.round_trip(docs, RANKS, PATTERN).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, text in [*enumerate(TEXTS), (None, "hello")]:
        ids = reference.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_encode_and_decode_keep_other_columns(spark, reference):
    docs = spark.createDataFrame([(i, t, "s", i) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens string, w int")
    encoded = bpe.encode_documents(docs, RANKS, PATTERN)
    assert encoded.columns == ["doc_id", "n_tokens", "w", "ids"]
    rows = {r.doc_id: r.ids for r in encoded.collect()}
    assert rows == {i: reference.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    decoded = {r.doc_id: bytes(r.data) for r in bpe.decode_documents(encoded, RANKS, PATTERN).collect()}
    assert decoded == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    empty = docs.limit(0)
    assert bpe.encode_documents(empty, RANKS, PATTERN).collect() == []
    assert bpe.round_trip(empty, RANKS, PATTERN).collect() == []


def test_random_pieces_and_a_store_that_overflows(reference, monkeypatch):
    monkeypatch.setattr(bpe, "STORE", 300)
    codec = bpe.Codec(RANKS, PATTERN)
    rng = random.Random(1)
    for _ in range(30):
        texts = ["".join(rng.choice("abcdeéßnt  's0123.,\n") for _ in range(rng.randrange(400))) for _ in range(8)]
        encoded = codec.encode(texts)
        assert [np.frombuffer(e, "<u4").tolist() for e in encoded] == [reference.encode_ordinary(t) for t in texts]
        assert codec.decode(encoded) == [t.encode() for t in texts]


def test_recursion_and_heap_agree():
    codec = bpe.Codec(RANKS, PATTERN)
    rng = random.Random(2)
    for _ in range(200):
        piece = "".join(rng.choice("theaniog") for _ in range(rng.randrange(2, 100)))
        codec.store.clear()
        codec.learn({piece})
        ids = np.frombuffer(codec.store[piece], "<u4").tolist()
        if len(ids) > 1:
            assert ids == codec.contract(piece.encode())
