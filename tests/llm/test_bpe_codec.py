import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from helpers import ODD, by_id, documents, empty, sf_documents
from shelfwise.llm import bpe_codec as B


@pytest.fixture(scope="module")
def reference():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(reference, text):
    ids = reference.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def odd_long(n=60):
    rng = random.Random(3)
    parts = ["word", " ", "  ", "\n", "\n\n", "'s", "'", "12", "é", "漢字", "😀", " ", "!!", "\t", " don't", "x" * 40, " " * 30]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(50, 400))) for _ in range(n)] + ["a" * 500, " " * 500, "ab " * 300 + "z" * 300 + " c" * 100]


def check(df, reference, **sizes):
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    got = by_id(B.digest_documents(df, B.public_codec(df.sparkSession), **sizes))
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert tuple(got[i][1:]) == brute(reference, t), repr(t)[:200]


def test_whole_table(spark, reference):
    check(sf_documents(spark), reference)


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (100, 30), (300, 140)])
def test_chunked_texts_stitch_exactly(spark, reference, chunk, overlap):
    check(documents(spark, ODD + odd_long()), reference, chunk=chunk, overlap=overlap)


def test_ids_and_round_trip(spark, reference):
    docs = documents(spark, ODD + odd_long(10))
    codec = B.public_codec(spark)
    ids = B.encode_documents(docs, codec, 100, 20)
    got = by_id(ids)
    raw = by_id(B.decode_documents(ids, codec))
    for r in docs.collect():
        assert got[r["doc_id"]]["ids"] == reference.encode_ordinary(r["text"] or "")
        assert bytes(raw[r["doc_id"]]["bytes"]).decode() == (r["text"] or "")


def test_empty_table(spark):
    assert B.op6_byte_bpe(empty(spark)).collect() == []
