import zlib

import numpy as np
from helpers import ODD, by_id, documents, empty
from shelfwise.llm import langid as L


def brute_features(text):
    raw = bytes(b if 97 <= b < 123 or b >= 128 else 32 for b in text.lower().encode())
    raw = b" " + raw + b" "
    out = np.zeros(L.FEATURES)
    for i in range(len(raw) - 1):
        two = raw[i] * 256 + raw[i + 1]
        if two != 0x2020:
            out[L.TRIGRAMS + ((two * 2654435761) % 2**32 >> 19)] += 1
        if i + 2 < len(raw):
            three = two * 256 + raw[i + 2]
            if three != 0x202020:
                out[(three * 2654435761) % 2**32 >> 17] += 1
    return out


def test_features_against_brute_force(monkeypatch):
    for text in [*filter(None, ODD), "", "Ünï 12 straße", "x"]:
        assert np.array_equal(L.features(text), brute_features(text)), text[:50]
    monkeypatch.setattr(L, "PIECE", 7)
    for text in ["the quick brown fox jumps", "a b c d e f g h i j", "日本語のテキスト", "exactly"]:
        assert np.array_equal(L.features(text), brute_features(text)), text


def test_codewords_differ_in_many_bits():
    for k in (2, 3, 4, 7, 8, 30):
        codes = L.codewords(k)
        distance = min((codes[i] != codes[j]).sum() for i in range(k) for j in range(i))
        assert distance >= (2 ** (k - 2) if k <= 7 else 5)
        assert all(abs(c.sum()) < k for c in codes.T)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = by_id(L.op7_language_id(docs))
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r["held_out"]} == {r["doc_id"] for r in held}
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_wrong_bits_are_outvoted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    model = L.train(L.count_ngrams(docs))
    margins = model.codes[2].copy()
    margins[0] *= -0.3      # one bit wrong
    loss = (model.trust * np.maximum(0, 1 - model.codes * margins) ** 2).sum(axis=1)
    assert loss.argmin() == 2


def test_odd_tables(spark):
    docs = documents(spark, [*ODD, "123 !!! 456", None, "é"])
    got = by_id(L.op7_language_id(docs))
    for r in docs.collect():
        letter = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (got[r["doc_id"]]["lang_pred"] == "und") == (not letter)
    assert L.op7_language_id(empty(spark)).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    assert {r["lang_pred"] for r in L.op7_language_id(unlabelled).collect()} == {"und"}


def test_lang_source_and_id_are_no_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.train(L.count_ngrams(docs))
    a = {r["text"]: r["lang_pred"] for r in L.identify(docs.selectExpr("doc_id", "text"), model).join(docs.select("doc_id", "text"), "doc_id").collect()}
    assert all(model.predict(t)[0] == p for t, p in list(a.items())[:50])
