import hashlib
import os

import numpy as np
from helpers import ODD, by_id, documents, empty, sf_documents
from shelfwise.llm import fingerprints as FP


def check(df):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), reverse=True)
    got = by_id(FP.op10_fingerprints(df))
    assert len(got) == len(rows)
    for at, (i, text) in enumerate(rows):
        nxt = rows[(at + 1) % len(rows)][1]
        m = len(text) // 3
        edited = text[:len(text) - m] + nxt[:m]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == FP.Fingerprint(text).value and r["edited_fingerprint"] == FP.Fingerprint(edited).value
        assert r["common_edited"] == len(os.path.commonprefix([text, edited])) and r["common_next"] == len(os.path.commonprefix([text, nxt]))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text == nxt:
            assert r["near_next"] == 1
    return got


def test_against_brute_force(spark):
    got = check(sf_documents(spark))
    long = [r for r in got.values() if r["n_chars"] > 500]
    assert np.mean([r["near_edited"] for r in long]) > 0.5 > 0.2 > np.mean([r["near_next"] for r in long])


def test_odd_texts_and_order(spark):
    check(documents(spark, ODD).repartition(5))
    check(documents(spark, ["only one document"]))
    assert FP.op10_fingerprints(empty(spark)).collect() == []


def test_repeated_ids_and_null_ids(spark):
    docs = documents(spark, ["a b c", "d e f"]).unionByName(documents(spark, ["a b c", "other"]))
    nulls = docs.selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars", "blob", "key", "node")
    assert FP.op10_fingerprints(docs.unionByName(nulls)).count() == 8


def test_spans_and_extension():
    text = "abracadabra abracadabra cadabra"
    p = FP.PrefixHash(FP.codes_of(text))
    for i in range(len(text)):
        for j in range(len(text)):
            assert p.extension(i, p, j) == len(os.path.commonprefix([text[i:], text[j:]]))
            for w in (1, 3, 7):
                if max(i, j) + w <= len(text):
                    assert (p.span(i, i + w) == p.span(j, j + w)) == (text[i:i + w] == text[j:j + w])
    width5 = p.spans(5)
    assert len(width5) == len(text) - 4 and width5[0] == width5[12]


def test_likeness():
    a, b, c = (FP.Fingerprint(t).value for t in ("x y z " * 50, "x y z " * 50, "entirely different words here, none shared at all"))
    assert FP.likeness(a, b) == 1 and FP.likeness(a, c) == 0
    none = FP.Fingerprint("").value
    assert FP.likeness(none, none) == 1 and FP.likeness(none, a) == 0
