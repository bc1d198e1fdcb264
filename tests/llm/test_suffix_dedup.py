import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, documents, empty, sf_documents
from shelfwise.llm import suffix_dedup as D


def brute(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        cover = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                cover[i:i + length] = True
        kept = bytes(b for b, c in zip(r, cover, strict=False) if not c)
        spans = int((cover[:-1] & ~np.concatenate([[False], cover[:-2]])).sum()) if len(r) else 0
        out.append((len(r), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(df):
    rows = df.collect()
    want = Counter((r["doc_id"], *w) for r, w in zip(rows, brute([r["text"] for r in rows]), strict=True))
    got = Counter(tuple(r) for r in D.op8_suffix_dedup(df).collect())
    assert got == want, [(k, want.get(k)) for k in (got - want)][:3] + list((want - got))[:3]


def pieces(seed, n=60):
    rng = random.Random(seed)
    prose = lambda k: "".join(rng.choice("abcdé fgh\n") for _ in range(k))
    shared = [prose(k) for k in (150, 199, 201, 260, 420, 900)]
    return ["".join(rng.choice([prose(rng.randrange(5, 300)), rng.choice(shared)]) for _ in range(rng.randrange(1, 6))) for _ in range(n)]


def test_suffix_array_and_prefixes_against_sorting():
    rng = random.Random(2)
    for alphabet, n in [("a", 40), ("ab", 1), ("ab", 60), ("abc", 400), ("abracadabra", 800), ("aaaaab", 300), ("mississippi", 11)] * 3:
        s = "".join(rng.choice(alphabet) for _ in range(n)) if rng.random() < 0.7 else alphabet * (n // len(alphabet))
        text = np.array([ord(c) - 96 for c in s] + [0], dtype=np.uint16)
        got = D.suffix_array(text)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert got.tolist() == want, s
        prefixes = D.permuted_prefixes(text, got, 25)
        for a, b in zip(want, want[1:], strict=False):
            x, y = text[a:].tolist(), text[b:].tolist()
            common = next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            assert prefixes[b] == min(common, 25)


def test_suffix_array_of_many_names():
    rng = np.random.default_rng(3)
    text = np.append(np.tile(rng.integers(1, 250, 4000), 2), 0).astype(np.uint16)
    want = sorted(range(len(text)), key=lambda i: tuple(text[i:i + 4100].tolist()))
    assert D.suffix_array(text).tolist() == want


def test_anchors_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 700)
    raw = pieces(4, 1)[0].encode() * 9 + b"x" * 600
    _, _, first, last = D.anchors(raw)
    assert [i for a, b in zip(first, last, strict=True) for i in range(a, b + 1)] == list(range(len(raw) - 199))


def test_repeated_starts_within_and_across():
    a, b = b"q" * 210, bytes(range(32, 127)) * 5
    got = D.repeated_starts([a, b[:300], b[40:320], b"short"])
    assert got[0].tolist() == list(range(11))
    whole = Counter(s[i:i + 200] for s in (a, b[:300], b[40:320]) for i in range(len(s) - 199))
    assert got[1].tolist() == [i for i in range(101) if whole[b[i:i + 200]] > 1]


def test_whole_table(spark):
    check(sf_documents(spark))


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed):
    check(documents(spark, pieces(seed) + ODD + ["p " * 300, "p " * 300 + "end", "z" * 200, "z" * 199]))


def test_repeated_rows_and_empty(spark):
    docs = documents(spark, pieces(7, 8) + [None, ""])
    check(docs.unionByName(docs.limit(4)))
    assert D.op8_suffix_dedup(empty(spark)).collect() == []


def test_groups_beyond_a_shard(spark):
    """The same result when every group is resolved by counting windows."""
    docs = documents(spark, pieces(9, 30))
    a, b = ({(r["digest"], s) for r in D.repeated_spans(docs, k)[1].groupBy("digest").agg(D.F.collect_list(D.F.struct("first", "end")).alias("s")).collect()
             for s in D.merge_spans(r["s"])} for k in (8000, 0))
    assert a == b and a


def test_kept_bytes(spark):
    docs = documents(spark, pieces(5, 20))
    want = {(r["doc_id"], r["kept_sha256"]) for r in D.op8_suffix_dedup(docs).collect()}
    assert {(r["doc_id"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in D.remove_repeats(docs).collect()} == want
