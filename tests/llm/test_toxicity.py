import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from helpers import ODD, by_id, documents, empty
from shelfwise.llm import toxicity as X

SF = "/root/testdata/sf0.01"
INSULTS = ["wretch", "numbskull", "dimwit", "halfwit"]


@pytest.fixture(scope="module")
def tables(spark):
    """Clean prose of the table, half of it with insults put in."""
    prose = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(400).collect() if r["text"]]
    rows, labels = [], []
    for i, t in enumerate(prose):
        words = t.split()[:150]
        toxic = i % 3 == 0
        if toxic:
            words[len(words) // 2:len(words) // 2] = [INSULTS[i % 4], "x"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(tables):
    return X.train_on_open_rows(*tables)


def brute_kernel(s: bytes, t: bytes):
    """All subsequences of bounded span, counted one by one."""
    def count(w):
        codes = [X._EDGE, *(int(X._CLASS[b]) for b in w), X._EDGE]
        out = defaultdict(float)
        for at in combinations(range(len(codes)), X.ORDER):
            if at[-1] - at[0] < X.SPAN:
                out[tuple(codes[i] for i in at)] += X.DECAY ** (at[-1] - at[0] + 1)
        return out
    a, b = count(s), count(t)
    return sum(v * b[u] for u, v in a.items() if u in b) / (X._norm(len(s)) * X._norm(len(t)))


def test_kernel_against_brute_force():
    words = [b"idiot", b"idxiot", b"i", b"ab", b"moron", b"worthless", b"tion"]
    got = X.kernel(words, words)
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert got[i, j] == pytest.approx(brute_kernel(s, t), abs=1e-6)
    assert got[0, 1] > 3 * got[0, 4]        # an inserted letter hurts little


def test_words():
    assert X.words_of("I d i o t! i.d.i.o.t M*O*R*O*N a b") >= {b"idiot", b"moron"}
    assert X.words_of(None) == X.words_of(" ... ") == set()
    long = X.words_of("y" * 100)
    assert all(len(w) <= X.LONGEST for w in long) and long


def test_held_out_accuracy(spark, tables, model):
    docs, labels = tables
    got = by_id(X.score_documents(docs, model))
    held = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = [(got[r["doc_id"]]["score"] >= 0.5) == bool(r["toxic"]) for r in held]
    assert sum(right) >= 0.97 * len(right)


def test_gapped_and_inserted_insults(model):
    clean = "the rain falls over quiet hills and "
    for w in ("dimwit", "d.i.m.w.i.t", "d i m w i t", "dim*wit", "diimwit", "dimxwit", "num-bskull", "numbbskull", "WRETCH"):
        assert model.score(clean + w) >= 0.5, w
    for w in ("hills", "witness", "number", "skulls are", "stretcher"):
        assert model.score(clean + w) < 0.5, w


def test_an_insult_at_the_end_of_a_long_text(model):
    assert model.score("meadow river stone " * 20000 + "numbskull") >= 0.5
    assert model.score("meadow river stone " * 20000) < 0.5


def test_query_on_the_given_tables(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = by_id(X.op4_toxicity(docs, labels))
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"]]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.5)


def test_odd_tables(spark, tables):
    docs, labels = tables
    odd = documents(spark, ODD, start=100000)
    some = labels.unionByName(spark.createDataFrame([(None, 1), (5, None), (3, 1), (3, 0), (999999, 1)], "doc_id long, toxic int"))
    both = docs.unionByName(odd.select("doc_id", "text")).unionByName(docs.where("doc_id < 5")).withColumn("toxic", docs["doc_id"])
    assert len(X.op4_toxicity(both, some).collect()) == both.count()
    assert X.op4_toxicity(empty(spark), labels).collect() == []
    none = X.op4_toxicity(odd, labels.where("toxic = 0")).collect()
    assert len(none) == len(ODD) and {r["score"] for r in none} == {0.0}


def test_witnesses_cover_documents_not_counts():
    pairs = [(d, b"bad") for d in range(10)] + [(d, b"copy") for d in range(4)] + [(d, b"copy2") for d in range(4)] + [(20 + d, b"other") for d in range(5)]
    assert set(X.witnesses(pairs, 15)) >= {b"bad", b"other"}
    assert b"copy2" not in X.witnesses(pairs, 15)


def test_machine_separates(model):
    assert model.table.shape == (X.SLOTS,) and np.isfinite(model.table).all()


def test_sentences_and_phrases():
    assert X.sentences_of("Kick the b*ucket. Now!  go\nhome you") == [[b"kick", b"the", b"bucket"], [b"home", b"you"]]
    assert X.phrases_of("Kick the b*ucket. Now go") == {b"kick the", b"the bucket", b"kick the bucket", b"now go"}
    assert X.phrases_of(None) == X.phrases_of("one") == set()
    words = [f"w{i}" for i in range(5001)]
    assert len(X.phrases_of(" ".join(words))) == 5000 + 4999


def test_running_sums_against_phrases_one_by_one():
    rng = np.random.default_rng(3)
    m = X.ToxicityModel(rng.normal(size=X.SLOTS).astype(np.float32) / 50, 0.1)
    texts = ["purple ladder of rain. it is", None, "a", "a b", "so it goes " * 9000 + "purple ladder", "x" * 50 + " yes no"]
    for text, (margin, phrase) in zip(texts, m.worst_phrase(texts), strict=True):
        ps = sorted(X.phrases_of(text))
        want = np.clip(X.table_scores(ps, m.table) + m.bias, m.lowest, 2.0) if ps else [m.lowest]
        assert margin == pytest.approx(max(want), abs=1e-6)
        assert not ps or want[ps.index(phrase)] == pytest.approx(margin, abs=1e-6)


@pytest.mark.parametrize("insults", [False, True])
def test_toxic_phrases_of_clean_words(spark, tables, insults):
    """Documents that are toxic through words which clean sentences hold as well."""
    clean = [r["text"] for r in tables[0].orderBy("doc_id").collect() if r["doc_id"] % 3]
    rows, labels = [], []
    for i, t in enumerate(clean):
        words = t.split()[:100]
        half, toxic = len(words) // 2, i % 3 == 0
        parts = [["purple", "ladder"], ["eat", "your", "boots"]][i % 2] if toxic else ["purple rain", "your ladder", "boots", "eat"]
        if insults and toxic and i % 4 == 0:
            parts = [INSULTS[i % 3]]
        words[half:half] = parts if toxic else [parts[i % 4], "and", parts[(i + 1) % 4]]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = by_id(X.op4_toxicity(docs, marks))
    held = [(i, y) for i, y in labels if got[i]["held_out"]]
    right = [got[i]["predicted"] == y for i, y in held]
    assert any(y for _, y in held) and sum(right) >= 0.95 * len(right)
    model = X.train_on_open_rows(docs, marks)
    assert model.score("quiet hills and purple ladder of rain") >= 0.5
    assert model.score("quiet hills and pur-ple laadder of rain") >= 0.5
    assert model.score("quiet ladder and hills purple") < 0.5 and model.score("it was purple. Ladder and rain") < 0.5


def test_boundary():
    assert X.boundary(np.array([0.0, 0.2, 1.0, 1.2]), np.array([0, 0, 1, 1])) == pytest.approx(0.4)
    assert X.boundary(np.array([0.0, 0.2, 0.3, 1.0, 1.2]), np.array([0, 1, 0, 1, 1])) == pytest.approx(0.475)
    assert X.boundary(np.array([0.5, 0.5]), np.array([0, 1])) != 0.5      # equal margins stay on one side
