"""op12 against the tokenizer library on whole texts."""

import json
import random
import re

import pytest

from shelfwise.llm import token_counts as T

from helpers import by_id, documents, empty, sf_documents

PARTS = ["word", "Don't", "it's", "''s", "!!", "...", "<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "<|", " ", "  ", "\n\t", "\u0085",
         "é", "́", "İ", "ſ", "漢字", "ガ", "각", "가", "각", "ᆨ", "½", "１２", "3", "é", "\U0001f468‍\U0001f469", "क़",
         ";", "Ωμέγα", " ", "　", "'", "ʹ", "কা", "ﬁ", "ΑΣ", "\x00", "ạ̇"]


@pytest.fixture(scope="module")
def counter(spark):
    return T.public_counter(spark)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(library, text):
    n = len(library.encode(text or "", add_special_tokens=False))
    return len((text or "").encode()), n, n > T.LIMIT


def compare(library, docs, got):
    want = {r["doc_id"]: expected(library, r["text"]) for r in docs.collect()}
    assert {k: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for k, r in by_id(got).items()} == want


def test_odd_documents_and_table(spark, counter, library):
    compare(library, documents(spark), T.op12_token_counts(documents(spark)))
    compare(library, sf_documents(spark), T.op12_token_counts(sf_documents(spark)))


def test_random_texts_in_small_chunks(spark, counter, library):
    rng = random.Random(5)
    texts = []
    for _ in range(500):
        some = rng.sample(PARTS, rng.randint(1, len(PARTS)))
        glue = rng.choice(["", " ", "", "x"])
        texts.append(glue.join(rng.choice(some) for _ in range(rng.randint(20, 400))))
    docs = documents(spark, texts)
    for chunk, overlap in ((64, 24), (101, 40)):
        compare(library, docs, T.count_documents(docs, counter, chunk=chunk, overlap=overlap))


def test_long_runs_widen_their_overlaps(spark, counter, library, monkeypatch):
    seen = []
    real = T.splice

    def spy(texts, c, chunk, overlap):
        seen.append((chunk, overlap))
        return real(texts, c, chunk, overlap)

    monkeypatch.setattr(T, "splice", spy)
    texts = ["x" * 9000, "word " * 3000, " " * 5000, "a " * 500 + "!" * 3000 + " b" * 900, "漢" * 4000, "́" * 700, "0" * 3000]
    docs = documents(spark, texts)
    compare(library, docs, T.count_documents(docs, counter, chunk=128, overlap=32))
    assert seen[:3] == [(128, 32), (1024, 256), (8192, 2048)] and len(seen) >= 3


def test_chunks_are_encoded_apart_and_copies_once(spark, counter):
    text = "some words here and there " * 40
    pieces = T.splice(spark.createDataFrame([("k", text)] * 50, "key string, text string"), counter, 128, 32)
    rows = sorted(pieces.collect(), key=lambda r: r["k"])
    assert [r["k"] for r in rows] == list(range(-(-len(text) // 128)))
    assert rows[0]["begin"] is None and all(a["end"] == b["begin"] for a, b in zip(rows, rows[1:]))
    assert sum(r["n_tokens"] for r in rows) == 200


def test_only_marks_are_brought_together_by_document(spark, counter):
    pieces = T.splice(spark.createDataFrame([("k", "a b " * 99)], "key string, text string"), counter, 128, 32)
    lines = pieces._jdf.queryExecution().executedPlan().toString().split("\n")
    steps = [re.search(r"MapInArrow|hashpartitioning\([^)]*\)", x) for x in lines if re.search("MapInArrow|hashpartitioning", x)]
    steps = [re.sub(r"#\d+L?", "", m[0]) for m in steps]
    # from the top: marks by document, encoding, chunks dealt one by one, cutting
    assert steps == ["hashpartitioning(key, 8)", "MapInArrow", "hashpartitioning(key, k, last, at, 8)", "MapInArrow"]


def test_repeated_rows_null_ids_empty_table(spark, counter, library):
    long = "lorem ipsum " * 4000
    rows = [(None, long), (None, long), (7, long), (7, "a b"), (7, "a b"), (8, None)]
    got = T.op12_token_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(i), expected(library, t)[1]) for i, t in rows)
    assert T.op12_token_counts(empty(spark)).collect() == []


def test_files_without_a_proof_are_refused(spark, tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="normaliser"):
        T.public_counter(spark, "byte_bpe_50k.json")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    for change, said in (({"content": "<a<"}, "overlap"), ({"lstrip": True}, "around")):
        spec["added_tokens"][0].update(change)
        path = tmp_path / "t.json"
        path.write_text(json.dumps(spec))
        with pytest.raises(ValueError, match=said):
            T.TokenCounter.load(spark, str(path))


def test_remembered_words_are_forgotten_beyond_the_bound(spark, counter, library, monkeypatch):
    monkeypatch.setattr(T, "MEMO", 50)
    docs = [" ".join(f"word{i} it's{i}" for i in range(n)) for n in range(30)]
    assert [counter.counts([d])[0] for d in docs] == [expected(library, d)[1] for d in docs]
    assert sum(map(len, counter._known)) <= 50
