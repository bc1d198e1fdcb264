import re

import corpus_pipeline as C
import pytest
from helpers import DDL, ODD, by_id, documents, empty, sf_documents
from shelfwise.llm import jaccard_join as J
from shelfwise.llm import mixing as M
from shelfwise.llm import secret_ledger as S
from shelfwise.llm import toxicity as X
from test_bpe_codec import brute as tokens_of
from test_bpe_codec import reference  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_stages_are_named_and_in_order():
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "secrets", "mix", "tokens"]


def test_each_stage_against_its_operator(spark, reference):  # noqa: F811
    """Every stage on the whole output of the one before, against plain Python."""
    docs = sf_documents(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    model = X.train_on_open_rows(docs, labels)
    clean = C.toxicity(spark, docs, SF)
    want = {r["doc_id"] for r in docs.collect() if model is None or model.score(r["text"]) < 0.5}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == want
    clean = clean.cache()
    one = C.near_duplicates(spark, clean, SF).cache()
    linked = by_id(J.op3_jaccard_join(clean))
    assert one.columns == columns and sorted(r["doc_id"] for r in one.collect()) == sorted({r["component_id"] for r in linked.values()})
    safe = C.secrets(spark, one, SF).cache()
    before, after = by_id(one), by_id(safe)
    assert safe.columns == columns and set(before) == set(after)
    scan = S.scanner()
    for i, r in before.items():
        found = scan("", r["text"] or "", {x.key for x in S.RULES})[2]
        text = S.redact(r["text"], found)
        assert after[i]["text"] == text and after[i]["n_chars"] == (len(text) if found else r["n_chars"])
    mixed = C.mix(spark, safe, SF).cache()
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in M.op5_source_mix(safe).collect() if r["taken"]}
    counts = {}
    for r in mixed.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert mixed.columns == columns and counts == taken
    got = C.tokens(spark, mixed, SF).collect()
    assert len(got) == sum(taken.values())
    for r in got:
        assert tuple(r[1:]) == tokens_of(reference, after[r["doc_id"]]["text"])


def test_run_gives_the_last_stage(spark):
    rows = C.run(spark, SF).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert len({r["doc_id"] for r in rows}) <= sf_documents(spark).count()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, C.run(spark, SF).collect()))


def test_odd_rows_pass_every_stage(spark):
    docs = documents(spark, ODD)
    for name, function in C.STAGES[:-1]:
        out = function(spark, docs, SF).cache()
        assert out.columns == docs.columns, name
        assert function(spark, empty(spark), SF).collect() == [], name
        docs = out
    assert C.tokens(spark, empty(spark), SF).collect() == []
    assert all(not re.search(r"hunter2|AKIA[A-Z0-9]{16}", r["text"] or "") for r in docs.collect())
    assert {r["doc_id"] for r in docs.collect()} <= set(range(len(ODD)))


def test_columns_of_any_name_and_type_pass_every_stage(spark):
    """Names that the stages use inside, blanks, dots and quotes in names, nested and null values."""
    names = ["copies", "copy", "size", "row", "place", "findings", "blob", "key", "node", "root", "hash", "own", "every", "id", "d", "s", "z", "c",
             "__id", "__key", "__text", "__own", "__row", "__findings", "__blob", "__size", "__copy", "__n", "__d", "pending", "col", "n_chars"]
    extra = ", ".join(f"concat('{n}', doc_id) AS `{n}`" for n in names)
    docs = documents(spark, ODD).select("doc_id", "text", "lang", "source").selectExpr(
        "*", extra.split(", concat")[0], *("concat" + x for x in extra.split(", concat")[1:]), "named_struct('a b', doc_id, 'x.y', null) AS `a b`",
        "map('k', doc_id) AS `m.n`", "array(null, text) AS `t``u`", "cast(doc_id AS decimal(20,3)) AS dec", "timestamp_seconds(doc_id) AS at", "cast(null AS binary) AS bin")
    before = {r["doc_id"]: r.asDict(True) for r in docs.collect()}
    model = X.train_on_open_rows(sf_documents(spark), spark.read.parquet(f"{SF}/labels.parquet"))
    for name, function in C.STAGES[:-1]:
        out = (X.drop_toxic(docs, model) if name == "toxicity" else function(spark, docs, SF)).cache()
        assert out.dtypes == docs.dtypes, name
        got = [r.asDict(True) for r in out.collect()]
        assert got or name == "toxicity"
        for r in got:
            changed = {"text"} if name in ("secrets", "mix") else set()
            assert {k: v for k, v in r.items() if k not in changed} == {k: v for k, v in before[r["doc_id"]].items() if k not in changed}, name
        docs = out
    assert C.tokens(spark, docs, SF).count() == docs.count()


def test_redacted_texts(spark):
    docs = spark.createDataFrame([(1, "token=abcdefgh end", "en", "s", 18, "b", "k", "n"), (2, None, "en", "s", None, "b", "k", "n")], DDL)
    got = by_id(S.redact_documents(docs))
    assert got[1]["text"] == "[assign] end" and got[1]["n_chars"] == 12 and got[2]["text"] is None


@pytest.mark.parametrize("name", ["pipeline", *[f"op{n}_" for n in range(1, 14)]])
def test_registered(name):
    import __spark_entry__ as E

    assert any(q == name or q.startswith(name) for q in E.queries())
