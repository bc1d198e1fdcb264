import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import ODD, documents, empty, sf_documents
from pyspark.sql import functions as F
from shelfwise.llm import mixing as M


def water_fill(sizes, weights, most):
    total, fixed = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in fixed)
        w = sum(weights[s] for s in sizes if s not in fixed)
        if not w:
            return {s: most * sizes[s] for s in sizes}
        level = rest / w
        new = {s for s in sizes if s not in fixed and most * sizes[s] < weights[s] * level}
        if not new:
            return {s: most * sizes[s] if s in fixed else weights[s] * level for s in sizes}
        fixed |= new


def check(df):
    docs = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in df.collect()]
    sizes = defaultdict(int)
    for _, s, n in docs:
        sizes[s] += n
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    targets = water_fill(sizes, {s: 1 + i % 3 for i, s in enumerate(order)}, 3)
    got = M.op5_source_mix(df).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(docs)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]], abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] + 1e-6, s
    return got


def test_targets_and_words(spark):
    assert sorted(map(tuple, check(sf_documents(spark)))) == sorted(map(tuple, check(sf_documents(spark).repartition(3))))


def test_odd_sources(spark):
    check(documents(spark, ODD * 4))
    texts = ["w " * n for n in (1, 2, 3, 500, 7, 9, 0, 4)]
    docs = documents(spark, texts).withColumn("source", F.expr("CASE doc_id WHEN 3 THEN 'big' WHEN 0 THEN null WHEN 6 THEN 'empty' ELSE concat('s', doc_id % 2) END"))
    check(docs)
    assert M.op5_source_mix(empty(spark)).collect() == []


def test_equal_rows_round_apart(spark):
    docs = documents(spark, ["a b c"]).selectExpr("1L doc_id", "text", "'x' source").unionByName(documents(spark, ["q " * 30]).selectExpr("2L doc_id", "text", "'y' source"))
    many = docs.where("doc_id = 1").withColumn("e", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("e").unionByName(docs.where("doc_id = 2"))
    check(many)


def brute_group(docs):
    """Same pairing in plain Python."""
    out, (cid, cp, cs) = {}, docs[0][1:]
    for u, i, p, s in docs[1:]:
        up, down = min((1 - cp) * cs, p * s), min(cp * cs, (1 - p) * s)
        rise = u * (up + down) < down
        if rise:
            cp, p = cp + up / cs, p - up / s
            done_c = (1 - cp) * cs <= 1e-9 * cs
        else:
            cp, p = cp - down / cs, p + down / s
            done_c = cp * cs <= 1e-9 * cs
        if done_c:
            out[cid] = round(cp)
            cid, cp, cs = i, p, s
        else:
            out[i] = round(p)
    return out, cid, cp, cs


def test_group_against_brute_force(spark):
    rng = random.Random(1)
    groups = [sorted((rng.random(), i, rng.uniform(0.05, 0.95), rng.randrange(1, 500)) for i in range(n)) for n in (1, 2, 3, 50)]
    df = spark.createDataFrame([(g, d) for g, d in enumerate(groups)], "g int, docs array<struct<u:double,id:bigint,p:double,size:bigint>>")
    for r in df.select("g", M.round_group(F.col("docs"), "bigint").alias("r")).collect():
        out, cid, cp, cs = brute_group(groups[r["g"]])
        assert {o["id"]: o["take"] for o in r["r"]["out"]} == out
        assert r["r"]["cid"] == cid and r["r"]["cs"] == cs and r["r"]["cp"] == pytest.approx(cp, abs=1e-9)


def test_tree_keeps_words_and_expectations(spark):
    docs = spark.range(3000).selectExpr("cast(id % 2 as string) source", "id", "0.1 + 0.8 * pmod(id * 37, 101) / 101 p", "1 + pmod(id * 13, 300) size")
    want = {r[0]: (r[1], r[2]) for r in docs.groupBy("source").agg(F.sum(F.col("p") * F.col("size")), F.max("size")).collect()}
    hits = Counter()
    for seed in (10, 1000, 5000):
        got = M.dependent_rounding(docs, seed, group=20).join(docs.drop("source"), "id").collect()
        assert len(got) == 3000
        for s, (words, most) in want.items():
            assert abs(sum(r["take"] * r["size"] for r in got if r["source"] == s) - words) <= most
        hits.update(r["p"] > 0.5 for r in got if r["take"])
    assert hits[True] > 2 * hits[False]


def test_mix_repeats_whole_rows(spark):
    docs = sf_documents(spark)
    want = {r["doc_id"]: r["taken"] // r["size"] for r in M.op5_source_mix(docs).collect() if r["taken"]}
    mixed = M.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == want


def test_no_python_in_the_plan(spark):
    plan = M.op5_source_mix(sf_documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
