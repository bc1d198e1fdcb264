"""Bitmaps of repeated hashes, and profiles merged from stored states."""

import random

import numpy as np
import pytest

from shelfwise.operators import clean as C
from shelfwise.operators import profile as P
from shelfwise.operators import repeats as R
from shelfwise.operators import sketches as S
from tests.conftest import rows


def test_single_rows_are_dropped_and_no_repeated_one(spark):
    df = spark.range(40_000).selectExpr("if(id < 200, id div 2, id) AS k", "concat('t', if(id < 200, id div 2, id)) AS t", "id AS own")
    left = R.maybe_repeated(df, ["t"])
    kept = {r[0] for r in left.select("own").collect()}
    assert set(range(200)) <= kept and len(kept) < 300 and left.columns == df.columns
    assert sorted(r[0] for r in P.duplicate_rows(df, "t").select("own").collect()) == list(range(200))


def test_a_full_bitmap_keeps_rows_and_results(spark, monkeypatch):
    """With few slots nearly all bits are set: more rows stay, the result is the same."""
    monkeypatch.setattr(R, "SLOTS", 16)
    data = [(random.Random(i).choice("abcdefgh") if i % 3 else f"single{i}", i) for i in range(300)] + [(None, 900), (None, 901), ("alone", 902)]
    df = spark.createDataFrame(data, "t string, i int")
    seen = {}
    for v, i in data:
        seen.setdefault(v, []).append(i)
    want = sorted(i for ids in seen.values() if len(ids) > 1 for i in ids)
    assert sorted(r[0] for r in P.duplicate_rows(df, "t").select("i").collect()) == want
    assert R.maybe_repeated(df, ["t"]).count() >= len(want)


def test_every_slot_of_the_bitmap_is_found(spark, monkeypatch):
    """All bit positions and several buckets."""
    monkeypatch.setattr(R, "SLOTS", 1 << 17)
    df = spark.range(60_000).selectExpr("id div 2 AS v", "id")
    assert R.repeated_slots(df, ["v"]).count() == 4
    assert R.maybe_repeated(df, ["v"]).count() == 60_000


def test_report_of_repeated_rows(spark):
    data = [("a", 1, None), ("a", 1, None), ("a", 2, None), (None, None, 0.0), (None, None, -0.0), ("b", 1, float("nan")), ("b", 1, float("nan"))]
    df = spark.createDataFrame(data, "`t x` string, v int, d double")
    assert sorted(r["copies"] for r in C.duplicates_report(df).collect()) == [2, 2, 2]
    assert {r["t x"]: r["copies"] for r in C.duplicates_report(df, ["t x"]).collect()} == {"a": 3, None: 2, "b": 2}
    assert C.duplicates_report(df.limit(0)).count() == 0


def test_only_the_bitmap_is_broadcast_by_order(spark):
    df = spark.range(100).selectExpr("concat('t', id) AS t", "id")
    plan = P.duplicate_rows(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    hinted = [x for x in plan.split("\n") if "strategy=broadcast" in x or "rightHint" in x]
    assert len(hinted) <= 2 and all("_bucket" in x for x in hinted)


def states(spark, parts, path):
    for i, part in enumerate(parts):
        S.profile_states(part, f"s{i}").write.mode("append").parquet(path)
    return spark.read.schema(S.STATE).parquet(path)


def test_merged_states_equal_the_profile_of_the_union(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=5000) + 1e8
    data = [(float(v), int(i % 700), None if i % 4 == 0 else f"name {i % 1234}", bool(i % 3), None) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "x double, k int, t string, b boolean, nothing double")
    parts = [df.where("k < 10"), df.where("k >= 10 AND k < 400"), df.where("k >= 400"), df.limit(0)]
    merged = {r["column"]: r for r in S.merged_profile(states(spark, parts, str(tmp_path / "s"))).collect()}
    exact = {r["column"]: r for r in P.table_profile(df).collect()}
    for c, m in merged.items():
        e = exact[c]
        assert (m["count"], m["nulls"], m["dtype"]) == (e["count"], e["nulls"], e["dtype"])
        assert m["distinct"] == pytest.approx(e["distinct"], rel=0.05)
        if c in ("x", "k", "b"):
            assert m["mean"] == pytest.approx(e["mean"]) and m["std"] == pytest.approx(e["std"], rel=1e-6)
            assert float(m["min"]) == float(e["min"]) and float(m["max"]) == float(e["max"])
        else:
            assert (m["min"], m["max"], m["mean"], m["std"]) == (e["min"], e["max"], None, None)


def test_estimates_over_many_states(spark, tmp_path):
    """Values shared by the states count once; the error keeps its bound."""
    parts = [spark.range(i * 4000, i * 4000 + 20_000).withColumnRenamed("id", "v") for i in range(6)]
    got = S.distinct_estimate(states(spark, parts, str(tmp_path / "s")), "v").first()
    assert got["rows"] == 120_000 and got["distinct"] == pytest.approx(40_000, rel=3 * 1.04 / 2 ** (S.LG_K / 2))


def test_states_by_stage(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, None)], "v int, t string")
    held = states(spark, [df, df.where("v = 2")], str(tmp_path / "s"))
    got = {(r["stage"], r["column"]): (r["count"], r["distinct"]) for r in S.merged_profile(held, ["stage"]).collect()}
    assert got == {("s0", "v"): (3, 2), ("s0", "t"): (2, 3), ("s1", "v"): (2, 1), ("s1", "t"): (1, 2)}
