"""Gates, profiles, quantiles (against numpy brute force), histograms,
correlations; the reference EDA unit-test inputs."""

import numpy as np
import pytest

from shelfwise.operators import profile as P
from shelfwise.operators import quality as Q
from shelfwise.operators.quantiles import exact_quantiles
from tests.conftest import rows

PROC = "id string, price double, rating int, stock int, availability int"


def test_processed_gate_edges(spark):
    data = [("a", 0.0, 3, 1, 1), ("b", 5.0, 6, 1, 1), ("c", 5.0, 3, -1, 1), ("d", 5.0, 3, 1, 2),
            ("e", 5.0, 3, 1, 0), ("e", 5.0, 3, 1, 0), ("f", None, 3, 1, 0)]
    df = spark.createDataFrame(data, PROC)
    rep = dict(rows(Q.gate_processed(df, required=("id", "price", "rating", "stock", "availability")),
                    "rule", "violations"))
    assert rep == {"columns_present": 0, "id_unique": 1, "price_positive": 1, "rating_1_to_5": 1,
                   "stock_non_negative": 1, "flag_0_or_1": 1}
    with pytest.raises(Q.QualityError):
        Q.assert_passed(Q.gate_processed(df, required=("id",)), "gate")
    missing = dict(rows(Q.gate_processed(df.drop("stock")), "rule", "violations"))
    assert missing["columns_present"] > 0


def test_placeholder_profile_and_examples(spark):
    vals = [None, "", "0", "NULL", "N/A", "na", "x"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, c string")
    r = rows(Q.placeholder_profile(df, ["c"]))[0]
    assert r[1:7] == (1, 1, 1, 1, 2, 6)
    ex = Q.placeholder_examples(df, "c", ["i", "c"], ["i"], 3)
    assert rows(ex) == [(0, None), (1, ""), (2, "0")]


def test_duplicates_keep_every_copy_and_null_group(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "a", "b", None, None])], "i int, t string")
    assert sorted(r[0] for r in P.duplicate_rows(df, "t").select("i").collect()) == [0, 1, 3, 4]


@pytest.mark.parametrize("refine", [1, 5])
def test_exact_quantiles_match_numpy(spark, refine):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.normal(0, 10, 3000).round(2), np.full(1500, 3.0)])   # a hot value
    b = rng.integers(0, 5, 4500).astype(float)
    pdf = [(float(x), float(y)) for x, y in zip(a, b)] + [(None, None)]
    df = spark.createDataFrame(pdf, "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = df.repartition(refine)
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], probs).collect()}
    for c, arr in (("a", a), ("b", b)):
        for p in probs:
            assert got[(c, p)] == pytest.approx(float(np.quantile(arr, p)), abs=1e-9)
    empty = spark.createDataFrame([(None,)], "a double")
    assert exact_quantiles(empty, ["a"], [0.5]).first()["value"] is None


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    h = {r["bin"]: r["count"] for r in P.histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    const = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert sorted(rows(P.histogram(const, "x", 5), "bin", "count")) == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 0)]


def test_reference_eda_case(spark):
    cleaned = spark.createDataFrame([(10, "a"), (11, "b"), (12, "a")], "price int, category string")
    processed = spark.createDataFrame([(10, "a", 1), (11, "b", 2), (12, "a", 3), (13, "b", 4)],
                                      "price int, category string, x int")
    feats = spark.createDataFrame([(10, 1, 2), (11, 2, 4), (12, 3, 6), (13, 4, 8)], "price int, x int, y int")
    profiles = [P.table_profile(d) for d in (cleaned, processed, feats)]
    assert [p.count() for p in profiles] == [2, 3, 3]
    prof = {r["column"]: r for r in profiles[1].collect()}
    assert prof["price"]["distinct"] == 4 and prof["category"]["nulls"] == 0 and prof["price"]["mean"] == 11.5
    corr = P.correlation_matrix(feats, ["price", "x", "y"])
    assert [r["corr"] for r in corr.collect()] == [1.0, 1.0, 1.0]
    tgt = P.target_correlations(feats, "price", ["x", "y"])
    assert [r["corr"] for r in tgt.collect()] == [1.0, 1.0]


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "a int, b int")
    assert rows(P.correlation_matrix(df, ["a", "b"]), "corr") == [(None,)]


def test_value_counts_order_and_pages(spark):
    df = spark.createDataFrame([(v,) for v in "aaabbcddd"], "c string")
    assert rows(P.value_counts(df, "c")) == [("a", 3), ("d", 3), ("b", 2), ("c", 1)]
    assert rows(P.value_counts(df, "c", by="value"))[0] == ("a", 3)
    assert rows(P.ranked_page(df, "c", 1, 2)) == [("d", 3), ("b", 2)]
    assert rows(P.bottom_k(df, "c", 2)) == [("c", 1), ("b", 2)]
    share = dict((r["value"], r["percent"]) for r in P.value_share(df, "c").collect())
    assert share["a"] == pytest.approx(100 / 3, abs=1e-6)
    assert rows(P.distinct_counts(spark.createDataFrame([("a",), (None,), ("a",)], "c string"))) == [("c", 2)]


def test_extreme_and_text_stats(spark):
    df = spark.createDataFrame([("ab",), ("abcd",), ("xy",), ("zzzz",)], "t string")
    assert rows(P.extreme_by_length(df, "t")) == [("longest", "zzzz", 4), ("shortest", "ab", 2)]
    assert rows(P.text_length_stats(df, ["t"]))[0] == ("t", 2, 4, 3.0)


def test_feature_groups():
    cols = ["id", "price", "price_range", "has_subtitle", "title_length", "rating_category", "stock_level",
            "popularity_score", "category_a"]
    g = P.feature_groups(cols, ["id", "price"])
    assert g["price"] == ["price_range"] and g["category"] == ["category_a"]
    assert P.added_columns(cols, ["id", "price"])[0] == "price_range"


def test_no_python_udf_in_profiles(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string")
    for out in (P.describe(df, ["x"]), P.table_profile(df), P.histogram(df, "x", 3)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_duplicate_plans_shuffle_keys_only(spark):
    """No exchange into one partition, and no broadcast of anything unchecked."""
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "t string, v int").repartition(3)
    for out in (P.duplicate_rows(df, "t"), P.distinct_counts(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    assert P.duplicate_rows(df, "t").count() == 2
    assert dict(rows(P.distinct_counts(df))) == {"t": 2, "v": 2}


def test_correlation_of_a_column_with_a_large_offset(spark):
    """Nanosecond times within a second vary; a column constant where both have values does not."""
    from pyspark.sql import functions as F

    from shelfwise.operators import features as FE

    df = spark.createDataFrame([(1_700_000_000_000_000_000 + i * 5_000_000, float(i), 7.1 if i < 90 else None) for i in range(100)],
                               "t long, y double, c double").withColumn("d", F.expr("if(c is null, 1.0D, 3.3D)"))
    assert rows(P.target_correlations(df, "y", ["t", "c"]), "corr") == [(pytest.approx(1.0, abs=1e-6),), (None,)]
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in P.correlation_matrix(df, ["t", "y", "c", "d"]).collect()}
    assert got[("t", "y")] == pytest.approx(1.0, abs=1e-6) and got[("c", "d")] is None and got[("y", "d")] < 0
    assert FE.feature_selection(df, "y", ["t", "c"])[1] == ["t"]


def test_correlation_uses_rows_with_both_values(spark):
    """Constants and nulls: numpy over the complete pairs."""
    data = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 1.0, 5.0), (None, 7.0, 5.0), (4.0, 9.0, None), (6.0, 3.0, 5.0)]
    df = spark.createDataFrame(data, "x double, y double, z double")
    both = np.array([(x, y) for x, y, _ in data if x is not None and y is not None])
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in P.correlation_matrix(df, ["x", "y", "z"]).collect()}
    assert got[("x", "y")] == pytest.approx(np.corrcoef(both.T)[0, 1], abs=1e-6)
    assert got[("x", "z")] is None


@pytest.mark.parametrize("method", ["lower", "higher", "midpoint"])
def test_quantile_interpolations_match_numpy(spark, method):
    vals = [float(x) for x in [5, 1, 9, 3, 7, 2, 8, 8, 4, 10, 6]]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    probs = [0.1, 0.25, 0.33, 0.5, 0.9]
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["a"], probs, interpolation=method).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(vals, p, method=method)))


def test_quantile_nearest_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(float(v),) for v in [10, 20, 30, 40]], "a double")
    # positions (n-1)*p: 0.5 -> rank 1, 1.5 -> rank 2, 0.75 -> rank 1
    got = {r["prob"]: r["value"] for r in
           exact_quantiles(df, ["a"], [1 / 6, 0.5, 0.25], interpolation="nearest").collect()}
    assert (got[1 / 6], got[0.5], got[0.25]) == (20.0, 30.0, 20.0)
    with pytest.raises(ValueError):
        exact_quantiles(df, ["a"], [0.5], interpolation="cubic")


def test_describe_nearest(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4]], "x double")
    r = P.describe(df, ["x"], interpolation="nearest").first()
    assert (r["q25"], r["q50"], r["q75"]) == (2.0, 3.0, 3.0)   # positions 0.75, 1.5, 2.25
    lin = P.describe(df, ["x"]).first()
    assert (lin["q25"], lin["q50"], lin["q75"]) == (1.75, 2.5, 3.25)


def test_processed_gate_id_paths(spark):
    base = [("a", 1.0, 3, 1, 1), ("b", 1.0, 3, 1, 1)]
    unique = spark.createDataFrame(base, PROC)
    assert dict(rows(Q.gate_processed(unique, required=("id",)), "rule", "violations"))["id_unique"] == 0
    with_null = spark.createDataFrame(base + [(None, 1.0, 3, 1, 1)], PROC)
    assert dict(rows(Q.gate_processed(with_null, required=("id",)), "rule", "violations"))["id_unique"] == 1
