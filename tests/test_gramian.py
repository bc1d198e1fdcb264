"""Correlations from sums of products, against numpy over the complete pairs."""

import math

import numpy as np
import pytest

from shelfwise.operators import profile as P
from shelfwise.operators.gramian import pair_correlations


def expected(a, b):
    both = [(x, y) for x, y in zip(a, b) if x is not None and y is not None]
    if not both or len({x for x, _ in both}) == 1 or len({y for _, y in both}) == 1:
        return None
    x, y = (np.array([float(v - t[0]) for v in t]) for t in zip(*both))
    return float(np.corrcoef(x, y)[0, 1])


def test_random_tables_with_nulls(spark):
    rng = np.random.default_rng(11)
    n = 400
    base = rng.normal(size=n)
    cols = {"a": base + 1e9, "b": base * -3 + rng.normal(size=n), "c": rng.integers(0, 4, n).astype(float), "d": np.full(n, 7.1),
            "e": np.exp(base * 3), "f": base * 1e-12}
    data = {k: [None if rng.random() < {"b": .3, "d": .5, "e": .1}.get(k, 0) else float(x) for x in v] for k, v in cols.items()}
    data["g"] = [None if x is None else 1.0 for x in data["b"]]      # constant wherever it is
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data))
    names = list(data)
    got = pair_correlations(df, [(x, y) for x in names for y in names if x < y])
    for (x, y), v in got.items():
        want = expected(data[x], data[y])
        assert (v is None) == (want is None) and (v is None or v == pytest.approx(want, abs=1e-6)), (x, y)


def test_integers_beyond_the_doubles(spark):
    """Neighbouring longs that are one double: the centre is taken off before."""
    top = 2**63 - 1
    rows = [(top - i, -top + i * i % 7, bool(i % 2), i % 2) for i in range(50)]
    df = spark.createDataFrame(rows, "x long, y long, t boolean, i int")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in P.correlation_matrix(df, ["x", "y", "t", "i"], lower_only=False).collect()}
    assert len(got) == 16 and got["x", "x"] == 1.0 and got["t", "i"] == got["i", "t"] == 1.0
    assert got["x", "y"] == pytest.approx(expected([r[0] for r in rows], [r[1] for r in rows]), abs=1e-6)
    assert got["x", "i"] == pytest.approx(expected([r[0] for r in rows], [r[3] for r in rows]), abs=1e-6)


def test_extreme_longs_of_both_signs(spark):
    df = spark.createDataFrame([(-2**63, 1.0), (2**63 - 1, 2.0), (0, 1.5)], "x long, y double")
    assert pair_correlations(df, [("x", "y")])["x", "y"] == pytest.approx(1.0)


def test_empty_tables_nan_and_odd_names(spark):
    empty = spark.createDataFrame([], "x double, y int")
    assert pair_correlations(empty, [("x", "y")]) == {("x", "y"): None} and pair_correlations(empty, []) == {}
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (2.0, float("nan"), 2.0), (3.0, 3.0, 4.0)], "`a b` double, y double, `x0` double")
    got = pair_correlations(df, [("a b", "y"), ("a b", "x0")])
    assert math.isnan(got["a b", "y"]) and got["a b", "x0"] == pytest.approx(0.981981, abs=1e-6)


def test_one_aggregate_a_pair(spark, monkeypatch):
    """Twelve columns without nulls: 66 products and four sums a column, not 7 a pair."""
    import pyspark.sql.classic.dataframe as D

    sizes = []
    real = D.DataFrame.agg
    monkeypatch.setattr(D.DataFrame, "agg", lambda self, *a: (sizes.append(len(a)), real(self, *a))[1])
    df = spark.range(50).selectExpr(*(f"sin(id * {i + 1}) AS c{i}" for i in range(12)))
    pair_correlations(df, [(f"c{i}", f"c{j}") for i in range(12) for j in range(i)])
    assert sizes == [1 + 4 * 12, 66 + 4 * 12]
