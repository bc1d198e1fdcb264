"""Quantiles bracketed by sketches, against numpy and Python integers."""

import math

import numpy as np
import pytest

from shelfwise.operators import profile as P
from shelfwise.operators import quantiles as Q

PROBS = [0.0, 0.01, 0.25, 0.3337, 0.5, 0.75, 0.999, 1.0]


def values(df, cols, **kw):
    return {(r["column"], r["prob"]): r["value"] for r in Q.exact_quantiles(df, cols, PROBS, **kw).collect()}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    n = 30_000
    data = {"normal": rng.normal(size=n), "few": rng.integers(0, 5, n).astype(float), "hot": np.where(rng.random(n) < .7, 3.0, rng.random(n) * 6),
            "tails": np.exp(rng.normal(size=n) * 9), "same": np.full(n, 2.5)}
    rows = list(zip(*(v.tolist() for v in data.values())))
    return data, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(7)


@pytest.mark.parametrize("method", ["linear", "lower", "higher", "midpoint"])
def test_many_rows_of_several_shapes(table, method):
    data, df = table
    got = values(df, list(data), interpolation=method)
    for c, v in data.items():
        for p in PROBS:
            assert got[c, p] == pytest.approx(float(np.quantile(v, p, method=method)), rel=1e-12, abs=1e-12), (c, p)


def test_nulls_nan_infinities_and_columns_without_values(spark):
    rows = [(float(i), None if i % 3 else float(i), float("nan") if i % 2 else float(i), math.inf if i < 10 else -math.inf if i < 20 else 1.0, None, i % 2 == 0)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f boolean")
    got = values(df, list("abcdef"), interpolation="lower")
    for name, kept in {"a": range(3000), "b": range(0, 3000, 3), "c": range(0, 3000, 2)}.items():
        kept = sorted(map(float, kept))
        assert all(got[name, p] == kept[math.floor((len(kept) - 1) * p)] for p in PROBS)
    assert got["d", 0.0] == -math.inf and got["d", 1.0] == math.inf and got["d", 0.5] == 1.0
    assert got["e", 0.5] is None and got["f", 0.25] == 0 and got["f", 0.75] == 1
    # a position between two values: infinite ones stay
    assert values(df, ["d"])["d", 0.0] == -math.inf


def test_longs_stay_longs(spark):
    top = 2**63 - 1
    held = [top - i * i for i in range(2500)] + [-top - 1 + i for i in range(2500)]
    df = spark.createDataFrame([(v,) for v in held], "x long")
    kept = sorted(held)
    for method, at in (("lower", math.floor), ("higher", math.ceil), ("nearest", lambda h: math.floor(h + .5))):
        got = values(df, ["x"], interpolation=method)
        assert {p: got["x", p] for p in PROBS} == {p: kept[at(4999 * p)] for p in PROBS}
    row = P.describe(df, ["x"], interpolation="nearest").first()
    assert (row["min"], row["max"], row["q25"]) == (-top - 1, top, kept[math.floor(4999 * .25 + .5)])
    assert P.numeric_summary(df, ["x"]).first()["max"] == top
    mixed = df.selectExpr("x", "cast(x as double) AS y")
    assert dict(P.numeric_summary(mixed, ["x", "y"]).dtypes)["min"] == "double"


def test_a_rank_outside_its_bracket_is_looked_up_again(table, monkeypatch):
    """With a margin of nothing the sketch misses; the result stays exact."""
    data, df = table
    calls = []
    real = Q._order_statistics
    monkeypatch.setattr(Q, "_order_statistics", lambda *a: (calls.append(sorted(a[3])), real(*a))[1])
    monkeypatch.setattr(Q, "MARGIN", 0.0)
    got = values(df, list(data), interpolation="lower")
    assert len(calls) == 2 and calls[1]
    assert all(got[c, p] == float(np.quantile(v, p, method="lower")) for c, v in data.items() for p in PROBS)


def test_few_values_are_shuffled(table, monkeypatch):
    """Quartiles of distinct values: a small share of them is counted one by one."""
    data, df = table
    seen = []
    real = Q.staged

    def spy(frame, name):
        out = real(frame, name)
        seen.append(out[0].count())
        return out

    monkeypatch.setattr(Q, "staged", spy)
    Q.exact_quantiles(df, ["normal"], [0.25, 0.5, 0.75])
    assert seen[0] < 0.1 * len(data["normal"])
