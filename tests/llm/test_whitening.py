"""op11 against plain numpy and Python integers."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import whitening as W

from helpers import SF

DDL = "vec_id long, embedding array<float>, label int, x string, deviation int"


def brute(vectors):
    """Kept vectors as integers, distinct ones, sums, covariance as doubles."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, width = len(distinct), len(kept[0][1])
    sums = [sum(x[j] for x in distinct) for j in range(width)]
    scatter = [[n * sum(x[j] * x[k] for x in distinct) - sums[j] * sums[k] for k in range(width)] for j in range(width)]
    return kept, n, sums, np.array([[s / (n * n) for s in row] for row in scatter])


def check(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], DDL)
    got = W.op11_whitening(df).collect()
    kept, n, sums, v = brute(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    assert len(got) == len(kept) * min(4, len(sums))
    deviations = sorted((i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in kept)
    assert sorted((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == deviations
    assert {r["n"] for r in got} == {n} and all(r["identity_error"] <= 1e-4 for r in got)
    for k in range(len(values)):
        mine = {r["vec_id"]: r for r in got if r["component"] == k + 1}
        assert all(abs(r["explained"] - values[k] / np.trace(v)) <= 1e-6 for r in mine.values())
        if values[k] > 1e-9 * np.trace(v):
            expected = {i: float((np.array(x) - np.array(sums) / n) @ vectors[:, k] / math.sqrt(values[k])) for i, x in kept}
            sign = np.sign(sum(expected[i] * mine[i]["whitened"] for i in expected))
            assert all(abs(sign * mine[i]["whitened"] - e) < 1e-6 for i, e in expected.items())


def test_against_numpy_with_nulls_copies_and_signs(spark):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(150, 6)) * [5, 3, 2, 1, .5, .1]).tolist()
    rows = list(enumerate(base + base[:40] + [base[0]] * 30))
    rows += [(1000, None), (1001, [None] * 6), (1002, [float("nan")] + [0.0] * 5), (1003, [float("inf")] * 6), (1004, [-0.0] * 6),
             (1005, [1.0, 2.0, None, 0.0, 0.0, 0.0]), (1006, [3e38] * 6)]
    # 256 * 3e38 is no long: dropped like an entry that is not finite
    expected = [r for r in rows if r[0] != 1006]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], DDL)
    assert {r["vec_id"] for r in W.op11_whitening(df).select("vec_id").collect()} == {i for i, _ in brute(expected)[0]}
    check(spark, expected)


def test_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(spark, rows)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(-2**40, 2**40), min_size=3, max_size=3), min_size=1, max_size=150))
def test_bit_planes_give_exact_products(rows):
    x = np.array(rows, dtype=np.int64)
    low, high = int(x.min()), int(x.max())
    bits = max(1, (high - low).bit_length())
    p = W.planes(x.astype(np.uint64) - np.uint64(low % 2**64), bits)
    counts, ones = W.cross_counts(p), W.plane_counts(p)
    for j in range(3):
        assert W._weighted(ones[j]) == sum(r[j] - low for r in rows)
        for k in range(j, 3):
            exact = sum((r[j] - low) * (r[k] - low) for r in rows)
            assert W._weighted(counts[j, k]) == exact
            assert sum(v << (W.LIMB * i) for i, v in enumerate(W._limbs(exact))) == exact


@pytest.mark.parametrize("rows, shape", [
    ([], 0), ([(1, None)], 0), ([(1, [])], 0), ([(1, [0.5])], 1), ([(1, [0.5, 1.5]), (2, [0.5, 1.5]), (2, [0.5, 1.5])], 6),
    ([(1, [1.0, 2.0, 3.0]), (None, [1.0]), (3, [])], 9)])
def test_odd_tables(spark, rows, shape):
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], DDL)
    got = W.op11_whitening(df).collect()
    assert len(got) == shape
    assert all(math.isfinite(r["whitened"]) and r["identity_error"] <= 1e-4 for r in got)
    if len({tuple(v) for _, v in rows if v}) == 1:
        assert all(r["whitened"] == 0.0 and r["explained"] == 0.0 and r["deviation"] == 0 for r in got)


def test_large_longs_stay_exact(spark):
    rows = [(0, [2.0**50, 1.0]), (1, [2.0**50 + 2.0**27, -1.0]), (2, [-2.0**50, 0.5])]
    rows_, model = W.whiten(spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], DDL))
    kept, n, sums, v = brute(rows)
    assert model.sums == sums
    assert {r["vec_id"]: int(r["deviation"]) for r in rows_.collect()} == {
        i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in kept}


def test_same_rows_under_other_partitions(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    key = lambda d: sorted((r["vec_id"], r["component"], r["deviation"], r["whitened"]) for r in W.op11_whitening(d).collect())
    assert key(df) == key(df.repartition(7))
