"""A third of all rows on one key: results stay whole and exact."""

import numpy as np
from pyspark.sql import functions as F

from shelfwise.operators import clean as C
from shelfwise.operators import profile as P
from shelfwise.operators.quantiles import exact_quantiles

N = 330_000


def skewed(spark):
    # rows 0..N/3-1 share key 'hot' and are exact copies; the rest are distinct
    return spark.range(N).select(
        F.when(F.col("id") < N // 3, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("key"),
        F.when(F.col("id") < N // 3, F.lit(7.0)).otherwise((F.col("id") % 1000).cast("double")).alias("v"))


def test_hot_key_ids_unique_and_chunked(spark):
    df = skewed(spark)
    out = C.add_surrogate_id(df, ["key"])
    agg = out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("d")).first()
    assert agg["n"] == N and agg["d"] == N
    hot = out.where(F.col("key") == "hot").select(
        F.max(F.element_at(F.split("id", "_"), -1).cast("int")).alias("mx")).first()["mx"]
    assert hot == N // 3        # copy numbers 1..N/3 (regenerated in chunks of COPY_CHUNK)
    assert N // 3 > C.COPY_CHUNK


def test_hot_value_duplicates_and_counts(spark):
    df = skewed(spark)
    dups = P.duplicate_rows(df, "key")
    assert dups.count() == N // 3
    top = P.top_k(df, "key", 1).first()
    assert (top["value"], top["count"]) == ("hot", N // 3)


def test_hot_value_quantiles_exact(spark):
    df = skewed(spark)
    v = np.concatenate([np.full(N // 3, 7.0), (np.arange(N // 3, N) % 1000).astype(float)])
    probs = [0.1, 0.3, 0.5, 0.9]
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["v"], probs).collect()}
    for p in probs:
        assert got[p] == float(np.quantile(v, p))
