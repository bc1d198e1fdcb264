"""Column profiles whose states are stored per stage and merged without a rescan.

A state holds, for one column of one table: rows, nulls, mean and sum of squared
deviations, extremes, and an HLL sketch of its values.  States of several tables (the
parts of one, or the days of a feed) are a small table themselves; merging adds counts,
combines moments and unites sketches, and reads no data again.  Distinct counts are
estimates with a relative error of about 1.04 / sqrt(2^LG_K) (0.8 %); all other numbers
are exact but for the order of additions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.common import cols_or_all

LG_K = 14
_NUMBERS = (T.NumericType, T.BooleanType)
STATE = ("stage string, column string, dtype string, rows bigint, nulls bigint, mean double, squares double, "
         "least double, most double, least_text string, most_text string, sketch binary")


def _number(df: DataFrame, c: str) -> Column:
    x = F.col(f"`{c}`")
    return x.cast("int").cast("double") if isinstance(df.schema[c].dataType, T.BooleanType) else x.cast("double")


def profile_states(df: DataFrame, stage: str, cols: Sequence[str] | None = None) -> DataFrame:
    """One state a column (schema ``STATE``), from one pass."""
    cols = cols_or_all(df, cols)
    types = dict(df.dtypes)
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        x, numeric = F.col(f"`{c}`"), isinstance(df.schema[c].dataType, _NUMBERS)
        n, text = (_number(df, c) if numeric else F.lit(None).cast("double")), (F.lit(None).cast("string") if numeric else x.cast("string"))
        values = F.count(n)
        aggregates += [F.count_if(x.isNull()).alias(f"_z{i}"), F.avg(n).alias(f"_m{i}"), (F.var_pop(n) * values).alias(f"_q{i}"),
                       F.min(n).alias(f"_l{i}"), F.max(n).alias(f"_h{i}"), F.min(text).alias(f"_a{i}"), F.max(text).alias(f"_b{i}"),
                       F.hll_sketch_agg(x.cast("string"), LG_K).alias(f"_s{i}")]
    row = df.agg(*aggregates)
    items = [F.struct(F.lit(stage).alias("stage"), F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col("_rows").alias("rows"),
                      F.col(f"_z{i}").alias("nulls"), F.col(f"_m{i}").alias("mean"), F.col(f"_q{i}").alias("squares"),
                      F.col(f"_l{i}").alias("least"), F.col(f"_h{i}").alias("most"), F.col(f"_a{i}").alias("least_text"),
                      F.col(f"_b{i}").alias("most_text"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*items)).alias("_x")).select("_x.*")


def merged_profile(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profile of the union of the tables behind ``states``, per column (and ``by``):
    ``column, dtype, count, nulls, distinct`` (estimate; null counts as a value),
    ``min, max`` (as text), ``mean, std``.  ``dtype`` lists the types met."""
    keys = [*by, "column"]
    values = F.col("rows") - F.col("nulls")
    counted = F.sum(F.when(F.col("mean").isNotNull(), values))
    merged = states.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set("dtype")), "|").alias("dtype"), F.sum(values).alias("count"), F.sum("nulls").alias("nulls"),
        F.try_divide(F.sum(F.col("mean") * values), counted).alias("mean"), counted.alias("_n"), F.sum("squares").alias("_within"),
        F.collect_list(F.when(F.col("mean").isNotNull(), F.struct(values.alias("n"), "mean"))).alias("_means"),
        F.min("least").alias("_least"), F.max("most").alias("_most"), F.min("least_text").alias("_first"), F.max("most_text").alias("_last"),
        F.hll_union_agg("sketch").alias("_sketch"))
    # squared deviations of the states' means from the common one, added to those within
    between = F.aggregate("_means", F.lit(0.0), lambda acc, s: acc + s["n"] * (s["mean"] - F.col("mean")) * (s["mean"] - F.col("mean")))
    merged = merged.withColumn("_squares", F.col("_within") + between)
    return merged.select(
        *keys, "dtype", "count", "nulls",
        (F.hll_sketch_estimate("_sketch") + F.when(F.col("nulls") > 0, 1).otherwise(0)).alias("distinct"),
        F.coalesce(F.col("_least").cast("string"), "_first").alias("min"), F.coalesce(F.col("_most").cast("string"), "_last").alias("max"),
        "mean", F.when(F.col("_n") > 1, F.sqrt(F.col("_squares") / (F.col("_n") - 1))).alias("std"))


def distinct_estimate(states: DataFrame, column: str) -> DataFrame:
    """One row: rows, nulls and distinct values of one column over all states."""
    one = states.where(F.col("column") == column)
    return one.agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
                   F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))
