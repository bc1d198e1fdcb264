"""Pairwise Pearson correlations from sums of products of centred values.

The columns are staged once, narrow.  A first aggregate over the staged copy gives each
column's count, mean, minimum and maximum; a second one the sums

    of x * y per pair, and of x, x * x per column and per set of other columns that
    must be present,

x and y being centred at the first means (integers exactly, before they become
doubles).  A product with a null is null and counts in no sum, so the sums of products
need no condition; the others need one only where a column has nulls.  That is one
aggregate a pair and four a column, where moments per pair would take seven a pair.
What reaches the driver is these sums, whose number follows the columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.common import staged
from shelfwise.session import remove_path

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _numeric(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType
    if isinstance(kind, _INTEGERS + (T.BooleanType,)):
        return F.col(f"`{c}`").cast("bigint")
    return F.col(f"`{c}`").cast("double")


def _centred(i: int, first, integer: bool) -> Column:
    x, mean = F.col(f"x{i}"), first[f"m{i}"]
    if mean is None or not math.isfinite(mean):
        return x.cast("double")
    if not integer:
        return x - F.lit(mean)
    # a difference of longs can leave the longs, one of decimals cannot
    wide = max(abs(first[f"lo{i}"]), abs(first[f"hi{i}"])) > 2**53
    centre = F.lit(min(max(round(mean), first[f"lo{i}"]), first[f"hi{i}"]))
    return (x.cast("decimal(20,0)") - centre.cast("decimal(20,0)") if wide else x - centre).cast("double")


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> dict[tuple[str, str], float | None]:
    """Correlation of each pair of columns over the rows that have both values; None
    where one of them is constant there, or there are none.

    Constancy is tested as minimum = maximum: a variance put together from parts can
    be a tiny number instead of 0.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    if not cols:
        return {}
    integer = [not isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType, T.DecimalType)) for c in cols]
    table, path = staged(df.select(*(_numeric(df, c).alias(f"x{i}") for i, c in enumerate(cols))), "gramian")
    try:
        return _correlations(table, cols, integer, pairs)
    finally:
        remove_path(df.sparkSession, path)


def _correlations(table: DataFrame, cols: list[str], integer: list[bool], pairs) -> dict:
    number = {c: i for i, c in enumerate(cols)}
    each = range(len(cols))
    first = table.agg(F.count(F.lit(1)).alias("n"), *(a for i in each for a in (
        F.count(f"x{i}").alias(f"n{i}"), F.avg(f"x{i}").alias(f"m{i}"), F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}")))).first()
    gappy = {i for i in each if first[f"n{i}"] < first["n"]}
    u = table.select(*(_centred(i, first, integer[i]).alias(f"u{i}") for i in each))
    wanted, aggregates = set(), {}
    for a, b in pairs:
        a, b = sorted((number[a], number[b]))
        others = tuple(sorted({a, b} & gappy))
        wanted |= {(a, others), (b, others)}
        aggregates[f"p_{a}_{b}"] = F.sum(F.col(f"u{a}") * F.col(f"u{b}"))

    def name(i, others):
        return f"{i}_" + "_".join(map(str, others))

    for i, others in wanted:
        present = [F.col(f"u{o}").isNotNull() for o in others if o != i]
        x = F.col(f"u{i}")
        for p in present:
            x = F.when(p, x)
        aggregates |= {"n_" + name(i, others): F.count(x), "s_" + name(i, others): F.sum(x), "q_" + name(i, others): F.sum(x * x),
                       "c_" + name(i, others): F.equal_null(F.min(x), F.max(x))}
    sums = u.agg(*(a.alias(n) for n, a in aggregates.items())).first()
    out = {}
    for pair in pairs:
        a, b = sorted((number[pair[0]], number[pair[1]]))
        others = tuple(sorted({a, b} & gappy))
        ka, kb = name(a, others), name(b, others)
        n = sums["n_" + ka]
        if not n or sums["c_" + ka] or sums["c_" + kb]:
            out[pair] = None
            continue
        xx = sums["q_" + ka] - sums["s_" + ka] ** 2 / n
        yy = sums["q_" + kb] - sums["s_" + kb] ** 2 / n
        xy = sums[f"p_{a}_{b}"] - sums["s_" + ka] * sums["s_" + kb] / n
        spread = math.sqrt(xx) * math.sqrt(yy) if xx >= 0 and yy >= 0 else math.nan if math.isnan(xx + yy) else 0.0
        out[pair] = max(-1.0, min(1.0, xy / spread)) if spread else None
        if math.isnan(xy) or math.isnan(spread):
            out[pair] = math.nan
    return out
