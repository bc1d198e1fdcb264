"""Exact quantiles without shuffling the values of a column.

A first aggregate takes a KLL sketch of each column.  The sketch answers a rank to
within a small share of the rows, so two of its quantiles, a few error bounds below
and above, bracket each wanted rank.  One filtered pass then counts the values inside
the brackets one by one and all others by the gap they lie in: a task sends on a few
rows for the gaps and the distinct values of about one hundredth of its rows per rank.
These counts are range-partitioned by (column, value) and staged; one total per
partition and column reaches the driver, prefix sums of these tell which partition
holds each wanted rank, and only those partitions are numbered.  A rank that falls
into a gap (the sketch was further off than its bounds, which are no guarantee) is
looked up again with all values of its column, so the result is always exact.

Integers stay longs throughout; other numbers are doubles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.common import staged
from shelfwise.session import remove_path

SKETCH_K = 1024
#: Four times the rank error that the sketch keeps with 99 % confidence.
MARGIN = 4 * 2.296 / SKETCH_K**0.9723
#: Below so many values a column is its own bracket.
SMALL = 1000
INTERPOLATIONS = ("linear", "lower", "higher", "midpoint", "nearest")
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def is_integral(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, _INTEGERS)


def number(df: DataFrame, c: str) -> Column:
    """A column as long, if it holds integers, or double."""
    return F.col(f"`{c}`").cast("bigint" if is_integral(df, c) else "double")


def _value(df: DataFrame, c: str) -> Column:
    x = number(df, c)
    return x if is_integral(df, c) else F.when(~F.isnan(x), x)


def sketch_aggregates(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Aggregates that :func:`brackets` needs of a row; they can share a pass with others."""
    out = []
    for i, c in enumerate(cols):
        x, kind = _value(df, c), "bigint" if is_integral(df, c) else "double"
        sketch = getattr(F, f"kll_sketch_agg_{kind}")(x, SKETCH_K)
        out += [F.count(x).alias(f"_qn{i}"), sketch.alias(f"_qs{i}"), F.min(x).alias(f"_ql{i}"), F.max(x).alias(f"_qh{i}")]
    return out


def brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], aggregated: DataFrame) -> DataFrame:
    """``aggregated`` (one row with :func:`sketch_aggregates`) with two quantiles per
    probability in place of each sketch."""
    bounds = F.array(*(F.lit(min(1.0, max(0.0, p + s * MARGIN))) for p in probs for s in (-1, 1)))
    out = aggregated
    for i, c in enumerate(cols):
        get = F.kll_sketch_get_quantile_bigint if is_integral(df, c) else F.kll_sketch_get_quantile_double
        out = out.withColumn(f"_qs{i}", F.when(F.col(f"_qn{i}") >= SMALL, get(F.col(f"_qs{i}"), bounds)))
    return out


def _ranks(h: float, interpolation: str) -> tuple[int, int]:
    """0-based order statistics an interpolation reads at position h."""
    lo, hi = math.floor(h), math.ceil(h)
    if interpolation == "lower":
        return lo, lo
    if interpolation == "higher":
        return hi, hi
    if interpolation == "nearest":          # half away from zero, as Rust's f64::round
        r = math.floor(h + 0.5)
        return r, r
    return lo, hi


def _combine(h: float, lo: int, v_lo, v_hi, interpolation: str):
    if interpolation not in ("linear", "midpoint"):
        return v_lo
    share = h - lo if interpolation == "linear" else 0.5
    if isinstance(v_lo, int):               # longs beyond the doubles are rounded once, at the end
        return float(Fraction(v_lo) + Fraction(share) * (v_hi - v_lo))
    return v_lo if v_lo == v_hi else v_lo + share * (v_hi - v_lo)


def _merged(row: Row, i: int) -> list[tuple]:
    """Disjoint brackets of a column, in order."""
    low, high, found = row[f"_ql{i}"], row[f"_qh{i}"], row[f"_qs{i}"]
    if found is None:
        return [(low, high)]
    out = []
    for a, b in sorted(zip(found[::2], found[1::2])):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cell(i: int, x: Column, integral: bool, ranges: list[tuple]) -> Column:
    """``(c, v, d, gap)``: the value itself inside a bracket; else the end of the bracket
    below (null for none), marked as a gap, which sorts behind it."""
    def cell(value: Column, gap: bool) -> Column:
        v, d = (value, F.lit(None)) if integral else (F.lit(None), value)
        return F.struct(F.lit(i).alias("c"), v.cast("bigint").alias("v"), d.cast("double").alias("d"), F.lit(gap).alias("gap"))

    out, below = None, F.lit(None)
    for a, b in ranges:
        out = F.when(x < F.lit(a), cell(below, True)) if out is None else out.when(x < F.lit(a), cell(below, True))
        out = out.when(x <= F.lit(b), cell(x, False))
        below = F.lit(b)
    return F.when(x.isNotNull(), out.otherwise(cell(below, True)))


def _order_statistics(df: DataFrame, cols: Sequence[str], ranges: dict[int, list[tuple]], wanted: dict[int, list[int]]) -> dict:
    """(column number, rank) -> value; None for a rank in a gap."""
    cells = F.array(*(_cell(i, _value(df, cols[i]), is_integral(df, cols[i]), ranges[i]) for i in wanted))
    counted = (df.select(F.explode(cells).alias("_q")).where(F.col("_q").isNotNull()).select("_q.*")
               .groupBy("c", "v", "d", "gap").agg(F.count(F.lit(1)).alias("n"))
               .repartitionByRange("c", "v", "d", "gap").withColumn("part", F.spark_partition_id()))
    counts, path = staged(counted, "quantiles")
    try:
        totals = counts.groupBy("c", "part").agg(F.sum("n").alias("n")).orderBy("c", "part").collect()
        jobs, before = [], dict.fromkeys(wanted, 0)
        for r in totals:
            c, at = r["c"], before[r["c"]]
            jobs += [(c, r["part"], at, k) for k in wanted[c] if at <= k < at + r["n"]]
            before[c] = at + r["n"]
        if not jobs:
            return {}
        spark = df.sparkSession
        inside = Window.partitionBy("c", "part").orderBy("v", "d", "gap").rowsBetween(Window.unboundedPreceding, 0)
        ranks = spark.createDataFrame(jobs, "c int, part int, at long, k long")     # columns x wanted ranks
        here = counts.join(F.broadcast(ranks.select("c", "part", "at").distinct()), ["c", "part"])
        numbered = here.withColumn("upto", F.col("at") + F.sum("n").over(inside))
        hit = (numbered.join(F.broadcast(ranks.select("c", "part", "k")), ["c", "part"])
               .where((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n"))))
        return {(r["c"], r["k"]): None if r["gap"] else r["d"] if r["v"] is None else r["v"] for r in hit.collect()}
    finally:
        remove_path(df.sparkSession, path)


def quantiles_of(df: DataFrame, cols: Sequence[str], probs: Sequence[float], row: Row, interpolation: str = "linear") -> list[tuple]:
    """``(column, prob, value)`` given the row of :func:`brackets`."""
    size = {i: row[f"_qn{i}"] for i in range(len(cols)) if row[f"_qn{i}"]}
    wanted = {i: sorted({k for p in probs for k in _ranks((n - 1) * p, interpolation)}) for i, n in size.items()}
    picked = _order_statistics(df, cols, {i: _merged(row, i) for i in wanted}, wanted) if wanted else {}
    missed = {i: wanted[i] for i, k in picked if picked[i, k] is None}
    if missed:
        picked |= _order_statistics(df, cols, {i: [(row[f"_ql{i}"], row[f"_qh{i}"])] for i in missed}, missed)
    out = []
    for i, name in enumerate(cols):
        for p in probs:
            value = None
            if i in size:
                h = (size[i] - 1) * p
                lo, hi = _ranks(h, interpolation)
                value = _combine(h, lo, picked[i, lo], picked[i, hi], interpolation)
            out.append((name, p, value))
    return out


def value_type(df: DataFrame, cols: Sequence[str], interpolation: str) -> str:
    """``bigint`` where all columns hold integers and nothing comes between two of them."""
    picks = interpolation not in ("linear", "midpoint")
    return "bigint" if picks and cols and all(is_integral(df, c) for c in cols) else "double"


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    interpolation: str = "linear") -> DataFrame:
    """``(column string, prob double, value)``; nulls and NaN are ignored; a column
    without values gives a null value.  ``value`` is a double, or a long by
    :func:`value_type`.

    ``interpolation``: "linear" (default; Spark ``percentile``, DuckDB
    ``quantile_cont``), "lower", "higher", "midpoint" or "nearest" (the
    nearest-rank rule some single-machine DataFrame libraries use by
    default).
    """
    if interpolation not in INTERPOLATIONS:
        raise ValueError(f"interpolation must be one of {INTERPOLATIONS}")
    cols, probs = list(cols), [float(p) for p in probs]
    kind = value_type(df, cols, interpolation)
    schema = f"column string, prob double, value {kind}"
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    row = brackets(df, cols, probs, df.agg(*sketch_aggregates(df, cols))).first()
    found = quantiles_of(df, cols, probs, row, interpolation)
    if kind == "double":
        found = [(c, p, None if v is None else float(v)) for c, p, v in found]
    return df.sparkSession.createDataFrame(found, schema)
