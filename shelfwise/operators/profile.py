"""Profiles: value counts, shares, distinct counts, summaries, describe,
histograms, correlations, duplicates, top-k and paging, table profiles.

Per-column metrics of one table are computed in one aggregate and turned
into long form; ordering is always explicit and total.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.config import (FEATURE_GROUP_PREFIXES, FEATURE_GROUP_WORDS, IMAGE_URL_EXTENSIONS, KEYWORD_SCREEN_WORDS,
                              MEDIA_PATH_MARK)
from shelfwise.functions import text as TX
from shelfwise.operators.common import cols_or_all, r6, with_one_row
from shelfwise.operators.gramian import pair_correlations
from shelfwise.operators.repeats import maybe_repeated
from shelfwise.operators.quantiles import (INTERPOLATIONS, brackets, exact_quantiles, is_integral, number, quantiles_of,
                                           sketch_aggregates, value_type)


IMAGE_EXTENSION_RE = r"\.(" + "|".join(IMAGE_URL_EXTENSIONS) + r")$"


# --- value counts (D3-D6, F1-F3, G2) -----------------------------------------

def value_counts(df: DataFrame, col: str, by: str = "count") -> DataFrame:
    """(value, count) ordered by count desc then value, or by value."""
    vc = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if by == "count":
        return vc.orderBy(F.desc("count"), F.asc_nulls_first("value"))
    return vc.orderBy(F.asc_nulls_first("value"))


def value_share(df: DataFrame, col: str) -> DataFrame:
    """(value, count, percent of all rows); the total is a one-row aggregate."""
    vc = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = vc.agg(F.sum("count").alias("_total"))
    return (with_one_row(vc, total)
            .select("value", "count", r6(F.col("count") * 100.0 / F.col("_total")).alias("percent")))


def top_k(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    return value_counts(df, col).limit(k)


def bottom_k(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    vc = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return vc.orderBy(F.asc("count"), F.desc_nulls_last("value")).limit(k)


def ranked_page(df: DataFrame, col: str, start: int, size: int = 10) -> DataFrame:
    """Rows ``[start, start + size)`` of the ranked value counts, with rank."""
    vc = value_counts(df, col)
    return vc.offset(start).limit(size)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(col).alias("value")).distinct().orderBy(F.asc_nulls_first("value"))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """(column, distinct) with null counted as one value; ``approx`` takes a
    sketch.  Exact counts go through 16-byte digests of (column, value): one
    shuffle of fixed-size rows, combined before it, however wide the values."""
    cols = cols_or_all(df, cols)
    if approx:
        row = df.agg(*[(F.approx_count_distinct(F.col(f"`{c}`")) + F.max(F.col(f"`{c}`").isNull().cast("int"))).cast("bigint").alias(f"_d{i}")
                       for i, c in enumerate(cols)])
        return row.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("distinct"))
            for i, c in enumerate(cols)])).alias("_x")).select("_x.*")
    counted = _distinct_digests(df, cols).groupBy("_i").agg(F.count(F.lit(1)).alias("distinct"))
    return (counted.select(F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_i") + 1).alias("column"), "distinct"))


def _distinct_digests(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (column index, digest) pairs; null has a digest of its own."""
    def digest(c):
        x = F.col(f"`{c}`")
        text = x if dict(df.dtypes)[c] in ("string", "binary") else x.cast("string")
        return F.when(x.isNotNull(), F.unhex(F.md5(F.concat(F.lit("v"), text)))).otherwise(F.lit(b"null"))
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), digest(c).alias("_h")) for i, c in enumerate(cols)])).alias("_x"))
    return pairs.select("_x.*").distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def limit_first_n(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


# --- numeric summaries (D8-D11, M12) -----------------------------------------

def _summarised(df: DataFrame, cols: Sequence[str], probs: Sequence[float], interpolation: str):
    """One pass for counts, moments, extremes and the brackets of the quantiles, one
    more for these: (row, quantiles by column and probability, type of the extremes)."""
    if interpolation not in INTERPOLATIONS:
        raise ValueError(f"interpolation must be one of {INTERPOLATIONS}")
    once = df.agg(*sketch_aggregates(df, cols), *(a for i, c in enumerate(cols) for a in (
        F.count(f"`{c}`").alias(f"_n{i}"), F.count_if(F.col(f"`{c}`").isNull()).alias(f"_z{i}"), F.avg(number(df, c)).alias(f"_av{i}"),
        F.stddev_samp(number(df, c)).alias(f"_sd{i}"), F.min(number(df, c)).alias(f"_mn{i}"), F.max(number(df, c)).alias(f"_mx{i}"))))
    row = brackets(df, cols, probs, once).first()
    found = {(c, p): v for c, p, v in quantiles_of(df, cols, probs, row, interpolation)}
    return row, found, "bigint" if all(is_integral(df, c) for c in cols) else "double"


def _as(kind: str, value):
    return value if value is None or kind == "bigint" else float(value)


def numeric_summary(df: DataFrame, cols: Sequence[str], interpolation: str = "linear") -> DataFrame:
    """(column, min, max, mean, median, std) per numeric column; ``min`` and ``max``
    are longs if all columns hold integers, else doubles."""
    row, found, kind = _summarised(df, cols, [0.5], interpolation)
    rows = [(c, _as(kind, row[f"_mn{i}"]), _as(kind, row[f"_mx{i}"]), row[f"_av{i}"], _as("double", found[c, 0.5]), row[f"_sd{i}"])
            for i, c in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, f"column string, min {kind}, max {kind}, mean double, median double, std double")
    return out.select("column", "min", "max", *(r6(F.col(c)).alias(c) for c in ("mean", "median", "std")))


def describe(df: DataFrame, cols: Sequence[str], interpolation: str = "linear") -> DataFrame:
    """(column, count, null_count, mean, std, min, q25, q50, q75, max); quartiles exact,
    by the chosen interpolation rule; ``min``, ``max`` and quartiles that lie on a value
    are longs if all columns hold integers, else doubles."""
    row, found, kind = _summarised(df, cols, [0.25, 0.5, 0.75], interpolation)
    picked = value_type(df, cols, interpolation)
    rows = [(c, row[f"_n{i}"], row[f"_z{i}"], row[f"_av{i}"], row[f"_sd{i}"], _as(kind, row[f"_mn{i}"]),
             *(_as(picked, found[c, p]) for p in (0.25, 0.5, 0.75)), _as(kind, row[f"_mx{i}"])) for i, c in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, f"column string, count bigint, null_count bigint, mean double, std double, min {kind}, "
                                                f"q25 {picked}, q50 {picked}, q75 {picked}, max {kind}")
    return out.select("column", "count", "null_count", *(r6(F.col(c)).alias(c) for c in ("mean", "std")), "min",
                      *(r6(F.col(c)).alias(c) for c in ("q25", "q50", "q75")), "max")


def table_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Long profile (column, dtype, count, nulls, distinct, min, max, mean, std).

    min / max as text so every column type fits; mean / std for numeric
    columns only.  One aggregate for all columns, and the distinct counts of
    ``distinct_counts``.
    """
    cols = cols_or_all(df, cols)
    types = dict(df.dtypes)
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        xs = x.cast("int") if types[c] == "boolean" else x
        aggs += [F.count(x).cast("bigint").alias(f"_n{i}"),
                 F.count_if(x.isNull()).cast("bigint").alias(f"_z{i}"),
                 F.min(xs).alias(f"_mn{i}"), F.max(xs).alias(f"_mx{i}")]
        if types[c] in numeric or types[c] == "boolean":
            aggs += [F.avg(xs).alias(f"_av{i}"), F.stddev_samp(xs).alias(f"_sd{i}")]
    row = df.agg(*aggs)
    items = []
    for i, c in enumerate(cols):
        has_num = types[c] in numeric or types[c] == "boolean"
        def as_text(colname):
            v = F.col(colname)
            return (v.cast("double").cast("string") if types[c] in ("double", "float")
                    else v.cast("string"))
        items.append(F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
            F.col(f"_n{i}").alias("count"), F.col(f"_z{i}").alias("nulls"),
            as_text(f"_mn{i}").alias("min"), as_text(f"_mx{i}").alias("max"),
            (r6(F.col(f"_av{i}")) if has_num else F.lit(None).cast("double")).alias("mean"),
            (r6(F.col(f"_sd{i}")) if has_num else F.lit(None).cast("double")).alias("std")))
    long = row.select(F.explode(F.array(*items)).alias("_x")).select("_x.*")
    distinct = distinct_counts(df, cols).withColumnRenamed("column", "_c")
    return (long.join(distinct, F.col("column") == F.col("_c"), "left")
            .select("column", "dtype", "count", "nulls", F.coalesce("distinct", F.lit(0).cast("bigint")).alias("distinct"), "min", "max", "mean", "std"))


def dtype_listing(df: DataFrame) -> DataFrame:
    """(position, column, dtype) from the schema (no job)."""
    rows = [(i, c, t) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


# --- histogram (D17) -----------------------------------------------------------

def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """(bin, lower, upper, count) of equal-width bins; the last bin is closed.

    Every bin is listed, empty ones with count 0.  A constant column puts every
    value in bin 0; a column without values has no bins.
    """
    x = F.col(col).cast("double")
    mm = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    span = F.col("_mx") - F.col("_mn")
    b = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_mn")) / span * bins), F.lit(bins - 1))).cast("int")
    h = (with_one_row(df.select(col).where(F.col(col).isNotNull()), mm)
         .groupBy(b.alias("_bin")).agg(F.count(F.lit(1)).alias("_count")))
    every = mm.where(F.col("_mn").isNotNull()).select("_mn", "_mx", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    h = every.join(h, F.col("bin") == F.col("_bin"), "left").withColumn("count", F.coalesce("_count", F.lit(0).cast("bigint")))
    width = (F.col("_mx") - F.col("_mn")) / bins
    return h.select("bin", r6(F.col("_mn") + F.col("bin") * width).alias("lower"),
                    r6(F.col("_mn") + (F.col("bin") + 1) * width).alias("upper"), "count")


# --- correlations (D13, D14, M13) ----------------------------------------------

def correlation_matrix(df: DataFrame, cols: Sequence[str], lower_only: bool = True) -> DataFrame:
    """(column_a, column_b, corr) for pairs a before b (or all ordered pairs); null
    where a column is constant."""
    cols = list(cols)
    corr = pair_correlations(df, [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]])
    found = [(a, b, v) for (a, b), v in corr.items()]
    if not lower_only:
        found += [(b, a, v) for (a, b), v in corr.items()] + [(a, a, 1.0) for a in cols]
    return (df.sparkSession.createDataFrame(found, "column_a string, column_b string, corr double")
            .withColumn("corr", r6(F.col("corr"))))


def target_correlations(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    corr = pair_correlations(df, [(c, target) for c in cols])
    return (df.sparkSession.createDataFrame([(c, target, corr[c, target]) for c in cols], "column string, target string, corr double")
            .withColumn("corr", r6(F.col("corr"))))


def numeric_feature_columns(df: DataFrame, fixed: Sequence[str],
                            prefixes: Sequence[str] = ("has_", "starts_with_")) -> list[str]:
    """Fixed names present in ``df`` plus columns with the given prefixes."""
    have = set(df.columns)
    return [c for c in fixed if c in have] + [c for c in df.columns if c.startswith(tuple(prefixes))]


# --- text statistics (D15, D16, D18, B25, B26) ----------------------------------

def title_stats(df: DataFrame) -> DataFrame:
    """Sums of the title flags and mean length / words (feature table)."""
    return df.agg(
        F.count_if("has_subtitle").cast("bigint").alias("has_subtitle"),
        F.count_if("has_series").cast("bigint").alias("has_series"),
        F.count_if("starts_with_the").cast("bigint").alias("starts_with_the"),
        F.count_if("has_numbers").cast("bigint").alias("has_numbers"),
        r6(F.avg("title_length")).alias("avg_title_length"),
        r6(F.avg("title_word_count")).alias("avg_word_count"))


def text_length_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, min_length, max_length, mean_length) in characters."""
    row = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.min(F.char_length(c)).cast("bigint").alias(f"_mn{i}"),
        F.max(F.char_length(c)).cast("bigint").alias(f"_mx{i}"),
        F.avg(F.char_length(c)).alias(f"_av{i}"))])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_mn{i}").alias("min_length"),
                 F.col(f"_mx{i}").alias("max_length"), r6(F.col(f"_av{i}")).alias("mean_length"))
        for i, c in enumerate(cols)])).alias("_x")).select("_x.*")


def title_pattern_counts(df: DataFrame, col: str = "title") -> DataFrame:
    """Rows with digits, special characters, 'The ' prefix, ':' and '('."""
    t = F.col(col)
    return df.agg(
        F.count_if(TX.has_digit(t)).cast("bigint").alias("with_numbers"),
        F.count_if(TX.has_special(t)).cast("bigint").alias("with_special"),
        F.count_if(TX.starts_with_the(t)).cast("bigint").alias("starts_with_the"),
        F.count_if(TX.has_subtitle(t)).cast("bigint").alias("with_colon"),
        F.count_if(TX.has_series(t)).cast("bigint").alias("with_paren"))


def keyword_screen(df: DataFrame, col: str, words: Sequence[str] = KEYWORD_SCREEN_WORDS) -> DataFrame:
    """Rows whose lower-cased value contains any of ``words``."""
    low = F.lower(F.col(col))
    cond = reduce(lambda a, b: a | b, [low.contains(w) for w in words])
    return df.where(cond)


def url_checks(df: DataFrame, image: str = "image", page: str = "product_page") -> DataFrame:
    """One row: image URLs under /media/, without an image extension, and
    distinct image / page URLs."""
    i = F.col(image)
    return df.agg(
        F.count_if(i.contains(MEDIA_PATH_MARK)).cast("bigint").alias("media_urls"),
        F.count_if(~i.rlike(IMAGE_EXTENSION_RE)).cast("bigint").alias("no_image_extension"),
        F.count_distinct(i).cast("bigint").alias("distinct_images"),
        F.count_distinct(page).cast("bigint").alias("distinct_pages"))


def extreme_by_length(df: DataFrame, col: str = "title") -> DataFrame:
    """Longest and shortest value (ties broken by the value itself)."""
    n = F.char_length(col)
    row = df.agg(F.max(F.struct(n.alias("len"), F.col(col).alias("v"))).alias("_mx"),
                 F.min(F.struct(n.alias("len"), F.col(col).alias("v"))).alias("_mn"))
    return row.select(F.explode(F.array(
        F.struct(F.lit("longest").alias("which"), F.col("_mx.v").alias("value"),
                 F.col("_mx.len").cast("bigint").alias("length")),
        F.struct(F.lit("shortest").alias("which"), F.col("_mn.v").alias("value"),
                 F.col("_mn.len").cast("bigint").alias("length")))).alias("_x")).select("_x.*")


# --- duplicates (E1, E2) ---------------------------------------------------------

def duplicate_rows(df: DataFrame, col: str) -> DataFrame:
    """Every row whose ``col`` value occurs more than once (all copies kept;
    nulls form one group).

    A bitmap of repeated hashes drops nearly all single rows before anything but
    8-byte hashes is shuffled (``repeats``); the rest is counted by the whole value, so
    a collision cannot make a false duplicate.  Counting combines before the shuffle, so
    a hot value is one row per task; the semi-join is left to the planner, which can
    split skewed partitions.
    """
    left = maybe_repeated(df, [col])
    repeated = (left.groupBy(F.col(col).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_key"))
    return left.join(repeated, F.col(col).eqNullSafe(F.col("_key")), "left_semi")


# --- stage comparison (D19) ---------------------------------------------------------

def stage_comparison(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, rows, columns) for each named table; columns is plan-time."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
             .select(F.lit(name).alias("stage"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
             for name, df in stages]
    return union_all(parts)


def group_columns(columns: Sequence[str], words: Mapping[str, Sequence[str]],
                  prefixes: Mapping[str, str]) -> dict[str, list[str]]:
    """Column names by group (plan time).  A group is given by words, one of
    which its names hold, or by a prefix; a name may be in several groups."""
    out = {group: [c for c in columns if any(w in c for w in marks)] for group, marks in words.items()}
    out.update({group: [c for c in columns if c.startswith(p)] for group, p in prefixes.items()})
    return out


def feature_groups(columns: Sequence[str], base: Sequence[str]) -> dict[str, list[str]]:
    """The added columns of a feature table by feature group."""
    return group_columns(added_columns(columns, base), FEATURE_GROUP_WORDS, FEATURE_GROUP_PREFIXES)


def added_columns(after: Sequence[str], before: Sequence[str]) -> list[str]:
    b = set(before)
    return [c for c in after if c not in b]
