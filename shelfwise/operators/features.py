"""Feature operators: bands, title features, rating labels, popularity,
one-hot encoding, IQR outlier filter, min-max scaling, split, selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.config import (IQR_FACTOR, ONE_HOT_COLUMNS, ONE_HOT_FORMS, POPULARITY_RATING_WEIGHT, POPULARITY_STOCK_WEIGHT, RATING_LABELS,
                              RATING_SCALE, Bands)
from shelfwise.functions import bands as B
from shelfwise.functions import text as TX
from shelfwise.operators.common import r6, with_one_row
from shelfwise.operators.gramian import pair_correlations
from shelfwise.operators.quantiles import exact_quantiles


class VocabularyError(ValueError):
    pass


def add_price_range(df: DataFrame, col: str = "price", bands: Bands | None = None,
                    out: str = "price_range") -> DataFrame:
    return df.withColumn(out, B.band(col, bands or Bands.price()))


def add_stock_level(df: DataFrame, col: str = "stock", bands: Bands | None = None,
                    out: str = "stock_level") -> DataFrame:
    return df.withColumn(out, B.band(col, bands or Bands.stock()))


def add_rating_category(df: DataFrame, col: str = "rating", out: str = "rating_category") -> DataFrame:
    return df.withColumn(out, B.label_map(col, RATING_LABELS))


def add_title_features(df: DataFrame, col: str = "title") -> DataFrame:
    return df.select("*", *TX.title_feature_columns(col))


def add_popularity_score(df: DataFrame, rating: str = "rating", stock: str = "stock",
                         out: str = "popularity_score") -> DataFrame:
    """(rating / 5) * 0.7 + (stock / max stock) * 0.3.

    The maximum is a one-row aggregate attached as a scalar subquery (run
    once; no join, no un-partitioned window).  max stock 0 gives a null
    score.
    """
    mx = df.agg(F.max(stock).alias("_max_stock"))
    score = ((F.col(rating) / F.lit(RATING_SCALE)) * F.lit(POPULARITY_RATING_WEIGHT)
             + F.try_divide(F.col(stock).cast("double"), F.col("_max_stock").cast("double"))
             * F.lit(POPULARITY_STOCK_WEIGHT))
    return with_one_row(df, mx).withColumn(out, score).drop("_max_stock")


def category_vocabulary(df: DataFrame, col: str = "category", most: int = ONE_HOT_COLUMNS) -> list[str]:
    """Sorted distinct non-null values; at most ``most + 1`` of them are read, and more
    than ``most`` are an error, for they would become as many columns."""
    vals = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct()
            .orderBy(col).limit(most + 1).collect()]
    if len(vals) > most:
        raise VocabularyError(f"more than {most} values in {col}: take form='map', or raise the limit")
    return vals


def one_hot_names(vocabulary: Sequence[str], prefix: str = "category_") -> list[str]:
    names = [prefix + TX.column_slug(v) for v in vocabulary]
    seen: dict[str, str] = {}
    for v, n in zip(vocabulary, names):
        if n in seen:
            raise VocabularyError(f"values {seen[n]!r} and {v!r} give the same column {n}")
        seen[n] = v
    return names


def add_one_hot(df: DataFrame, col: str = "category", vocabulary: Sequence[str] | None = None,
                prefix: str = "category_", form: str = "columns", most: int = ONE_HOT_COLUMNS) -> DataFrame:
    """``form="columns"``: one 0/1 int column per vocabulary value, in sorted order;
    null -> all 0.  ``form="map"``: one map column ``<prefix>one_hot`` with the single
    entry {column name: 1} (empty for null, or outside a given vocabulary), whatever
    the number of categories.  The form is the caller's; the data never change it.
    """
    if form not in ONE_HOT_FORMS:
        raise ValueError(f"form must be one of {ONE_HOT_FORMS}")
    if form == "map":
        name = F.concat(F.lit(prefix), TX.column_slug_of(col))
        held = F.col(col).isNotNull() if vocabulary is None else F.col(col).isin(*vocabulary)
        clash = df.where(held).groupBy(name.alias("n")).agg(F.min(col).alias("a"), F.max(col).alias("b")).where("a <> b").first()
        if clash is not None:
            raise VocabularyError(f"values {clash['a']!r} and {clash['b']!r} give the same column {clash['n']}")
        entry = F.when(held, F.create_map(name, F.lit(1))).otherwise(F.create_map().cast("map<string,int>"))
        return df.select("*", entry.alias(f"{prefix}one_hot"))
    vocab = list(vocabulary) if vocabulary is not None else category_vocabulary(df, col, most)
    names = one_hot_names(vocab, prefix)
    c = F.col(col)
    return df.select("*", *[F.coalesce((c == F.lit(v)).cast("int"), F.lit(0)).alias(n)
                            for v, n in zip(vocab, names)])


def one_hot_sums(df: DataFrame, prefix: str = "category_") -> DataFrame:
    """(column, total) for every one-hot column, from one aggregate; of the
    sparse form, for every name that occurs."""
    sparse = f"{prefix}one_hot"
    if dict(df.dtypes).get(sparse, "").startswith("map"):
        return (df.select(F.explode(sparse).alias("column", "one")).groupBy("column")
                .agg(F.sum("one").cast("bigint").alias("total")))
    names = [c for c in df.columns if c.startswith(prefix)]
    row = df.agg(*[F.sum(n).cast("bigint").alias(n) for n in names])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("total")) for n in names]))
        .alias("_r")).select("_r.*")


def iqr_bounds(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR,
               interpolation: str = "linear") -> DataFrame:
    """(column, q1, q3, lower, upper) from exact quartiles (linear by
    default; see ``exact_quantiles`` for the other rules)."""
    q = exact_quantiles(df, cols, [0.25, 0.75], interpolation=interpolation)
    wide = q.groupBy("column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return wide.select("column", "q1", "q3",
                       (F.col("q1") - F.lit(factor) * iqr).alias("lower"),
                       (F.col("q3") + F.lit(factor) * iqr).alias("upper"))


def _bounds_row(df: DataFrame, cols: Sequence[str], factor: float, interpolation: str) -> DataFrame:
    b = iqr_bounds(df, cols, factor, interpolation)
    return b.groupBy().agg(*[
        agg for c in cols for agg in (
            F.max(F.when(F.col("column") == c, F.col("lower"))).alias(f"_lo_{c}"),
            F.max(F.when(F.col("column") == c, F.col("upper"))).alias(f"_hi_{c}"))])


def iqr_outlier_flag(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR,
                     out: str = "is_outlier", interpolation: str = "linear") -> DataFrame:
    """Adds ``out``: true when any listed column is outside [Q1-f*IQR, Q3+f*IQR]."""
    cols = list(cols)
    joined = with_one_row(df, _bounds_row(df, cols, factor, interpolation))
    cond = F.lit(False)
    for c in cols:
        cond = cond | (F.col(c) < F.col(f"_lo_{c}")) | (F.col(c) > F.col(f"_hi_{c}"))
    return joined.withColumn(out, F.coalesce(cond, F.lit(False))).drop(
        *[f"_{s}_{c}" for c in cols for s in ("lo", "hi")])


def iqr_filter(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR,
               interpolation: str = "linear") -> DataFrame:
    """Rows inside the IQR fences of every listed column (bounds computed
    once on the input).  A null value is kept."""
    flagged = iqr_outlier_flag(df, cols, factor, "_out", interpolation)
    return flagged.where(~F.col("_out")).drop("_out")


def iqr_outliers(df: DataFrame, col: str, factor: float = IQR_FACTOR,
                 interpolation: str = "linear") -> DataFrame:
    """Rows outside the fences of one column."""
    flagged = iqr_outlier_flag(df, [col], factor, "_out", interpolation)
    return flagged.where(F.col("_out")).drop("_out")


def minmax_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_minmax") -> DataFrame:
    """(x - min) / (max - min) as ``<col>_minmax``; constant column -> 0.0."""
    cols = list(cols)
    mm = df.agg(*[a for c in cols for a in (F.min(c).cast("double").alias(f"_mn_{c}"),
                                            F.max(c).cast("double").alias(f"_mx_{c}"))])
    out = with_one_row(df, mm)
    for c in cols:
        span = F.col(f"_mx_{c}") - F.col(f"_mn_{c}")
        scaled = F.when(span == 0, F.lit(0.0)).otherwise(
            F.try_divide(F.col(c).cast("double") - F.col(f"_mn_{c}"), span))
        out = out.withColumn(c + suffix, scaled)
    return out.drop(*[f"_{s}_{c}" for c in cols for s in ("mn", "mx")])


def split_bucket(key_cols: Sequence[str]):
    """Deterministic 0..99 bucket from md5 of the key (not partition-dependent)."""
    from shelfwise.operators.clean import key_digest
    return F.pmod(F.conv(F.substring(key_digest(key_cols), 1, 8), 16, 10).cast("bigint"), F.lit(100))


def train_test_split(df: DataFrame, key_cols: Sequence[str], train_percent: int = 80
                     ) -> tuple[DataFrame, DataFrame]:
    b = split_bucket(key_cols)
    return df.where(b < train_percent), df.where(b >= train_percent)


def with_split_label(df: DataFrame, key_cols: Sequence[str], train_percent: int = 80,
                     out: str = "split") -> DataFrame:
    b = split_bucket(key_cols)
    return df.withColumn(out, F.when(b < train_percent, F.lit("train")).otherwise(F.lit("test")))


def feature_selection(df: DataFrame, target: str, candidates: Sequence[str] | None = None,
                      threshold: float = 0.1) -> tuple[DataFrame, list[str]]:
    """Keep numeric columns whose |corr with target| >= threshold, plus target.

    Only the sums of ``gramian.pair_correlations`` reach the driver.
    """
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint", "boolean"}
    if candidates is None:
        candidates = [c for c, t in df.dtypes if t in numeric and c != target]
    corr = pair_correlations(df, [(c, target) for c in candidates])
    keep = [c for c in candidates if (v := corr[c, target]) is not None and round(abs(v), 6) >= threshold]
    return df.select(*keep, target), keep


def selection_report(df: DataFrame, target: str, candidates: Sequence[str],
                     threshold: float = 0.1) -> DataFrame:
    """(column, corr, selected) for each candidate."""
    corr = pair_correlations(df, [(c, target) for c in candidates])
    long = df.sparkSession.createDataFrame([(c, corr[c, target]) for c in candidates], "column string, corr double")
    return (long.withColumn("corr", r6(F.col("corr")))
            .withColumn("selected", F.coalesce(F.abs("corr") >= threshold, F.lit(False))))
