"""Cleaning operators: surrogate id, category replacement, flag encoding,
de-duplication, text and locale price normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import DEFAULT_CATEGORY, PROBLEMATIC_CATEGORIES
from shelfwise.functions import text as TX
from shelfwise.operators.repeats import maybe_repeated

# exact copies of one row are regenerated in chunks of this many rows, so a
# hot duplicate set is spread over many tasks
COPY_CHUNK = 100_000


def key_digest(cols: Sequence[str]) -> Column:
    """md5 hex of the key parts.  Each part is written with its length, null as
    a mark of its own, so different keys never give the same text."""
    def part(c):
        x = F.col(c).cast("string")
        return F.coalesce(F.concat(F.char_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
    return F.md5(F.concat(*[part(c) for c in cols]))


def id_key(key_cols: Sequence[str], hex_len: int = 32) -> Column:
    """The part of the id that stands for the key."""
    return F.substring(key_digest(key_cols), 1, hex_len)


def add_surrogate_id(df: DataFrame, key_cols: Sequence[str], prefix: str = "book_",
                     id_col: str = "id", hex_len: int = 32,
                     content_cols: Sequence[str] | None = None,
                     keys_known_unique: bool = False) -> DataFrame:
    """Deterministic id ``prefix + md5(key)[:hex_len]`` as first column.

    Rows that share this part (an equal key, or a short one that collides) get
    ``_<md5(content)>_<n>`` appended, where n numbers exact copies.  All parts are
    content-based, so a retried or recomputed task yields the same ids.

    Shared ids are found by one count of the id itself, combined before the
    shuffle; exact copies are counted the same way and regenerated in chunks, so
    no key, however hot, is gathered into one task or window.  When no id is
    shared (or the caller's own count of the same digests has shown it,
    ``keys_known_unique``) the id is a plain projection.
    """
    cols = list(df.columns)
    content_cols = list(content_cols or cols)
    short = id_key(key_cols, hex_len)
    base_id = F.concat(F.lit(prefix), F.col("_k"))
    keyed = df.withColumn("_k", short)
    if keys_known_unique:
        return keyed.select(base_id.alias(id_col), *cols)
    shared = (keyed.groupBy("_k").agg(F.count(F.lit(1)).alias("_kn"))
              .where(F.col("_kn") > 1).select(F.col("_k").alias("_s")))
    if shared.isEmpty():
        return keyed.select(base_id.alias(id_col), *cols)
    marked = keyed.join(shared, F.col("_k") == F.col("_s"), "left")
    unique = marked.where(F.col("_s").isNull()).select(base_id.alias(id_col), *cols)
    copies = (marked.where(F.col("_s").isNotNull())
              .groupBy("_k", *cols).agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_h", key_digest(content_cols))
              .withColumn("_chunk", F.explode(F.sequence(
                  F.lit(0).cast("bigint"), F.floor((F.col("_c") - 1) / COPY_CHUNK).cast("bigint"))))
              .repartition("_k", "_h", "_chunk")
              .withColumn("_i", F.explode(F.sequence(
                  F.col("_chunk") * COPY_CHUNK + 1,
                  F.least((F.col("_chunk") + 1) * COPY_CHUNK, F.col("_c")))))
              .select(F.concat(base_id, F.lit("_"), F.col("_h"), F.lit("_"),
                               F.col("_i").cast("string")).alias(id_col), *cols))
    return unique.unionByName(copies)


def replace_categories(df: DataFrame, col: str = "category",
                       problematic: Sequence[str] = PROBLEMATIC_CATEGORIES,
                       default: str = DEFAULT_CATEGORY) -> DataFrame:
    """Listed values -> default; null stays null.  Same column position."""
    c = F.col(col)
    new = F.when(c.isin(*problematic), F.lit(default)).otherwise(c).alias(col)
    return df.select(*[new if x == col else F.col(x) for x in df.columns])


def replaced_count(col: str = "category", problematic: Sequence[str] = PROBLEMATIC_CATEGORIES) -> Column:
    """Aggregate: rows whose value will be replaced."""
    return F.count_if(F.col(col).isin(*problematic))


def category_problem_counts(df: DataFrame, col: str = "category",
                            problematic: Sequence[str] = PROBLEMATIC_CATEGORIES) -> DataFrame:
    """(value, count) for each listed value present: one filtered groupBy."""
    return (df.where(F.col(col).isin(*problematic)).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("count")))


def encode_flag(df: DataFrame, col: str = "availability", true_text: str = "yes") -> DataFrame:
    """lower(x) == true_text -> 1, anything else (null too) -> 0, in place."""
    c = F.col(col)
    new = F.when(F.lower(c) == true_text.lower(), F.lit(1)).otherwise(F.lit(0)).alias(col)
    return df.select(*[new if x == col else F.col(x) for x in df.columns])


def flag_counts(df: DataFrame, col: str = "availability") -> DataFrame:
    """(value, count) of the encoded flag."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate rows removed.  Over a ``subset``, the smallest row by the
    other columns, in their order, stays, so the result does not depend on how
    the data lie.  Copies combine before the shuffle."""
    if subset is None:
        return df.distinct()
    rest = [c for c in df.columns if c not in set(subset)]
    if not rest:
        return df.distinct()
    least = df.groupBy(*subset).agg(F.min(F.struct(*rest)).alias("_least"))
    return least.select(*subset, "_least.*").select(*df.columns)


def duplicates_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Each duplicated row (over ``subset``, default all columns) once, with
    its number of copies, from one count that combines before the shuffle.  Single
    rows are dropped before, by a bitmap of repeated hashes (``repeats``)."""
    cols = list(subset or df.columns)
    return (maybe_repeated(df.select(*(F.col(f"`{c}`") for c in cols)), cols).groupBy(*(F.col(f"`{c}`") for c in cols)).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def normalize_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    wanted = set(cols)
    return df.select(*[TX.normalize_text(x).alias(x) if x in wanted else F.col(x)
                       for x in df.columns])


def parse_price_column(df: DataFrame, col: str = "price") -> DataFrame:
    """Locale-aware price text -> double, in place."""
    return df.select(*[TX.parse_price_locale(x).alias(x) if x == col else F.col(x)
                       for x in df.columns])
