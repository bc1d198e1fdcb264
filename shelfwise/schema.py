"""Table contracts and the required-column check (plan time, no job)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwise.config import FEATURE_COLUMNS, PROCESSED_COLUMNS, RAW_COLUMNS

RAW_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("product_page", T.StringType()),
    T.StructField("availability", T.StringType()),
    T.StructField("stock", T.IntegerType()),
    T.StructField("image_base64", T.StringType()),
])

PROCESSED_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType())]
    + [f if f.name != "availability" else T.StructField("availability", T.IntegerType())
       for f in RAW_SCHEMA.fields]
)


class SchemaError(ValueError):
    pass


def raw_columns() -> list[str]:
    return list(RAW_COLUMNS)


def processed_columns() -> list[str]:
    return list(PROCESSED_COLUMNS)


def feature_columns() -> list[str]:
    """Processed columns plus the ten named features (one-hot columns vary)."""
    return list(PROCESSED_COLUMNS) + list(FEATURE_COLUMNS)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def has_columns(df: DataFrame, required: Iterable[str]) -> bool:
    return not missing_columns(df, required)


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """Raise listing every missing column; returns ``df`` for chaining."""
    missing = missing_columns(df, required)
    if missing:
        raise SchemaError(f"{what} lacks required columns: {', '.join(missing)}")
    return df
