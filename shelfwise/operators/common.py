"""Small plan helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import staging_path


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet under the shared checkpoint folder and read again, and
    its path (for ``session.remove_path``)."""
    path = staging_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row global aggregate to every row.

    The aggregate becomes one scalar subquery (a struct): Spark runs it once
    and hands its single value to every task inside the projection, so
    there is no join, no shuffle of ``df`` and nothing that grows with it.
    """
    names = list(one_row.columns)
    scalar = one_row.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_one")).scalar()
    return (df.withColumn("_one", scalar)
            .select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("_one").getField(c).alias(c) for c in names]))


def r6(col: Column) -> Column:
    """Round a floating result to 6 digits (engines differ in the last bits)."""
    return F.round(col, 6)


def cols_or_all(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols else list(df.columns)
