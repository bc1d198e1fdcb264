"""The row-wise cleaning and feature operators (bands, labels, title
features, category replacement, flag encoding, parsers) are plain column
expressions, so they apply to a streaming DataFrame unchanged.  Operators
that need a whole-table statistic (popularity's max stock, the one-hot
vocabulary, quantiles, gates) are batch-only.

``run_available_now`` drives a file-source stream to completion with the
``availableNow`` trigger: every file present at start is processed in
bounded micro-batches, progress is kept in a checkpoint under the shared
checkpoint folder, and a restarted job resumes where it stopped.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfwise.config import PipelineConfig
from shelfwise.operators import clean as C
from shelfwise.operators import features as FE
from shelfwise.session import staging_path


def row_features(df: DataFrame, config: PipelineConfig = PipelineConfig(),
                 title: str | None = "title", price: str | None = "price",
                 rating: str | None = "rating", stock: str | None = "stock",
                 category: str | None = "category", flag: str | None = "availability") -> DataFrame:
    """Apply every stateless operator whose input column is present."""
    if category and category in df.columns:
        df = C.replace_categories(df, category, config.problematic_categories, config.default_category)
    if flag and flag in df.columns:
        df = C.encode_flag(df, flag)
    if price and price in df.columns:
        df = FE.add_price_range(df, price, config.price_bands)
    if title and title in df.columns:
        df = FE.add_title_features(df, title)
    if rating and rating in df.columns:
        df = FE.add_rating_category(df, rating)
    if stock and stock in df.columns:
        df = FE.add_stock_level(df, stock, config.stock_bands)
    return df


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int = 100, base_path: str | None = None) -> DataFrame:
    """Streaming scan of a folder (or a file glob under ``base_path``)."""
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.load(path)


def run_available_now(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                      sink_path: str | None = None, checkpoint: str | None = None,
                      name: str = "rowwise") -> str:
    """Transform the stream, append to a Parquet sink, wait until every
    available file is processed; returns the sink path."""
    spark = stream.sparkSession
    stamp = time.time_ns()
    sink_path = sink_path or staging_path(spark, f"stream-{name}-{stamp}")
    checkpoint = checkpoint or staging_path(spark, f"stream-{name}-{stamp}-checkpoint")
    q = (transform(stream).writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return sink_path


def single_file_glob(path: str) -> str:
    """A glob matching exactly one file, so the file source (which wants a
    folder or a glob) can stream a single Parquet file."""
    path = path.rstrip("/")
    return path[:-1] + "[" + path[-1] + "]"


def stream_features_to_table(spark: SparkSession, path: str, schema: T.StructType,
                             config: PipelineConfig = PipelineConfig(), **cols) -> DataFrame:
    """Batch view of the streamed, feature-enriched rows."""
    out = run_available_now(file_stream(spark, path, schema),
                            lambda df: row_features(df, config, **cols), name="features")
    return spark.read.parquet(out)
