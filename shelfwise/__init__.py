"""shelfwise: catalogue cleaning, feature and profiling operators on Spark.

Every operator takes a DataFrame plus column names and returns a DataFrame
built from native Spark expressions, so Catalyst can prune, push down and
fuse the work.  Sub-packages:

- ``sources``   – CSV / Parquet scan and sink, export encoding, HTML record
                  extraction from a table of stored pages.
- ``functions`` – column-expression builders (bands, text flags, parsers,
                  URL helpers).
- ``operators`` – cleaning, features, quality gates, profiles.
- ``plans``     – the cleaning / feature / full pipelines and the run report.
- ``streaming`` – the row-wise feature operators attached to a stream.
"""

from shelfwise.config import Bands, PipelineConfig

__all__ = ["Bands", "PipelineConfig"]
