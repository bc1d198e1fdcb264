"""CSV / Parquet scan and sink, raw export encoding, input admission.

CSV options: an explicit schema (no inference pass); ``nullValue`` set to a
character that never occurs so a quoted empty field stays '' while an
unquoted empty field is null; ``escape='"'`` so doubled quotes inside a
field do not tear the row apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.config import RAW_COLUMNS
from shelfwise.schema import RAW_SCHEMA, SchemaError, missing_columns
from shelfwise.session import staging_path
from shelfwise.sources import publish

NEVER_NULL_TEXT = "\u0000"
BYTE_ORDER_MARK = "\ufeff"
#: Spark's CSV writers cut outer blanks of a value unless told not to.
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _reader(spark: SparkSession, multiline: bool, mode: str) -> DataFrameReader:
    return (spark.read.option("header", True).option("escape", '"').option("nullValue", NEVER_NULL_TEXT)
            .option("mode", mode).option("multiLine", multiline))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW_SCHEMA,
             multiline: bool = False) -> DataFrame:
    """Header CSV with an explicit schema; ``multiline`` for fields that
    contain line breaks (one file is then read by one task).  Strict: a line that
    does not fit the schema fails the job that meets it (see :func:`read_quarantined`)."""
    reader = _reader(spark, multiline, "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def _free_name(schema: T.StructType, name: str) -> str:
    while name.lower() in {c.lower() for c in schema.names}:
        name = "_" + name
    return name


def read_quarantined(spark: SparkSession, path: str, bad_path: str, schema: T.StructType = RAW_SCHEMA,
                     multiline: bool = False) -> tuple[DataFrame, dict[str, int], str]:
    """The good lines of a CSV, ``{"rows", "bad_rows"}``, and the staging path that
    holds the good lines.

    The file is parsed once: lines that do not fit the schema (a value of another type,
    too few or too many fields) are kept whole and written, in the same job as the good
    ones and counted by it, to a folder of their own, which takes the place of
    ``bad_path`` as a table ``(file, line)``; it is empty if there were none.
    """
    line, bad = _free_name(schema, "line"), _free_name(schema, "bad")
    wide = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + [T.StructField(line, T.StringType())])
    parsed = (_reader(spark, multiline, "PERMISSIVE").option("columnNameOfCorruptRecord", line)
              .schema(wide).option("enforceSchema", False).csv(path))
    file = _free_name(wide, "file")
    marked = parsed.withColumn(file, F.when(F.col(line).isNotNull(), F.col("_metadata.file_path"))).withColumn(bad, F.col(line).isNotNull())
    seen = Observation("quarantine")
    base = staging_path(spark, f"quarantine-{uuid.uuid4().hex}")
    (marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(bad)).alias("bad_rows"))
     .write.partitionBy(bad).parquet(base))
    counts = {k: int(v) for k, v in seen.get.items()}

    def part(which: str, columns: T.StructType, rows: int) -> DataFrame:
        return spark.read.schema(columns).parquet(f"{base}/{bad}={which}") if rows else spark.createDataFrame([], columns)

    refused = part("true", T.StructType([T.StructField(file, T.StringType()), T.StructField(line, T.StringType())]), counts["bad_rows"])
    publish.replace_table(refused.toDF("file", "line"), bad_path)
    return part("false", schema, counts["rows"] - counts["bad_rows"]), counts, base


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """Overwrite ``path`` with a header CSV; '' and null stay apart on re-read."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quoteAll", quote_all).option("emptyValue", '""').option("nullValue", "").options(**KEEP_BLANKS)
     .csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def validate_input(spark: SparkSession, path: str, schema: T.StructType | None = RAW_SCHEMA,
                   required: Sequence[str] = RAW_COLUMNS, bad_rows: str = "fail") -> tuple[bool, str]:
    """Admission: path readable as CSV, has the required columns, not empty.

    Reads at most one row, never the whole file.  With
    ``bad_rows="quarantine"`` a first line that cannot be parsed is admitted.
    """
    if not path.lower().rstrip("/").endswith(".csv"):
        return False, "not a .csv path"
    try:
        df = read_csv(spark, path, schema)
        if bad_rows == "quarantine" and schema is not None:
            df = _reader(spark, False, "PERMISSIVE").schema(schema).option("enforceSchema", False).csv(path)
        miss = missing_columns(df, required)
        if miss:
            return False, "missing columns: " + ", ".join(miss)
        if df.first() is None:      # all columns of one row, so a strict reader meets its values
            return False, "empty"
    except PySparkException as exc:     # missing path, unreadable
        return False, f"unreadable: {exc.getMessage() if hasattr(exc, 'getMessage') else exc}"
    except Py4JJavaError as exc:        # a first row that cannot be parsed
        return False, f"unreadable: {exc.java_exception.getMessage()}"
    return True, "ok"


def readable(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table stands at ``path`` and has a row."""
    try:
        return not spark.read.parquet(path).isEmpty()
    except AnalysisException:
        return False


def require_input(spark: SparkSession, path: str, what: str = "input", **kw) -> None:
    ok, why = validate_input(spark, path, **kw)
    if not ok:
        raise SchemaError(f"{what} {path}: {why}")


# --- raw export encoding (A3) --------------------------------------------------

EXPORT_COLUMNS = RAW_COLUMNS


def export_encode(df: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS,
                  flag: str = "availability") -> DataFrame:
    """Fixed column order, every field as text: null -> '', the boolean flag
    -> 'yes' / 'no' / ''."""
    out = []
    for c in columns:
        x = F.col(c)
        if c == flag:
            out.append(F.when(x, F.lit("yes")).when(~x, F.lit("no")).otherwise(F.lit("")).alias(c))
        else:
            out.append(F.coalesce(x.cast("string"), F.lit("")).alias(c))
    return df.select(*out)


def export_missing_counts(df: DataFrame, flag: str = "availability", stock: str = "stock") -> DataFrame:
    """One row: rows with a missing flag and with a missing stock."""
    return df.agg(F.count_if(F.col(flag).isNull()).cast("bigint").alias("missing_availability"),
                  F.count_if(F.col(stock).isNull()).cast("bigint").alias("missing_stock"),
                  F.count(F.lit(1)).cast("bigint").alias("rows"))


def export_lines(df: DataFrame) -> DataFrame:
    """CSV lines (``value``) of text columns, every field in quotes; the first line of
    each partition follows a byte-order mark and the header, so it opens its file."""
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"quoteAll": "true", "escape": '"', "emptyValue": '""', **KEEP_BLANKS})
    header = BYTE_ORDER_MARK + ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
    # the lower 33 bits number the rows of a partition
    opens = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return df.select(F.when(opens, F.concat(F.lit(header + "\r\n"), line)).otherwise(line).alias("value"))


def write_export(df: DataFrame, path: str, flag: str = "availability", stock: str = "stock"
                 ) -> dict:
    """Write the quoted export (UTF-8 with a byte-order mark and a header in each file,
    lines ending in CR LF) and return the missing counts observed in the same job
    (``Observation``), not by a second scan.  A table without rows gives one file that
    holds the header."""
    obs = Observation("export")
    observed = df.observe(obs, F.count_if(F.col(flag).isNull()).alias("missing_availability"),
                          F.count_if(F.col(stock).isNull()).alias("missing_stock"),
                          F.count(F.lit(1)).alias("rows"))
    sink = lambda lines: lines.write.mode("overwrite").option("lineSep", "\r\n").option("maxRecordsPerFile", 0).text(path)
    encoded = export_encode(observed, flag=flag)
    sink(export_lines(encoded))
    counts = dict(obs.get)
    if not counts["rows"]:
        header = BYTE_ORDER_MARK + ",".join(f'"{c}"' for c in encoded.columns)
        sink(df.sparkSession.createDataFrame([(header,)], "value string").coalesce(1))
    return counts
