"""Shared helpers: table access, staging, Arrow row mapping, word hashing."""

from __future__ import annotations

import atexit
import contextlib
import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfwise.session import remove_path, staging_path

# ASCII whitespace of the word rule [^\x20\x09-\x0D]+
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
SPACE_CHARS = " \t\n\x0b\x0c\r"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fresh_path(spark: SparkSession, name: str) -> str:
    return staging_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread
    it: the lineage is cut, and a lost executor costs only its own tasks.

    Shuffle files of the write are released once it has ended.  Staged tables
    go when the driver ends, or earlier through :func:`unstage`.
    """
    spark = df.sparkSession
    path = _fresh_path(spark, name)
    with _released_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    atexit.register(remove_path, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            remove_path(df.sparkSession, path)


@contextlib.contextmanager
def _released_shuffles(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``df`` and its whole rows as one struct ``row``: whatever their
    columns are called, they meet no inner name.  ``select("row.*")`` gives them back."""
    every = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    return df.select(*columns, F.struct(*every).alias("row"))


def map_batches(df: DataFrame, run: Callable, keep: int | None = None) -> DataFrame:
    """``mapInArrow`` of a function that returns the first ``keep`` (all) columns of
    ``df`` in their order.  Inside, columns go by number, so a name may hold anything."""
    fields = df.schema.fields
    numbered = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    kept = fields[:keep]
    return df.toDF(*numbered.names).mapInArrow(run, T.StructType(numbered.fields[:len(kept)])).toDF(*(f.name for f in kept))


class Shared:
    """A broadcast object of this package, rebuilt once per task: pickled by
    value, so executors need no copy of the package."""

    def __init__(self, spark: SparkSession, value):
        self._sent, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return {"_sent": self._sent, "_value": None}

    @property
    def value(self):
        if self._value is None:
            self._value = pickle.loads(self._sent.value)
        return self._value


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(ddl))


def map_rows(df: DataFrame, row_fn: Callable, ddl: str, batch_rows: int = 1024) -> DataFrame:
    """``mapInArrow`` with ``row_fn(*values) -> tuple`` (one row out) or an
    iterator of tuples (any number).  Rows are taken from Arrow in small
    slices, so one batch of long texts is never held twice in Python."""
    schema = arrow_schema(ddl)
    many = getattr(row_fn, "many", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                for values in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if many:
                        for row in row_fn(*values):
                            out.append(row)
                            if len(out) >= batch_rows:
                                yield _batch(out, schema)
                                out = []
                    else:
                        out.append(row_fn(*values))
                if len(out) >= batch_rows:
                    yield _batch(out, schema)
                    out = []
        if out:
            yield _batch(out, schema)

    return df.mapInArrow(run, ddl)


def map_slices(df: DataFrame, slice_fn: Callable, ddl: str, size: int = 256) -> DataFrame:
    """``mapInArrow`` with ``slice_fn(*columns) -> rows`` on lists of up to
    ``size`` values: for functions that are quicker on many rows at once."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                rows = slice_fn(*(c.slice(at, size).to_pylist() for c in batch.columns))
                if rows:
                    yield _batch(rows, schema)

    return df.mapInArrow(run, ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# ---- word hashing -------------------------------------------------------------
# Fixed odd multiplier and a number for each byte.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Tables:
    """Powers of the base and its inverse, grown on demand once per worker."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 14)
            cls.up, cls.down = _powers(_BASE, size), _powers(_BASE_INV, size)
        return cls.up, cls.down


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-space bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word, in order.  Long texts go block by block, cut
    at spaces, so memory follows the block and not the text."""
    out = []
    at, n = 0, len(text)
    while at < n:
        end = min(n, at + _BLOCK)
        if end < n:
            cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            if cut <= at:       # a word longer than a block: up to the next space
                nxt = [p for p in (text.find(b" ", end), text.find(b"\n", end)) if p >= 0]
                cut = min(nxt) if nxt else n
            end = cut
            if end == at:
                end = at + 1
        data = np.frombuffer(text, dtype=np.uint8, count=end - at, offset=at)
        at = end
        starts, ends = word_bounds(data)
        if not len(starts):
            continue
        lengths = ends - starts
        firsts = np.cumsum(lengths) - lengths
        inside = data[~_SPACE[data]]
        place = np.arange(len(inside), dtype=np.int64) - np.repeat(firsts, lengths)
        # one pseudo-random number for each byte at each place, added up: unlike a
        # polynomial modulo 2^64, no structure of a long word cancels it
        sums = np.add.reduceat(mix64(_BYTE[inside] + place.astype(np.uint64) * _BASE), firsts)
        out.append(mix64(sums + lengths.astype(np.uint64) * _BASE))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each window of ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        acc = acc * _BASE + words[j:j + n]
    return mix64(acc)
