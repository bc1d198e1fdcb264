"""Tables that are written once, checked while they are written, and published whole.

A table goes to a folder beside its place (its name starts with ``_``, so readers of
the parent skip it).  The rules of its gate are metrics of that same write job; what
cannot be a metric (distinct ids) is checked on the written columns.  Only when all
have passed is the folder renamed into place through the Hadoop file system, an older
table being set aside first and removed after.  A failed gate or write leaves the
published table as it was; what a gate refused stays beside it for inspection.

Between the two renames of a replacement the place is empty for a moment, as there is
no exchange of folders in the Hadoop interface.  On object stores a rename copies.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.quality import QualityError, Rule
from shelfwise.session import remove_path, staging_path

Counts = Sequence[tuple[str, int]]


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _file_system(spark, path)
    return fs.exists(place)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    to, fs = _file_system(spark, target)
    try:
        done = fs.rename(_file_system(spark, source)[0], to)
    except Py4JJavaError as exc:
        raise OSError(f"cannot rename {source} to {target}: {exc.java_exception.getMessage()}") from exc
    if not done:
        raise OSError(f"cannot rename {source} to {target}")


def beside(path: str, mark: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{mark}-{uuid.uuid4().hex}" if parent else f"_{name}.{mark}-{uuid.uuid4().hex}"


def commit(spark: SparkSession, written: str, path: str) -> None:
    """Put the folder ``written`` in the place of ``path``; the old table comes back if
    that fails."""
    old = None
    if exists(spark, path):
        old = beside(path, "old")
        _rename(spark, path, old)
    try:
        _rename(spark, written, path)
    except Exception:
        if old:
            _rename(spark, old, path)
        raise
    if old:
        remove_path(spark, old)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and put it in the place of ``path``, which ``df`` may read."""
    spark, pending = df.sparkSession, beside(path, "pending")
    df.write.parquet(pending)
    commit(spark, pending, path)
    return spark.read.schema(df.schema).parquet(path)


def write_checked(df: DataFrame, path: str | None, name: str, rules: Sequence[Rule] = (), fixed: Counts = (),
                  checks: Sequence[Callable[[DataFrame, int], Counts]] = ()) -> tuple[DataFrame, str | None, dict[str, int]]:
    """Write ``df`` to ``path`` (or the staging folder, for None) behind its gate.

    ``rules`` are counted by the write itself, ``fixed`` holds what the plan already
    tells, and each of ``checks`` gets the written table and its number of rows.
    Returns the table, the staging path that holds it (None once published), and the
    violations by rule with ``rows``; raises :class:`QualityError` with all failed
    rules."""
    spark = df.sparkSession
    refuse(name, [f for f in fixed if f[1]])        # known before anything is written
    pending = beside(path, "pending") if path else staging_path(spark, f"{name}-{uuid.uuid4().hex}")
    seen = Observation(name)
    metrics = [r.violations.cast("bigint").alias(f"r{i}") for i, r in enumerate(rules)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.parquet(pending)
    counted = seen.get
    written = spark.read.schema(df.schema).parquet(pending)
    counts = [*fixed, *((r.name, int(counted[f"r{i}"] or 0)) for i, r in enumerate(rules))]
    for check in checks:
        counts += check(written, counted["rows"])
    refuse(name, [c for c in counts if c[1]], pending)
    found = dict(counts) | {"rows": int(counted["rows"])}
    if path is None:
        return written, pending, found
    commit(spark, pending, path)
    return spark.read.schema(df.schema).parquet(path), None, found


def refuse(name: str, failed: Counts, pending: str | None = None) -> None:
    if failed:
        where = f" (left at {pending})" if pending else ""
        raise QualityError(f"{name} gate failed: " + ", ".join(f"{rule}={n}" for rule, n in failed) + where, dict(failed))
