"""Data-quality gates: a rule list evaluated in one aggregate, reported in
long form ``(rule, violations, passed)``.  A null compared value is not a
violation of a range rule (the null gate catches it), as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import BOOLEAN_FEATURES, FEATURE_COLUMNS, PROCESSED_COLUMNS
from shelfwise.functions import text as TX
from shelfwise.operators.common import cols_or_all


class QualityError(ValueError):
    def __init__(self, message: str, report=None):
        super().__init__(message)
        self.report = report


@dataclass(frozen=True)
class Rule:
    """``violations`` is an aggregate Column counting violating rows."""

    name: str
    violations: Column


def predicate_rule(name: str, predicate: Column) -> Rule:
    return Rule(name, F.count_if(predicate))


def evaluate(df: DataFrame, rules: Sequence[Rule], fixed: Sequence[tuple[str, int]] = ()) -> DataFrame:
    """All rules in one pass -> ``(rule string, violations bigint, passed boolean)``.

    ``fixed`` carries plan-time results (missing columns, wrong types).
    """
    row = df.agg(*[r.violations.cast("bigint").alias(f"_r{i}") for i, r in enumerate(rules)]) \
        if rules else df.sparkSession.range(1).select()
    items = [F.struct(F.lit(r.name).alias("rule"), F.col(f"_r{i}").alias("violations"))
             for i, r in enumerate(rules)]
    items += [F.struct(F.lit(n).alias("rule"), F.lit(v).cast("bigint").alias("violations"))
              for n, v in fixed]
    return (row.select(F.explode(F.array(*items)).alias("_x")).select("_x.*")
            .withColumn("passed", F.col("violations") == 0))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` for every column, one aggregate."""
    cols = cols_or_all(df, cols)
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).cast("bigint").alias(f"_n{i}")
                   for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls"))
        for i, c in enumerate(cols)])).alias("_x")).select("_x.*")


def refuse_nulls(counts: dict[str, int], report=None) -> None:
    """Raise with the columns that hold nulls and how many."""
    total = sum(counts.values())
    if total:
        raise QualityError(f"{total} null values found: " + ", ".join(f"{c}={n}" for c, n in counts.items() if n), report)


def check_nulls(df: DataFrame, on_null: str = "fail", cols: Sequence[str] | None = None
                ) -> tuple[DataFrame, int, DataFrame]:
    """Null gate.  Returns ``(df, total_nulls, report)``; raises in "fail"
    mode when any null exists.  One job; the report is small."""
    report = null_counts(df, cols)
    rows = report.collect()  # one row per column: bounded by the schema
    total = sum(r["nulls"] for r in rows)
    if on_null == "fail":
        refuse_nulls({r["column"]: r["nulls"] for r in rows}, report)
    return df, total, report


def processed_rules(price: str = "price", rating: str = "rating", stock: str = "stock",
                    flag: str = "availability") -> list[Rule]:
    return [
        predicate_rule("price_positive", F.col(price) <= 0),
        predicate_rule("rating_1_to_5", (F.col(rating) < 1) | (F.col(rating) > 5)),
        predicate_rule("stock_non_negative", F.col(stock) < 0),
        predicate_rule("flag_0_or_1", ~F.col(flag).isin(0, 1)),
    ]


def processed_fixed(columns: Sequence[str], required: Sequence[str] = PROCESSED_COLUMNS) -> list[tuple[str, int]]:
    return [("columns_present", len([c for c in required if c not in columns]))]


def id_violations(df: DataFrame, rows: int, id_col: str = "id") -> list[tuple[str, int]]:
    """``id_unique``: rows less distinct ids (a null id counts as none).

    Decided on 16-byte digests, so ids of any length shuffle 16 bytes a row; only where
    some are equal are the ids themselves counted."""
    digests = df.agg(F.count_distinct(F.unhex(F.md5(id_col)))).first()[0]
    if digests == rows:
        return [("id_unique", 0)]
    return [("id_unique", rows - df.agg(F.count_distinct(id_col)).first()[0])]


def gate_processed(df: DataFrame, required: Sequence[str] = PROCESSED_COLUMNS, id_col: str = "id",
                   **names) -> DataFrame:
    """Processed-data gate report ``(rule, violations, passed)`` of a table that exists
    already; a run checks the same rules while it writes (``sources.publish``).

    The range rules and the digests of the id share one pass (:func:`id_violations`).
    The report is a small local table.
    """
    spark = df.sparkSession
    fixed = processed_fixed(df.columns, required)
    if fixed[0][1]:
        return evaluate(df, [], fixed)
    rules = processed_rules(**names)
    row = df.agg(*[r.violations.cast("bigint").alias(f"_r{i}") for i, r in enumerate(rules)],
                 F.count(F.lit(1)).alias("_n"), F.count_distinct(F.unhex(F.md5(id_col))).alias("_d")).first()
    unique = [("id_unique", 0)] if row["_d"] == row["_n"] else id_violations(df, row["_n"], id_col)
    items = [*fixed, *unique, *((r.name, int(row[f"_r{i}"])) for i, r in enumerate(rules))]
    return (spark.createDataFrame(items, "rule string, violations bigint")
            .withColumn("passed", F.col("violations") == 0))


def feature_rules(df: DataFrame, title_length: str = "title_length",
                  score: str = "popularity_score",
                  bool_cols: Sequence[str] = BOOLEAN_FEATURES) -> tuple[list[Rule], list[tuple[str, int]]]:
    types = dict(df.dtypes)
    rules = [
        predicate_rule("title_length_non_negative", F.col(title_length) < 0),
        # null score (max stock 0) counts as a violation
        predicate_rule("popularity_0_to_1",
                       F.coalesce((F.col(score) < 0) | (F.col(score) > 1) | F.isnan(score),
                                  F.lit(True))),
    ]
    fixed = []
    for b in bool_cols:
        if types.get(b) != "boolean":
            fixed.append((f"{b}_boolean", 1))
        else:
            rules.append(predicate_rule(f"{b}_boolean", F.col(b).isNull()))
    return rules, fixed


def feature_fixed(columns: Sequence[str], required: Sequence[str] = FEATURE_COLUMNS) -> list[tuple[str, int]]:
    return [("features_present", len([c for c in required if c not in columns]))]


def gate_features(df: DataFrame, required: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    fixed = feature_fixed(df.columns, required)
    if fixed[0][1]:
        return evaluate(df, [], fixed)
    rules, more = feature_rules(df)
    return evaluate(df, rules, fixed + more)


def assert_passed(report: DataFrame, what: str = "gate") -> None:
    """Raise with all failed rules (the report is one row per rule)."""
    failed = [r for r in report.collect() if not r["passed"]]
    if failed:
        detail = ", ".join(f"{r['rule']}={r['violations']}" for r in failed)
        raise QualityError(f"{what} failed: {detail}", report)


def range_violations(df: DataFrame, price: str = "price", rating: str = "rating",
                     stock: str = "stock", flag: str | None = "availability") -> DataFrame:
    rules = [
        predicate_rule("price_non_positive", F.col(price) <= 0),
        predicate_rule("rating_outside_1_5", (F.col(rating) < 1) | (F.col(rating) > 5)),
        predicate_rule("stock_negative", F.col(stock) < 0),
    ]
    if flag is not None:
        rules.append(predicate_rule("flag_not_0_1", ~F.col(flag).isin(0, 1)))
    return evaluate(df, rules)


def quality_summary(df: DataFrame, id_col: str = "id") -> DataFrame:
    """One row: total rows, total nulls over all columns, distinct ids."""
    nulls = None
    for c in df.columns:
        term = F.count_if(F.col(f"`{c}`").isNull())
        nulls = term if nulls is None else nulls + term
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"),
                  nulls.cast("bigint").alias("total_nulls"),
                  F.count_distinct(id_col).cast("bigint").alias("unique_ids"))


def placeholder_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per text column: nulls, empty, '0', 'null', 'n/a'|'na', total, percent."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        x = F.col(c)
        low = F.lower(x)
        aggs += [F.count_if(x.isNull()).alias(f"_a{i}"),
                 F.count_if(x == "").alias(f"_b{i}"),
                 F.count_if(x == "0").alias(f"_c{i}"),
                 F.count_if(low == "null").alias(f"_d{i}"),
                 F.count_if(low.isin("n/a", "na")).alias(f"_e{i}")]
    row = df.agg(*aggs)
    items = []
    for i, c in enumerate(cols):
        tot = sum((F.col(f"_{k}{i}") for k in "abcde"), F.lit(0))
        items.append(F.struct(
            F.lit(c).alias("column"),
            F.col(f"_a{i}").cast("bigint").alias("nulls"),
            F.col(f"_b{i}").cast("bigint").alias("empty"),
            F.col(f"_c{i}").cast("bigint").alias("zero_text"),
            F.col(f"_d{i}").cast("bigint").alias("null_text"),
            F.col(f"_e{i}").cast("bigint").alias("na_text"),
            tot.cast("bigint").alias("total"),
            F.round(F.try_divide(tot * 100.0, F.col("_rows")), 6).alias("percent")))
    return row.select(F.explode(F.array(*items)).alias("_x")).select("_x.*")


def placeholder_examples(df: DataFrame, col: str, show: Sequence[str], order_by: Sequence[str],
                         n: int = 3) -> DataFrame:
    """First ``n`` rows (by ``order_by``) whose ``col`` is a placeholder."""
    return df.where(TX.is_placeholder(col)).orderBy(*order_by).limit(n).select(*show)


def zero_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, zeros, percent) for numeric columns, one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c) == 0).alias(f"_z{i}") for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_z{i}").cast("bigint").alias("zeros"),
                 F.round(F.try_divide(F.col(f"_z{i}") * 100.0, F.col("_rows")), 6).alias("percent"))
        for i, c in enumerate(cols)])).alias("_x")).select("_x.*")


def zero_examples(df: DataFrame, col: str, show: Sequence[str], order_by: Sequence[str],
                  n: int = 3) -> DataFrame:
    return df.where(F.col(col) == 0).orderBy(*order_by).limit(n).select(*show)
