"""Cleaning (L1), feature (L2) and full (L3 / L4) pipelines, the run report
(D20) and the step runner (M14).

Jobs per full run: (optionally) the staged raw input, the intake aggregate
(row count, nulls, replaced categories, duplicate titles, distinct keys), the
shared-key check of the id, the write of the processed table, the count of its
distinct ids, max stock, the one-hot vocabulary and the write of the feature
table.  Each table is written once, beside its place or to the shared checkpoint
folder; the rules of its gate are metrics of that write, and it is renamed into
place once they have passed (``sources.publish``).  Lineage is cut between phases:
a lost executor in phase 2 never recomputes phase 1.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import FEATURE_COLUMNS, PROCESSED_COLUMNS, RAW_COLUMNS, PipelineConfig
from shelfwise.operators import clean as C
from shelfwise.operators import features as FE
from shelfwise.operators import profile as P
from shelfwise.operators import quality as Q
from shelfwise.operators.common import staged, with_one_row
from shelfwise.schema import require_columns
from shelfwise.session import remove_path
from shelfwise.sources import publish


@dataclass
class PipelineStats:
    total_records: int = 0
    null_records_found: int = 0
    duplicate_titles: int = 0
    categories_cleaned: int = 0
    processed_records: int = 0
    features_created: int = 0
    execution_time_seconds: float = 0.0

    def as_dict(self) -> dict:
        return asdict(self)


def intake_row(raw: DataFrame, config: PipelineConfig, cols: Sequence[str] = RAW_COLUMNS,
               title: str = "title", category: str = "category",
               key_cols: Sequence[str] | None = None) -> DataFrame:
    """One row: total_records, null_records_found, categories_cleaned,
    duplicate_titles (rows whose title occurs more than once), and with
    ``key_cols`` the number of distinct keys as the id writes them
    (``distinct_id_keys``): as many as rows means that no id is shared; and the
    nulls of each column (``nulls``)."""
    nulls = None
    for c in cols:
        t = F.count_if(F.col(c).isNull())
        nulls = t if nulls is None else nulls + t
    base = raw.agg(F.count(F.lit(1)).cast("bigint").alias("total_records"),
                   nulls.cast("bigint").alias("null_records_found"),
                   C.replaced_count(category, config.problematic_categories).cast("bigint")
                   .alias("categories_cleaned"),
                   *([F.count_distinct(F.unhex(F.lpad(C.id_key(key_cols, config.id_hex_len), 32, "0"))).cast("bigint")
                      .alias("distinct_id_keys"), F.struct(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols)).alias("nulls")]
                     if key_cols else []))
    dup = (raw.groupBy(title).agg(F.count(F.lit(1)).alias("_n"))
           .agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint")
                .alias("duplicate_titles")))
    return with_one_row(base, dup)


def cleaning_plan(raw: DataFrame, config: PipelineConfig, key_cols: Sequence[str],
                  with_id: bool = True, keys_known_unique: bool = False) -> DataFrame:
    """Lazy processed table: id, category replacement, flag encoding.

    ``with_id=False`` leaves the id null and skips the shared-key check job;
    for analyses that never read the id.
    """
    if with_id:
        df = C.add_surrogate_id(raw, key_cols, prefix=config.id_prefix, hex_len=config.id_hex_len,
                                content_cols=list(RAW_COLUMNS), keys_known_unique=keys_known_unique)
    else:
        df = raw.select(F.lit(None).cast("string").alias("id"), *raw.columns)
    df = C.replace_categories(df, "category", config.problematic_categories, config.default_category)
    df = C.encode_flag(df, "availability")
    return df.select(*PROCESSED_COLUMNS)


def _clean(raw: DataFrame, config: PipelineConfig, key_cols: Sequence[str], output: str | None,
           stage_input: bool) -> tuple[DataFrame, dict, str | None]:
    """Cleaning run; returns the processed table, the statistics and the
    staging path still backing the table (None when it was published to
    ``output``)."""
    require_columns(raw, RAW_COLUMNS, "raw table")
    spark = raw.sparkSession
    raw_path = None
    if stage_input:
        raw, raw_path = staged(raw.select(*RAW_COLUMNS, *[k for k in key_cols if k not in RAW_COLUMNS]), "raw")
    intake = intake_row(raw, config, key_cols=key_cols).first().asDict(True)
    nulls = intake.pop("nulls")
    if config.on_null == "fail":
        Q.refuse_nulls(nulls)
    unique = intake.pop("distinct_id_keys") == intake["total_records"]
    plan = cleaning_plan(raw, config, key_cols, keys_known_unique=unique)
    processed, proc_path, found = publish.write_checked(
        plan, output, "processed", Q.processed_rules(), Q.processed_fixed(plan.columns), [Q.id_violations])
    if raw_path:
        remove_path(spark, raw_path)   # nothing reads the staged input any more
    return processed, dict(intake) | {"processed_records": found["rows"]}, proc_path


def run_cleaning(raw: DataFrame, config: PipelineConfig, key_cols: Sequence[str],
                 output: str | None = None, stage_input: bool = False) -> tuple[DataFrame, dict]:
    """L1.  ``key_cols`` is the natural key used for the id (extra raw
    columns such as the key travel with the input and are dropped).

    ``stage_input`` writes the raw input once first; use it when the input
    is itself an expensive plan (a join) rather than a file scan, since the
    intake aggregate, the id and the cleaning pass all read it.  The
    processed table is written once, the gate's range rules being counted by that
    write, and takes the place of ``output`` only when the gate has passed.
    Staged copies that nothing reads any more are removed; what a gate refused
    stays for inspection.
    """
    processed, stats, _ = _clean(raw, config, key_cols, output, stage_input)
    return processed, stats


def feature_plan(processed: DataFrame, config: PipelineConfig,
                 vocabulary: Sequence[str] | None = None) -> DataFrame:
    df = FE.add_price_range(processed, "price", config.price_bands)
    df = FE.add_title_features(df, "title")
    df = FE.add_rating_category(df, "rating")
    df = FE.add_stock_level(df, "stock", config.stock_bands)
    df = FE.add_popularity_score(df, "rating", "stock")
    base = list(PROCESSED_COLUMNS) + list(FEATURE_COLUMNS)
    df = df.select(*base)
    vocab = vocabulary if vocabulary is not None else config.one_hot_vocabulary
    return FE.add_one_hot(df, "category", vocab, form=config.one_hot_form, most=config.one_hot_columns)


def run_features(processed: DataFrame, config: PipelineConfig,
                 output: str | None = None) -> tuple[DataFrame, dict]:
    """L2.  Jobs: max stock (popularity), one-hot vocabulary and the feature write,
    which counts the gate's rules; ``output`` is replaced if they all passed."""
    require_columns(processed, PROCESSED_COLUMNS, "processed table")
    plan = feature_plan(processed, config)
    rules, fixed = Q.feature_rules(plan)
    feats, _, _ = publish.write_checked(plan, output, "features", rules, Q.feature_fixed(plan.columns) + fixed)
    stats = {"features_created": len(feats.columns) - len(PROCESSED_COLUMNS),
             "category_columns": len([c for c in feats.columns if c.startswith("category_")])}
    return feats, stats


def run_full(spark: SparkSession, raw: DataFrame, config: PipelineConfig, key_cols: Sequence[str],
             processed_out: str | None = None, features_out: str | None = None,
             stage_input: bool = False) -> tuple[DataFrame, PipelineStats]:
    """L3: cleaning, staged processed table, features.  Returns the feature
    table and the run statistics."""
    t0 = time.perf_counter()
    processed, s1, proc_path = _clean(raw, config, key_cols, processed_out, stage_input)
    feats, s2 = run_features(processed, config, features_out)
    if proc_path:
        remove_path(spark, proc_path)   # the feature table is written; phase 1's copy is done
    stats = PipelineStats(
        total_records=s1["total_records"], null_records_found=s1["null_records_found"],
        duplicate_titles=s1["duplicate_titles"], categories_cleaned=s1["categories_cleaned"],
        processed_records=s1["processed_records"], features_created=s2["features_created"],
        execution_time_seconds=round(time.perf_counter() - t0, 3))
    return feats, stats


def stats_frame(raw: DataFrame, processed: DataFrame, features: DataFrame,
                config: PipelineConfig) -> DataFrame:
    """D20 as a plan: intake row x processed count x plan-time feature count."""
    n_proc = processed.agg(F.count(F.lit(1)).cast("bigint").alias("processed_records"))
    return (with_one_row(intake_row(raw, config), n_proc)
            .withColumn("features_created",
                        F.lit(len(features.columns) - len(PROCESSED_COLUMNS)).cast("bigint"))
            .select("total_records", "null_records_found", "duplicate_titles",
                    "categories_cleaned", "processed_records", "features_created"))


# --- step runner (M14) ---------------------------------------------------------------

@dataclass
class StepResult:
    step: str
    status: str
    rows: int | None
    seconds: float
    error: str | None = None


def run_steps(spark: SparkSession, steps: Sequence[tuple[str, Callable[[], DataFrame | None]]]
              ) -> DataFrame:
    """Run named steps in order; after a failure later steps are 'skipped'.

    Returns a report DataFrame (step, status, rows, seconds, error); errors whole.
    """
    results: list[StepResult] = []
    failed = False
    for name, fn in steps:
        if failed:
            results.append(StepResult(name, "skipped", None, 0.0))
            continue
        t0 = time.perf_counter()
        try:
            out = fn()
            rows = out.count() if isinstance(out, DataFrame) else None
            results.append(StepResult(name, "success", rows, round(time.perf_counter() - t0, 3)))
        except Exception as exc:  # recorded in the report, later steps skipped
            failed = True
            results.append(StepResult(name, "failed", None, round(time.perf_counter() - t0, 3),
                                      f"{type(exc).__name__}: {exc}"))
    return spark.createDataFrame(
        [(r.step, r.status, r.rows, r.seconds, r.error) for r in results],
        "step string, status string, rows bigint, seconds double, error string")


def run_catalogue_steps(spark: SparkSession, raw: DataFrame, config: PipelineConfig, key_cols: Sequence[str],
                        out_dir: str, price: str = "price", target: str = "popularity_score",
                        threshold: float = 0.1) -> DataFrame:
    """The four steps on a raw catalogue, each writing its tables under
    ``out_dir``, and a written report (``report``):

    1. ``cleaning``: ``nulls`` (null count per column), ``duplicates`` (repeated
       rows) and ``clean`` (each row once);
    2. ``transformation``: ``transformed`` (id, category and flag as processed);
    3. ``feature_engineering``: ``features``, with the columns that correlate with
       ``target`` selected and price outliers removed, and its parts ``train`` and
       ``test``;
    4. ``exploration``: ``profile`` (table profile) and ``correlations`` with the
       target.
    """
    base = out_dir.rstrip("/")
    at = lambda name: f"{base}/{name}"

    def put(df: DataFrame, name: str) -> DataFrame:
        return publish.replace_table(df, at(name))

    def cleaning():
        put(Q.null_counts(raw), "nulls")
        put(C.duplicates_report(raw), "duplicates")
        return put(C.dedup_rows(raw), "clean")

    def transformation():
        return put(cleaning_plan(spark.read.parquet(at("clean")), config, key_cols), "transformed")

    def feature_engineering():
        whole = feature_plan(spark.read.parquet(at("transformed")), config)
        numeric = ("price", "rating", "stock", "availability", "title_length", "title_word_count")
        _, kept = FE.feature_selection(whole, target, [c for c in numeric if c in whole.columns], threshold)
        inside = FE.iqr_filter(whole, [price])
        out = put(inside.select("id", *kept, target), "features")
        train, test = FE.train_test_split(out, ["id"])
        put(train, "train")
        put(test, "test")
        return out

    def exploration():
        whole = spark.read.parquet(at("features"))
        put(P.target_correlations(whole, target, [c for c in whole.columns if c not in ("id", target)]), "correlations")
        return put(P.table_profile(whole), "profile")

    report = run_steps(spark, [("cleaning", cleaning), ("transformation", transformation),
                               ("feature_engineering", feature_engineering), ("exploration", exploration)])
    return put(report, "report")
