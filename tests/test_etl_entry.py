"""Pipelines, step runner, config, driver contract and plan properties."""

import importlib.util
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ENTRY
from shelfwise.config import Bands, PipelineConfig
from shelfwise.operators import profile as P
from shelfwise.plans import etl as E
from shelfwise.plans.registry import REGISTRY
from shelfwise.schema import RAW_SCHEMA
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

RUN_ROWS = [("Book A", 10.0, 5, "In", "c1", "imga"), ("Book B", 12.0, 4, "In", "c2", "imgb")]


def raw_books(spark, data):
    df = spark.createDataFrame(data, "title string, price double, rating int, availability string, "
                                     "category string, image string")
    return df.select("title", "price", "rating", "category", "image",
                     F.lit("http://p/").alias("product_page"), "availability",
                     F.lit(3).alias("stock"), F.lit("").alias("image_base64"))


def test_reference_runner_case(spark):
    raw = raw_books(spark, RUN_ROWS)
    cfg = PipelineConfig()
    state = {}

    def cleaning():
        state["proc"], _ = E.run_cleaning(raw, cfg, ["title", "category"])
        return state["proc"]

    def transformation():
        state["feat"], _ = E.run_features(state["proc"], cfg)
        return state["feat"]

    steps = [("data_cleaning", cleaning), ("data_transformation", transformation),
             ("feature_engineering", lambda: P.correlation_matrix(state["feat"], ["price", "rating"])),
             ("eda", lambda: P.table_profile(state["feat"]))]
    report = E.run_steps(spark, steps)
    got = rows(report, "step", "status")
    assert [s for s, _ in got] == ["data_cleaning", "data_transformation", "feature_engineering", "eda"]
    assert dict(got)["data_cleaning"] == "success"
    assert all(status == "success" for _, status in got)
    failing = E.run_steps(spark, [("a", lambda: 1 / 0), ("b", lambda: None)])
    assert rows(failing, "step", "status") == [("a", "failed"), ("b", "skipped")]


def test_full_run_and_stats(spark):
    raw = raw_books(spark, RUN_ROWS + [("The Book: 2 (x)", 55.0, 1, "yes", "Default", "imgc")])
    feats, stats = E.run_full(spark, raw, PipelineConfig(), ["title"])
    assert stats.total_records == 3 and stats.categories_cleaned == 1 and stats.null_records_found == 0
    assert stats.features_created == len(feats.columns) - 10
    assert {"category_c1", "category_c2", "category_outros"} <= set(feats.columns)
    r = feats.where(F.col("title").startswith("The")).first()
    assert (r["has_subtitle"], r["has_series"], r["has_numbers"], r["price_range"], r["availability"]) == \
        (True, True, True, "Premium", 1)
    sf = E.stats_frame(raw, feats.select(*feats.columns[:10]), feats, PipelineConfig()).first()
    assert sf["total_records"] == 3 and sf["duplicate_titles"] == 0


def test_null_gate_in_cleaning(spark):
    raw = raw_books(spark, [("A", None, 5, "In", "c", "i")])
    with pytest.raises(Exception):
        E.run_cleaning(raw, PipelineConfig(), ["title"])
    proc, stats = E.run_cleaning(raw, PipelineConfig(on_null="report"), ["title"])
    assert stats["null_records_found"] == 1 and proc.count() == 1


def test_config_from_dict():
    cfg = PipelineConfig.from_dict({"default_category": "Other", "problematic_categories": ["X"],
                                    "price_bands": {"bounds": [[10, "lo"], [20, "mid"]], "top_label": "hi"}})
    assert cfg.price_bands == Bands(((10.0, "lo"), (20.0, "mid")), "hi")
    with pytest.raises(ValueError):
        PipelineConfig.from_dict({"nope": 1})
    with pytest.raises(ValueError):
        PipelineConfig(on_null="maybe")
    with pytest.raises(ValueError):
        Bands(((20.0, "a"), (10.0, "b")), None)
    assert [f.name for f in RAW_SCHEMA.fields][0] == "title"


def test_contract_keys():
    q, o = ENTRY.queries(), ENTRY.oracle_sql()
    assert set(o) <= set(q)
    assert set(REGISTRY) <= set(q) and len(REGISTRY) >= 85 and all(sql for _, sql in REGISTRY.values())
    # whatever else there is comes from the optional llm package and its pipeline
    assert all(k.startswith("op") or k == "pipeline" for k in set(q) - set(REGISTRY))
    assert any(k.startswith("op") for k in q) == ENTRY.HAS_LLM
    assert ("pipeline" in q) == (ENTRY.HAS_LLM and importlib.util.find_spec("corpus_pipeline") is not None)


@needs_data
def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0 and "popularity_score" in df.columns


ORACLE_SAMPLE = ["value_counts", "describe", "iqr_outliers", "surrogate_id", "canonical_url", "extract_records",
                 "correlation_matrix", "histogram", "placeholder_profile", "gate_processed", "slug"]


@needs_data
@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_oracle_sample_sf0001(spark, name):
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "customer", "events", "documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = ENTRY.queries()[name](spark, SF)
    res = con.execute(ENTRY.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    key = sorted(dcols)
    s_rows = sorted(tuple(repr(r[c]) for c in key) for r in sdf.collect())
    d_rows = sorted(tuple(repr(r[dcols.index(c)]) for c in key) for r in res.fetchall())
    assert s_rows == d_rows


@needs_data
def test_scan_prunes_columns_and_pushes_filters(spark):
    q = ENTRY.queries()
    plan = q["value_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_type:string>" in plan
    plan = q["zero_examples"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_discount), EqualTo(l_discount,0.0)]" in plan


@needs_data
def test_no_python_udf_and_no_nested_loop_in_any_query(spark):
    for name in REGISTRY:
        plan = ENTRY.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan and "InArrow" not in plan and "InPandas" not in plan, name
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_cli_phases(spark, tmp_path):
    import json as _json

    from shelfwise import cli
    from shelfwise.schema import RAW_SCHEMA
    raw_path = tmp_path / "raw.csv"
    with open(raw_path, "w", encoding="utf-8") as fh:
        fh.write(",".join(f.name for f in RAW_SCHEMA.fields) + "\n")
        fh.write('"The A: 1",15.5,3,"Default","http://i/a.jpg","http://p/a","yes",4,""\n')
        fh.write('"B",45.0,5,"Poetry","http://i/b.jpg","http://p/b","no",20,""\n')
    cfg = tmp_path / "cfg.json"
    cfg.write_text(_json.dumps({"default_category": "Other"}))
    out = {"--input": str(raw_path), "--processed": str(tmp_path / "proc"), "--features": str(tmp_path / "feat")}
    argv = ["--config", str(cfg)] + [x for kv in out.items() for x in kv]
    stats = cli.main(argv + ["--clean-only"], spark=spark)
    assert stats["total_records"] == 2 and stats["categories_cleaned"] == 1
    stats = cli.main(argv + ["--features-only"], spark=spark)
    assert stats["features_created"] == 12
    feats = spark.read.parquet(str(tmp_path / "feat"))
    assert {"category_other", "category_poetry"} <= set(feats.columns)
    stats = cli.main(argv, spark=spark)
    assert stats["total_records"] == 2 and stats["processed_records"] == 2
    with pytest.raises(SystemExit):
        cli.parse_args(["--clean-only", "--features-only"])


def test_schema_helpers_and_dtypes(spark):
    from shelfwise import schema as SC
    df = spark.createDataFrame([("t", 1.0)], "title string, price double")
    assert SC.has_columns(df, ["title"]) and not SC.has_columns(df, ["title", "rating"])
    assert SC.missing_columns(df, SC.raw_columns())[0] == "rating"
    assert SC.processed_columns()[0] == "id" and SC.feature_columns()[-1] == "popularity_score"
    assert rows(P.dtype_listing(df)) == [(0, "title", "string"), (1, "price", "double")]


def test_cluster_conf_scales_with_input():
    from shelfwise.session import cluster_conf
    big = cluster_conf(100 * 1024 ** 4, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (256 * 1024 ** 2))
    small = cluster_conf(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_staged_copies_removed(spark, tmp_path):
    import os as _os

    from shelfwise.session import staging_path
    stage_root = staging_path(spark, "x").rsplit("/", 1)[0]

    def listing():
        return set(_os.listdir(stage_root)) if _os.path.isdir(stage_root) else set()

    raw = raw_books(spark, RUN_ROWS)
    before = listing()
    E.run_full(spark, raw, PipelineConfig(), ["title"], str(tmp_path / "p"), str(tmp_path / "f"),
               stage_input=True)
    assert listing() == before                      # outputs given: no staged copy left
    feats, _ = E.run_full(spark, raw, PipelineConfig(), ["title"], stage_input=True)
    new = listing() - before
    assert len(new) == 1 and next(iter(new)).startswith("features-")   # only the returned table
    assert feats.count() == 2


def test_the_four_steps_write_their_tables_and_report(spark, tmp_path):
    raw = spark.createDataFrame(
        [(f"Book {i % 40}", float(5 + i % 37), 1 + i % 5, ("Poetry", "Travel")[i % 2], "", f"p{i % 40}", "yes", i % 20, "") for i in range(80)],
        "title string, price double, rating int, category string, image string, product_page string, availability string, stock int, image_base64 string")
    raw = raw.unionByName(raw.limit(3))
    out = str(tmp_path / "run")
    report = E.run_catalogue_steps(spark, raw, PipelineConfig(on_null="report"), ["title", "price", "stock"], out)
    read = lambda n: spark.read.parquet(f"{out}/{n}")
    assert [(r["step"], r["status"]) for r in sorted(report.collect(), key=lambda r: ("cleaning", "transformation", "feature_engineering", "exploration").index(r["step"]))] == [
        ("cleaning", "success"), ("transformation", "success"), ("feature_engineering", "success"), ("exploration", "success")]
    assert read("report").count() == 4
    assert read("clean").count() == 80 and read("duplicates").where("copies = 2").count() == 3
    assert read("nulls").where("nulls > 0").count() == 0
    assert read("train").count() + read("test").count() == read("features").count() > 0
    assert "popularity_score" in read("features").columns and read("profile").count() > 0 and read("correlations").count() > 0
    broken = E.run_catalogue_steps(spark, raw.drop("price"), PipelineConfig(), ["title"], str(tmp_path / "broken"))
    assert {r["status"] for r in broken.collect()} == {"success", "failed", "skipped"}


def test_staging_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from shelfwise import session as S

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    sc = SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
    for master in ("yarn", "k8s://x", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            S.ensure_checkpoint_dir(SimpleNamespace(conf=Conf({"spark.master": master}), sparkContext=sc))
    assert S.ensure_checkpoint_dir(SimpleNamespace(conf=Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///c"}), sparkContext=sc)) == "hdfs:///c"


def test_features_only_needs_the_processed_table(spark, tmp_path):
    from shelfwise import cli
    with pytest.raises(ValueError, match="cleaning phase"):
        cli.main(["--features-only", "--processed", str(tmp_path / "none"), "--features", str(tmp_path / "f")], spark=spark)
