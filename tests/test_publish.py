"""Write, gate, commit."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfwise.config import PipelineConfig
from shelfwise.operators import quality as Q
from shelfwise.plans import etl as E
from shelfwise.sources import publish
from tests.conftest import rows
from tests.test_etl_entry import RUN_ROWS, raw_books


@pytest.fixture
def place():
    return os.path.join(tempfile.mkdtemp(prefix="shelfwise-test-"), "table")


def beside(place):
    return sorted(n for n in os.listdir(os.path.dirname(place)) if not n.startswith("."))


def positive(name="x"):
    return Q.predicate_rule("positive", F.col(name) <= 0)


def test_a_passed_table_is_published_and_replaced_whole(spark, place):
    first, path, found = publish.write_checked(spark.range(1, 11).withColumnRenamed("id", "x"), place, "t", [positive()])
    assert path is None and found == {"positive": 0, "rows": 10} and first.count() == 10 and beside(place) == ["table"]
    second, _, _ = publish.write_checked(spark.range(5, 8).withColumnRenamed("id", "x"), place, "t", [positive()])
    assert sorted(rows(second)) == [(5,), (6,), (7,)] and beside(place) == ["table"]


def test_a_refused_table_leaves_the_published_one(spark, place):
    publish.write_checked(spark.range(1, 4).withColumnRenamed("id", "x"), place, "t", [positive()])
    bad = spark.range(-1, 4).withColumnRenamed("id", "x")
    with pytest.raises(Q.QualityError, match="positive=2, odd=1") as err:
        publish.write_checked(bad, place, "t", [positive()], checks=[lambda df, n: [("odd", n % 2)]])
    assert err.value.report == {"positive": 2, "odd": 1}
    assert spark.read.parquet(place).count() == 3
    left = [n for n in beside(place) if n != "table"]
    assert len(left) == 1 and left[0].startswith("_table.pending-")
    # readers of the parent folder do not see what was refused
    assert spark.read.option("recursiveFileLookup", True).parquet(os.path.dirname(place)).count() == 3


def test_what_the_plan_tells_is_refused_before_anything_is_written(spark, place):
    with pytest.raises(Q.QualityError, match="columns_present=2"):
        publish.write_checked(spark.range(3), place, "t", fixed=[("columns_present", 2)])
    assert beside(place) == []


def test_a_failed_write_leaves_the_published_table(spark, place):
    publish.replace_table(spark.range(3), place)
    with pytest.raises(Exception):
        publish.replace_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), place)
    assert spark.read.parquet(place).count() == 3


def test_a_failed_rename_brings_the_old_table_back(spark, place, monkeypatch):
    publish.replace_table(spark.range(3), place)
    with pytest.raises(OSError):
        publish.commit(spark, place + "-missing", place)
    assert spark.read.parquet(place).count() == 3 and beside(place) == ["table"]


def test_a_table_can_be_replaced_by_what_reads_it(spark, place):
    publish.replace_table(spark.range(3), place)
    assert publish.replace_table(spark.read.parquet(place).where("id > 0"), place).count() == 2


def test_a_run_writes_each_table_once_and_scans_it_for_ids_only(spark, place, monkeypatch):
    writes, scans = [], []
    real = publish.write_checked

    def spy(df, path, name, rules, fixed, checks=()):
        writes.append((name, len(rules), [c.__name__ for c in checks]))
        return real(df, path, name, rules, fixed, checks)

    monkeypatch.setattr(publish, "write_checked", spy)
    monkeypatch.setattr(Q, "evaluate", lambda *a: scans.append(a))
    raw = raw_books(spark, RUN_ROWS)
    feats, stats = E.run_full(spark, raw, PipelineConfig(), ["title"], place + "-p", place + "-f")
    assert writes == [("processed", 4, ["id_violations"]), ("features", 6, [])] and not scans
    assert stats.processed_records == 2 and spark.read.parquet(place + "-f").count() == 2
    assert beside(place) == ["table-f", "table-p"]


def test_a_run_with_a_bad_price_publishes_nothing(spark, place):
    raw = raw_books(spark, [("A", -1.0, 5, "yes", "c", "i"), ("B", 2.0, 9, "yes", "c", "i")])
    with pytest.raises(Q.QualityError, match="price_positive=1, rating_1_to_5=1"):
        E.run_full(spark, raw, PipelineConfig(), ["title"], place + "-p", place + "-f")
    assert all(n.startswith("_table-p.pending-") for n in beside(place))


def test_ids_are_compared_by_digest_and_then_by_themselves(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "id string")
    assert Q.id_violations(df, 5) == [("id_unique", 3)]
    assert Q.id_violations(spark.createDataFrame([("a",), ("b",)], "id string"), 2) == [("id_unique", 0)]


def test_nulls_are_refused_with_their_columns(spark, place):
    raw = raw_books(spark, [("A", None, 5, "yes", None, "i"), ("B", 2.0, 4, "yes", "c", None)])
    with pytest.raises(Q.QualityError, match="3 null values found: price=1, category=1, image=1"):
        E.run_cleaning(raw, PipelineConfig(), ["title"], place)
    assert beside(place) == []
