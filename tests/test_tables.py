"""How the rows of tables are dealt out to tasks."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import tables as TB


def held(df):
    """Rows per partition, empty ones left out."""
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


@pytest.fixture()
def one_row_group(spark, tmp_path):
    """A folder whose ``part`` is one row group that Spark reads as many splits."""
    sizes = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "1"}
    spark.range(6000).selectExpr(
        "id AS p_partkey", "concat('name ', hash(id)) AS p_name", "element_at(array('SMALL', 'LARGE'), cast(id % 2 AS int) + 1) AS p_type",
        "cast(id % 50 AS int) AS p_size", "id / 4D AS p_retailprice").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    yield str(tmp_path)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_row_group_of_many_splits_is_dealt_out(spark, one_row_group):
    part = TB.table(spark, one_row_group, "part")
    assert part.rdd.getNumPartitions() > 1 and max(held(part)) == 6000
    fair = 6000 / spark.sparkContext.defaultParallelism
    for df in (TB.spread(part), TB.handwritten_pages(spark, one_row_group), TB.product_pages(spark, one_row_group)):
        assert sum(held(df)) == 6000 and max(held(df)) <= fair + 50
    assert sorted(TB.spread(part).collect()) == sorted(part.collect())


def test_rows_of_a_task_stay_bounded(spark, one_row_group, monkeypatch):
    assert max(held(TB.spread(TB.table(spark, one_row_group, "part"), 100))) <= 100 + 50
    monkeypatch.setattr(TB, "PAGES_PER_TASK", 100)
    for pages in (TB.handwritten_pages, TB.product_pages):
        assert pages(spark, one_row_group).rdd.getNumPartitions() == 60
    assert TB.listing_pages(spark, one_row_group).rdd.getNumPartitions() == 60


def test_even_and_empty_inputs_are_left_as_they_are(spark):
    even = spark.range(0, 1000, 1, spark.sparkContext.defaultParallelism)
    empty = spark.createDataFrame([], "a int")
    assert TB.spread(even) is even and TB.spread(empty) is empty
