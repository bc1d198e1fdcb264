"""Feature operators; reference feature-engineering unit test and edges."""

import pytest
from pyspark.sql import functions as F

from shelfwise.config import Bands
from shelfwise.operators import features as FE
from shelfwise.operators import quality as Q
from tests.conftest import rows


def col_values(df, c, order="i"):
    return [r[0] for r in df.orderBy(order).select(c).collect()]


def test_bands_and_labels(spark):
    p = spark.createDataFrame([(i, v) for i, v in enumerate([20.0, 20.01, 40.0, 50.0, 50.01, None])],
                              "i int, price double")
    assert col_values(FE.add_price_range(p), "price_range") == \
        ["Baixo", "Médio", "Médio", "Alto", "Premium", "Premium"]
    s = spark.createDataFrame([(i, v) for i, v in enumerate([0, 5, 6, 15, 16, None])], "i int, stock int")
    assert col_values(FE.add_stock_level(s), "stock_level") == ["Baixo", "Baixo", "Médio", "Médio", "Alto", "Alto"]
    r = spark.createDataFrame([(i, v) for i, v in enumerate([1, 5, 6, None])], "i int, rating int")
    assert col_values(FE.add_rating_category(r), "rating_category") == ["Muito Baixo", "Muito Alto", None, None]
    custom = FE.add_price_range(p, bands=Bands(((30.0, "low"),), "high"))
    assert col_values(custom, "price_range")[:2] == ["low", "low"]


def test_popularity_and_zero_max(spark):
    df = spark.createDataFrame([(0, 5, 10), (1, 1, 0)], "i int, rating int, stock int")
    assert col_values(FE.add_popularity_score(df), "popularity_score") == [1.0, 0.7 * 0.2]
    zero = spark.createDataFrame([(0, 5, 0)], "i int, rating int, stock int")
    scored = FE.add_popularity_score(zero)
    assert col_values(scored, "popularity_score") == [None]
    feats = FE.add_title_features(scored.withColumn("title", F.lit("The A")))
    feats = FE.add_stock_level(FE.add_rating_category(FE.add_price_range(feats.withColumn("price", F.lit(1.0)))))
    rep = dict(rows(Q.gate_features(feats), "rule", "violations"))
    assert rep["popularity_0_to_1"] == 1


def test_one_hot(spark):
    df = spark.createDataFrame([(0, "Sci Fi & X"), (1, None), (2, "Poetry")], "i int, category string")
    out = FE.add_one_hot(df)
    assert out.columns[-2:] == ["category_poetry", "category_sci_fi_and_x"]
    assert rows(out.orderBy("i"), "category_poetry", "category_sci_fi_and_x") == [(0, 1), (0, 0), (1, 0)]
    sums = dict(rows(FE.one_hot_sums(out)))
    assert sums == {"category_poetry": 1, "category_sci_fi_and_x": 1}
    clash = spark.createDataFrame([("A B",), ("a b",)], "category string")
    with pytest.raises(FE.VocabularyError):
        FE.add_one_hot(clash)


def test_one_hot_as_a_map_holds_any_number_of_categories(spark):
    many = spark.range(5000).select(F.concat(F.lit("Kind "), F.col("id").cast("string")).alias("category"))
    out = FE.add_one_hot(many.unionByName(spark.createDataFrame([(None,)], "category string")), form="map")
    assert out.columns == ["category", "category_one_hot"]
    got = dict(rows(out))
    assert len(got) == 5001 and got["Kind 42"] == {"category_kind_42": 1} and got[None] == {}
    assert FE.one_hot_sums(out).count() == 5000
    clash = many.unionByName(spark.createDataFrame([("kind 3",)], "category string"))
    with pytest.raises(FE.VocabularyError):
        FE.add_one_hot(clash, form="map")


def test_the_data_never_change_the_form_of_one_hot(spark):
    values = lambda n: spark.range(n).select(F.concat(F.lit("v"), F.col("id")).alias("category"))
    assert len(FE.add_one_hot(values(500)).columns) == 501
    with pytest.raises(FE.VocabularyError, match="form='map'"):
        FE.add_one_hot(values(501))
    assert FE.add_one_hot(values(3), form="map").columns == FE.add_one_hot(values(501), form="map").columns
    few = FE.add_one_hot(values(3), vocabulary=["v1"], form="map")
    assert dict(rows(few)) == {"v0": {}, "v1": {"category_v1": 1}, "v2": {}}
    with pytest.raises(ValueError):
        FE.add_one_hot(values(3), form="rows")


FEAT_ROWS = [(10, 5, "a"), (11, 6, "b"), (12, 7, "a"), (13, 8, "b"), (14, 9, "a"), (1000, 10, "b")]


def test_reference_feature_case(spark):
    df = spark.createDataFrame(FEAT_ROWS, "price int, title_len int, category string")
    b = rows(FE.iqr_bounds(df, ["price"]), "q1", "q3", "lower", "upper")
    assert b == [(11.25, 13.75, 7.5, 17.5)]
    kept = FE.iqr_filter(df, ["price"])
    assert sorted(r[0] for r in kept.select("price").collect()) == [10, 11, 12, 13, 14]
    scaled = FE.minmax_scale(kept, ["price", "title_len"])
    assert any(c.endswith("_minmax") for c in scaled.columns)
    assert sorted(r[0] for r in scaled.select("price_minmax").collect()) == [0.0, 0.25, 0.5, 0.75, 1.0]
    train, test = FE.train_test_split(scaled, ["price", "title_len"], 80)
    assert train.count() + test.count() == 5
    assert train.agg(F.max("price")).first()[0] is None or train.agg(F.max("price")).first()[0] < 1000
    assert sorted(rows(train.unionByName(test))) == sorted(rows(scaled))       # full table = both splits
    selected, keep = FE.feature_selection(scaled, "price", threshold=0.1)
    assert "price" in selected.columns
    const = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "a int, b int")
    assert FE.minmax_scale(const, ["b"]).select("b_minmax").distinct().first()[0] == 0.0


def test_split_is_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = FE.with_split_label(df, ["k"]).groupBy("split").count()
    b = FE.with_split_label(df.repartition(5), ["k"]).groupBy("split").count()
    assert sorted(rows(a)) == sorted(rows(b))
    share = dict(rows(a))["train"] / 1000
    assert 0.75 < share < 0.85


def test_one_hot_fixed_vocabulary(spark):
    df = spark.createDataFrame([(0, "a"), (1, "new"), (2, None)], "i int, category string")
    out = FE.add_one_hot(df, vocabulary=["a", "b"]).orderBy("i")
    assert out.columns[-2:] == ["category_a", "category_b"]
    assert rows(out, "category_a", "category_b") == [(1, 0), (0, 0), (0, 0)]   # unseen value -> all 0


def test_feature_plan_uses_config_vocabulary(spark):
    from shelfwise.config import PipelineConfig
    from shelfwise.plans import etl as E
    proc = spark.createDataFrame(
        [("x", "T", 10.0, 3, "a", "", "", 1, 4, "")],
        "id string, title string, price double, rating int, category string, image string, "
        "product_page string, availability int, stock int, image_base64 string")
    feats = E.feature_plan(proc, PipelineConfig(one_hot_vocabulary=("a", "z")))
    assert [c for c in feats.columns if c.startswith("category_")] == ["category_a", "category_z"]
