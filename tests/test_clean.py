"""Cleaning operators; inputs of the reference's cleaning / transformation
unit tests and FIXTURES.md edge rows."""

from pyspark.sql import functions as F

from shelfwise.operators import clean as C
from shelfwise.operators import quality as Q
from tests.conftest import rows

CLEAN_SCHEMA = "title string, price double, rating int, availability string, category string, image string"
CLEAN_ROWS = [("Book A", 10.0, 4, "In", "cat_a", "img1"), ("Book A", 10.0, 4, "In", "cat_a", "img1"),
              ("Book B", None, 5, "Out", "cat_b", "img2")]


def test_reference_cleaning_case(spark):
    df = spark.createDataFrame(CLEAN_ROWS, CLEAN_SCHEMA)
    dedup = C.dedup_rows(df)
    assert dedup.count() == 2
    assert "price" in dedup.columns
    assert dedup.where(F.col("price").isNull()).count() == 1          # null row kept
    _, total, report = Q.check_nulls(dedup, on_null="report")         # nulls report
    assert total == 1 and dict(rows(report, "column", "nulls"))["price"] == 1
    dups = C.duplicates_report(df)                                    # duplicates report
    assert rows(dups, "title", "copies") == [("Book A", 2)]


def test_null_gate_fails(spark):
    df = spark.createDataFrame(CLEAN_ROWS, CLEAN_SCHEMA)
    try:
        Q.check_nulls(df, on_null="fail")
    except Q.QualityError as exc:
        assert "price=1" in str(exc)
    else:
        raise AssertionError("null gate did not fail")


def test_reference_transformation_case(spark):
    df = spark.createDataFrame([("Some Book", "Sci Fi", "R$ 10,99"), ("Another+Book", "Drama & Suspense", "12.50")],
                               "title string, category string, price string")
    out = C.parse_price_column(C.normalize_columns(df, ["title", "category"]), "price")
    out = C.add_surrogate_id(out, ["title"])
    assert {"id", "price"} <= set(out.columns) and out.columns[0] == "id"
    assert dict(out.dtypes)["price"] == "double" and dict(out.dtypes)["title"] == "string"
    got = sorted(rows(out, "title", "category", "price"))
    assert got == [("Another Book", "Drama and Suspense", 12.5), ("Some Book", "Sci Fi", 10.99)]


def test_flag_and_category_edges(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["yes", "YES", " yes", "no", None])],
                               "i int, availability string")
    assert [r[0] for r in C.encode_flag(df).orderBy("i").select("availability").collect()] == [1, 1, 0, 0, 0]
    cats = spark.createDataFrame([(0, "Default"), (1, "default"), (2, None), (3, "Add a comment")],
                                 "i int, category string")
    out = C.replace_categories(cats).orderBy("i")
    assert [r[0] for r in out.select("category").collect()] == ["Outros", "default", None, "Outros"]
    assert cats.agg(C.replaced_count()).first()[0] == 2
    assert sorted(rows(C.category_problem_counts(cats))) == [("Add a comment", 1), ("Default", 1)]


def test_surrogate_id_unique_and_deterministic(spark):
    # key 'k1' is hot and shared by exact copies and by different rows
    data = [("k1", "x")] * 50 + [("k1", "y")] * 3 + [("k2", "z"), ("k3", "z"), (None, "n"), (None, "n")]
    df = spark.createDataFrame(data, "key string, v string").repartition(7)
    a = C.add_surrogate_id(df, ["key"])
    ids = [r[0] for r in a.select("id").collect()]
    assert len(ids) == len(data) == len(set(ids))
    b = C.add_surrogate_id(df.repartition(3), ["key"])
    assert sorted(rows(a)) == sorted(rows(b))                 # same ids whatever the partitioning
    solo = dict((r["key"], r["id"]) for r in a.where(F.col("key").isin("k2", "k3")).collect())
    assert all(len(v) == len("book_") + 32 for v in solo.values())
    assert a.columns == ["id", "key", "v"]


def test_surrogate_id_without_shared_keys_is_a_projection(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2).withColumnRenamed("id", "k")
    plan = C.add_surrogate_id(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_dedup(spark):
    data = [("a", 1), ("a", 1), ("b", 2), (None, None), (None, None), ("c", 3)]
    df = spark.createDataFrame(data, "t string, v int").repartition(3)
    fast = sorted(rows(C.dedup_rows(df)), key=str)
    assert fast == sorted(set(data), key=str)
    assert sorted(rows(C.dedup_rows(df, ["t"]), "t"), key=str) == sorted([("a",), ("b",), (None,), ("c",)], key=str)
    some = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y")], "t string, v int, w string")
    for parts in (1, 3):        # the smallest row by the other columns stays, wherever it lies
        assert rows(C.dedup_rows(some.repartition(parts), ["t"])) == [("a", 1, "y")]
    rep = sorted(rows(C.duplicates_report(df)), key=str)
    assert rep == sorted([("a", 1, 2), (None, None, 2)], key=str)


def test_surrogate_id_of_ambiguous_and_short_keys(spark):
    """Separators inside keys, nulls and empty strings make different ids; short
    ids that collide are told apart."""
    keys = [("a\x1fb", "c"), ("a", "b\x1fc"), ("a:b", "c"), ("a", ""), ("a", None), (None, "a"), ("1:a", "-"), ("", "a-")]
    df = spark.createDataFrame(keys, "k string, l string")
    ids = [r["id"] for r in C.add_surrogate_id(df, ["k", "l"]).collect()]
    assert len(set(ids)) == len(keys) and all(len(i) == len("book_") + 32 for i in ids)
    many = spark.range(300).selectExpr("cast(id as string) k", "id v").unionByName(spark.createDataFrame([("7", 7)], "k string, v long"))
    short = C.add_surrogate_id(many, ["k"], hex_len=2)
    assert short.count() == 301 == short.select("id").distinct().count()
