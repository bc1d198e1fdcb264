"""Scalar expressions against FIXTURES.md edge rows and Python's stdlib."""

import hashlib
from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from shelfwise.functions import markup as M
from shelfwise.functions import text as TX
from shelfwise.functions import urls as U


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_parse_price(spark):
    assert one_col(spark, ["£51.77", "Â£51.77", "abc", "", None, " 12 "], TX.parse_price) == \
        [51.77, 51.77, None, None, None, 12.0]


def test_parse_price_locale(spark):
    assert one_col(spark, ["R$ 10,99", "12.50", "1.234,5", "1,234.50", "x"], TX.parse_price_locale) == \
        [10.99, 12.5, 1234.5, 1234.5, None]


def test_parse_availability(spark):
    out = one_col(spark, ["In stock (22 available)", "In stock", "3 left", "", None, "in STOCK (5 Available)"],
                  TX.parse_availability)
    assert [(r["in_stock"], r["stock"]) for r in out] == \
        [(True, 22), (True, None), (False, 3), (False, None), (False, None), (True, 5)]


def test_rating_word(spark):
    assert one_col(spark, ["One", "Five", "Six", None], TX.rating_from_word) == [1, 5, None, None]


def test_slug(spark):
    assert one_col(spark, [None, "", " A  b--C! ", "Ça va?", "x" * 80], TX.slug) == \
        ["unknown", "unknown", "a-b-c", "ça-va", "x" * 50]


def test_title_features(spark):
    assert one_col(spark, ["", "a  b", "a ", None], TX.word_count) == [1, 3, 2, None]
    assert one_col(spark, ["The A", "Then", "the A"], TX.starts_with_the) == [True, False, False]
    assert one_col(spark, ["Vol 2", "no", "٣"], TX.has_digit) == [True, False, True]
    assert one_col(spark, ["café", "a-b", "x_y z"], TX.has_special) == [False, True, False]
    assert one_col(spark, ["é€", "abc"], TX.char_length) == [2, 3]


def test_normalize_text(spark):
    assert one_col(spark, ["Another+Book", "Drama & Suspense", "  a \n b  "], TX.normalize_text) == \
        ["Another Book", "Drama and Suspense", "a b"]


def test_url_extension(spark):
    vals = ["http://h/a/B.PNG?x=1", "http://h/a", "http://h/.hidden", "http://h/a.tar.gz#f", "http://h/d/",
            "rel/x.JPEG"]
    assert one_col(spark, vals, U.url_extension) == [".png", ".jpg", ".jpg", ".gz", ".jpg", ".jpeg"]


def test_url_extension_content_type(spark):
    df = spark.createDataFrame([("http://h/a", "image/png; charset=x"), ("http://h/a", None)], "u string, ct string")
    assert [r[0] for r in df.select(U.url_extension("u", "ct")).collect()] == [".png", ".jpg"]


def test_sha1_matches_hashlib(spark):
    vals = ["http://a/b", "https://é.example/?q=1"]
    assert one_col(spark, vals, U.url_sha1) == [hashlib.sha1(v.encode()).hexdigest() for v in vals]


BASES = ["http://h/a/b/c.html", "http://h", "https://h/x/", "http://h/a/b?q=1#f", "http://h/a/b/c/d/e/f/g/h/i/j.html"]
HREFS = ["../d.html#x", "/e", "http://o/f", "", "?z=2", "#frag", "//cdn.example.com/i.png", "g", "./g/",
         "../../../../../../x", "a/./b/../c", "/p/../q/./r", "..", ".", "../", "a//b", "x/y/../../z?k=v#f",
         "../" * 9 + "deep.html", "/a//../b", "/a/.//b", "/a//..", "x//../y", "./../a/./../../b/c/.."]


def test_canonical_url_matches_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    got = [r[0] for r in df.orderBy("i").select(U.canonical_url("b", "h")).collect()]
    want = [urldefrag(urljoin(b, h))[0] for b, h in pairs]
    diffs = [(p, g, w) for p, g, w in zip(pairs, got, want) if g != w]
    assert not diffs, diffs[:5]


def test_node_text(spark):
    """Each text without outer blanks, joined without a separator; scripts and comments apart."""
    texts = ["  <b>Tom &amp; Jerry</b> &lt;3 ", "<p>a<br>b</p>", "&amp;lt;", "x<!-- no --><script>no</script> y", " ", ""]
    assert one_col(spark, texts, lambda x: M.text_of(M.tokens(x))) == ["Tom & Jerry<3", "ab", "&lt;", "xy", "", ""]


def test_with_resolved_url_equals_expression(spark):
    pairs = [(b, h) for b in BASES + [None, ""] for h in HREFS + [None]]
    df = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    a = df.select("i", U.canonical_url("b", "h").alias("r")).orderBy("i").collect()
    b = U.with_resolved_url(df, "b", "h", "r", canonical=True).orderBy("i").select("i", "r").collect()
    assert a == b
    c = df.select("i", U.resolve_url("b", "h").alias("r")).orderBy("i").collect()
    d = U.with_resolved_url(df, "b", "h", "r").orderBy("i").select("i", "r").collect()
    assert c == d
