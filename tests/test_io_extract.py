"""CSV scan / sink / admission, export encoding and HTML record extraction."""

import html
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfwise.schema import RAW_SCHEMA, SchemaError, require_columns
from shelfwise.sources import csv_io
from shelfwise.functions import html as H
from shelfwise.functions import markup as M
from shelfwise.sources import extract as X
from tests.conftest import rows


def scratch(name):
    return os.path.join(tempfile.mkdtemp(prefix="shelfwise-test-"), name)


def test_csv_empty_vs_null_and_quotes(spark):
    path = scratch("raw.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write('"title","price","rating","category","image","product_page","availability","stock","image_base64"\n')
        fh.write('"A ""quoted"", title",10.5,3,"Poetry","http://i","http://p","yes",4,""\n')
        fh.write('"B",,2,"Default","","","no",,\n')
    df = csv_io.read_csv(spark, path)
    got = rows(df.orderBy("title"), "title", "price", "stock", "image_base64")
    assert got == [('A "quoted", title', 10.5, 4, ""), ("B", None, None, None)]
    assert df.columns[0] == "title"             # the BOM does not leak into the header


def test_write_read_round_trip(spark):
    src = spark.createDataFrame([(1, "x, \"y\"\nz"), (2, ""), (3, None), (4, "  blanks\t ")], "k int, t string")
    path = scratch("out.csv")
    csv_io.write_csv(src, path)
    back = csv_io.read_csv(spark, path, src.schema, multiline=True)
    assert sorted(rows(back)) == sorted(rows(src))


def test_validate_input(spark):
    ok_path = scratch("ok.csv")
    with open(ok_path, "w") as fh:
        fh.write(",".join(f.name for f in RAW_SCHEMA.fields) + "\n")
        fh.write("t,1.0,1,c,i,p,yes,1,\n")
    assert csv_io.validate_input(spark, ok_path) == (True, "ok")
    empty = scratch("empty.csv")
    with open(empty, "w") as fh:
        fh.write(",".join(f.name for f in RAW_SCHEMA.fields) + "\n")
    assert csv_io.validate_input(spark, empty)[0] is False
    assert csv_io.validate_input(spark, scratch("missing.csv"))[0] is False
    assert csv_io.validate_input(spark, scratch("x.txt"))[0] is False
    narrow = scratch("narrow.csv")
    with open(narrow, "w") as fh:
        fh.write("title,price\nt,1\n")
    ok, why = csv_io.validate_input(spark, narrow, schema=None)
    assert not ok and "rating" in why
    try:
        require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b", "c"])
    except SchemaError as exc:
        assert "b, c" in str(exc)


def test_export_encoding_and_observed_counts(spark):
    df = spark.createDataFrame([("t", 1.5, 3, "c", "i", "p", True, 2, None),
                                (None, None, None, None, None, None, None, None, None),
                                ("u", 2.0, 1, "c", "i", "p", False, None, "b64")], RAW_SCHEMA.simpleString()
                               .replace("availability:string", "availability:boolean").replace("struct<", "")
                               .rstrip(">").replace(":", " "))
    enc = csv_io.export_encode(df)
    assert rows(enc, "availability") == [("yes",), ("",), ("no",)]
    assert rows(enc, "stock", "image_base64")[1] == ("", "")
    counts = csv_io.write_export(df, scratch("export.csv"))
    assert counts == {"missing_availability": 1, "missing_stock": 2, "rows": 3}


LISTING = """<html><body><div class="side_categories"><ul class="nav nav-list"><li><ul>
<li><a href="catalogue/category/books/travel_2/index.html">Travel</a></li>
<li><a href="">Empty</a></li></ul></li></ul></div>
<div class="page-header"><h1>Poetry &amp; Verse</h1></div>
<article class="product_pod"><div class="image_container"><a href="../../../a-light_1000/index.html#top">
<img src="../../../../media/cache/2c/da/a.jpg" alt="A Light" class="thumbnail"></a></div>
<p class="star-rating Three"><i class="icon-star"></i></p>
<h3><a href="../../../a-light_1000/index.html" title="A Light in the Attic">A Light ...</a></h3>
<div class="product_price"><p class="price_color">Â£51.77</p></div></article>
<article class="product_pod"><p class="star-rating Seven"></p>
<h3><a href="../../../b_2/index.html">B &amp; C</a></h3>
<p class="price_color">n/a</p></article>
<ul class="pager"><li class="next"><a href="page-2.html">next</a></li></ul></body></html>"""
LISTING_URL = "http://books.example.com/catalogue/category/books/poetry_23/index.html"
PRODUCT_A = '<div class="item active"><img src="../../media/cache/full/a.jpg"></div>' \
            '<p class="instock availability"><i class="icon-ok"></i>\n In stock (22 available)\n</p>'
PRODUCT_B = "<p>no block</p>"


def test_listing_extraction_and_enrichment(spark):
    pages = spark.createDataFrame([(1, LISTING_URL, LISTING)], "page_id long, url string, html string")
    recs = X.extract_listing_records(pages).orderBy("position")
    got = rows(recs, "position", "title", "price", "rating", "category", "product_page")
    assert got == [
        (1, "A Light in the Attic", 51.77, 3, "Poetry & Verse",
         "http://books.example.com/catalogue/a-light_1000/index.html"),
        (2, "B & C", None, None, "Poetry & Verse", "http://books.example.com/catalogue/b_2/index.html")]
    assert recs.first()["image"] == "http://books.example.com/media/cache/2c/da/a.jpg"
    prods = spark.createDataFrame(
        [("http://books.example.com/catalogue/a-light_1000/index.html", PRODUCT_A),
         ("http://books.example.com/catalogue/b_2/index.html", PRODUCT_B)], "url string, html string")
    enr = X.enrich_from_pages(recs, X.extract_product_fields(prods)).orderBy("position")
    assert rows(enr, "availability", "stock") == [(True, 22), (False, None)]
    assert enr.first()["image"] == "http://books.example.com/media/cache/full/a.jpg"
    nxt = X.extract_next_url(pages).first()["next_url"]
    assert nxt == "http://books.example.com/catalogue/category/books/poetry_23/page-2.html"
    links = X.extract_links(pages, path=X.SIDEBAR_LINKS)
    assert rows(links, "name", "link_url") == [
        ("Travel", "http://books.example.com/catalogue/category/books/poetry_23/catalogue/category/books/"
                   "travel_2/index.html")]
    summary = X.extract_summary(recs).first()
    assert (summary["categories"], summary["records"]) == (1, 2)


def test_base64_passthrough(spark):
    long_b64 = "QUJD" * 60
    df = spark.createDataFrame([(long_b64, ""), ("http://x/a.jpg", ""), ("http://x", long_b64)],
                               "image string, image_base64 string")
    out = [r[0] for r in X.base64_passthrough(df).select("image_base64").collect()]
    assert out == [long_b64, "", long_b64]


def one(spark, html, url="http://h.example.com/a/b.html"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_entities_decode_as_the_standard_library_does(spark):
    """Text and attributes; once, so an escaped reference stays text."""
    texts = ["&copy; &middot; &pound;5 &eacute;&#233;&#xE9; &euro; &lt;b&gt; &quot;x&quot; &#39;", "a &amp;lt; b &amp;amp; c", "fish & chips &",
             "&unknown; &#; &#x; &copy 2020 &ampere &notit; &amp", "&#128; &#150; &#0; &#55296; &#1114112;", "&CounterClockwiseContourIntegral; &hellip;&nbsp;x", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(rows(df.select("i", H.decode_entities("t").alias("t")), "i", "t"))
    assert got == {i: html.unescape(t) for i, t in enumerate(texts)}
    page = one(spark, '<nav><a href="p.html?a=1&amp;b=2">A &amp; B</a></nav><nav><a href="q.html">Q</a></nav>')
    assert rows(X.extract_links(page), "position", "name", "link_url") == [
        (1, "A & B", "http://h.example.com/a/p.html?a=1&b=2"), (2, "Q", "http://h.example.com/a/q.html")]


def test_sidebar_availability_rating_and_images(spark):
    side = '<ul class="nav nav-list"><li><a href="i.html">All</a><ul><li><a href="t.html"> Travel </a></li></ul></li></ul>'
    assert rows(X.extract_links(one(spark, side), path=X.SIDEBAR_LINKS), "name") == [("Travel",)]
    cases = {'<p class="outofstock availability">Out of stock (3 available)</p>': (False, None),
             '<p class="instock availability">In stock (99999999999 available)</p>': (True, 99999999999),
             '<p class="instock availability"></p>': (False, None)}
    for markup, want in cases.items():
        assert rows(X.extract_product_fields(one(spark, markup)), "in_stock", "stock") == [want]
    for cls, want in {"star-rating Three": "Three", "Three star-rating": "Three", "big Five star-rating x": "Five", "star-rating Seven": None}.items():
        got = spark.createDataFrame([(f'<p class="{cls}"></p>',)], "t string").select(M.tokens("t").alias("k")).select("k", M.elements("k").alias("e")).select(
            X.rating_word(F.col("k"), F.col("e")).alias("r")).first()["r"]
        assert got == want
    images = '<div class="item"><img src="item.jpg"></div><a class="thumbnail"><span><i></i></span><img class="thumbnail" src="thumb.jpg"></a>'
    assert X.extract_product_fields(one(spark, images)).first()["page_image"] == "http://h.example.com/a/thumb.jpg"


def test_enrichment_keeps_each_listing_row_once(spark):
    listing = spark.createDataFrame([(1, "http://h/p", "i"), (2, None, "j"), (3, None, "k")], "n int, product_page string, image string")
    products = spark.createDataFrame([("http://h/p", True, 3, None), ("http://h/p", True, 5, "z"), (None, True, 9, "y")],
                                     "url string, in_stock boolean, stock bigint, page_image string")
    got = sorted(rows(X.enrich_from_pages(listing, products), "n", "image", "availability", "stock"))
    assert got == [(1, "i", True, 3), (2, "j", False, None), (3, "k", False, None)]


HEADER = ",".join(f.name for f in RAW_SCHEMA.fields) + "\n"
GOOD = ['"A, 1",1.5,3,c,i,p,yes,4,\n', 'B,2.5,4,c,i,q,no,5,\n']
BAD = ['C,cheap,3,c,i,p,yes,4,\n', 'D,1.0\n', 'E,1.0,3,c,i,p,yes,4,,extra,fields\n', 'F,1.0,3,c,i,p,yes,"4 left",\n']


def csv_folder(*files):
    place = scratch("in.csv")
    os.makedirs(place)
    for i, lines in enumerate(files):
        with open(os.path.join(place, f"{i}.csv"), "w", encoding="utf-8-sig" if i % 2 else "utf-8") as fh:
            fh.write(HEADER + "".join(lines))
    return place


def test_bad_lines_go_to_quarantine_and_the_others_go_on(spark):
    place, bad_path = csv_folder([GOOD[0], BAD[0], BAD[1]], [BAD[2], GOOD[1], BAD[3]]), scratch("bad")
    good, counts, _ = csv_io.read_quarantined(spark, place, bad_path)
    assert counts == {"rows": 6, "bad_rows": 4} and good.schema.names == RAW_SCHEMA.names
    assert sorted(rows(good, "title", "price", "stock")) == [("A, 1", 1.5, 4), ("B", 2.5, 5)]
    held = rows(spark.read.parquet(bad_path), "line", "file")
    assert sorted(x for x, _ in held) == sorted(x.rstrip("\n") for x in BAD) and {os.path.basename(f) for _, f in held} == {"0.csv", "1.csv"}
    with pytest.raises(Exception):
        csv_io.read_csv(spark, place).collect()         # strict as before
    # a file without bad lines empties the quarantine table; one without any line is no error
    good, counts, _ = csv_io.read_quarantined(spark, csv_folder(GOOD), bad_path)
    assert counts == {"rows": 2, "bad_rows": 0} and good.count() == 2 and spark.read.parquet(bad_path).count() == 0
    good, counts, _ = csv_io.read_quarantined(spark, csv_folder([]), bad_path)
    assert counts == {"rows": 0, "bad_rows": 0} and good.count() == 0
    good, counts, _ = csv_io.read_quarantined(spark, csv_folder(BAD), bad_path)
    assert counts == {"rows": 4, "bad_rows": 4} and good.count() == 0


def test_quarantine_of_columns_with_its_own_names(spark):
    from pyspark.sql import types as T

    place = scratch("in.csv")
    with open(place, "w") as fh:
        fh.write("line,bad,file\n1,x,y\nz,x,y\n")
    schema = T.StructType.fromDDL("line int, bad string, file string")
    good, counts, _ = csv_io.read_quarantined(spark, place, scratch("bad"), schema)
    assert rows(good) == [(1, "x", "y")] and counts == {"rows": 2, "bad_rows": 1}


def test_admission_of_a_first_line_that_does_not_parse(spark):
    place = csv_folder([BAD[0], GOOD[0]])
    assert csv_io.validate_input(spark, place)[0] is False
    assert csv_io.validate_input(spark, place, bad_rows="quarantine") == (True, "ok")


def test_command_line_with_quarantine(spark, tmp_path):
    from shelfwise import cli
    from shelfwise.schema import SchemaError

    good = ['"A, 1",1.5,3,c,i,p,yes,4,""\n', 'B,2.5,4,c,i,q,no,5,""\n']
    args = ["--processed", str(tmp_path / "p"), "--features", str(tmp_path / "f"), "--quarantine", str(tmp_path / "bad"), "--full"]
    stats = cli.main(["--input", csv_folder([BAD[0], *good]), *args], spark)
    assert stats["bad_rows"] == 1 and stats["processed_records"] == 2 and spark.read.parquet(str(tmp_path / "f")).count() == 2
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    with pytest.raises(SchemaError, match="no line fits"):
        cli.main(["--input", csv_folder(BAD), *args], spark)
    with pytest.raises(Exception):
        cli.main(["--input", csv_folder([*good, BAD[0]]), *args[:4], "--full"], spark)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2      # the failed run published nothing


def test_export_bytes_equal_the_csv_writers(spark):
    """Byte-order mark, header, quotes and line ends in every file."""
    import csv
    import glob
    import io

    data = [("a \"b\", c", 51.77, 3, "x\ny", "i", "p", True, 2, None), (None, None, None, None, None, None, None, None, None),
            ("é 漢", 0.5, 1, "", "i", "p", False, 0, "QUJD"), (" edge ", 100.0, 5, "tab\t", "\\", "p", True, 7, "")]
    df = spark.createDataFrame(data, "title string, price double, rating int, category string, image string, product_page string, "
                                     "availability boolean, stock int, image_base64 string")
    for parts in (1, 3):
        place = scratch("export.csv")
        assert csv_io.write_export(df.repartition(parts), place)["rows"] == 4
        files = [open(f, "rb").read() for f in glob.glob(place + "/part-*") if os.path.getsize(f)]
        assert files and all(f.startswith(b"\xef\xbb\xbf\"title\",") and f.endswith(b"\r\n") for f in files)
        lines = []
        for f in files:
            out = io.StringIO(newline="")
            got = list(csv.reader(io.StringIO(f.decode("utf-8-sig"), newline="")))
            csv.writer(out, quoting=csv.QUOTE_ALL).writerows(got)
            assert out.getvalue().encode("utf-8-sig") == f
            assert got[0] == list(csv_io.EXPORT_COLUMNS)
            lines += got[1:]
        text = lambda v: "yes" if v is True else "no" if v is False else "" if v is None else str(v)
        assert sorted(lines) == sorted([[text(v) for v in r] for r in data])
        back = csv_io.read_csv(spark, place, schema=spark.createDataFrame([], ", ".join(f"{c} string" for c in csv_io.EXPORT_COLUMNS)).schema, multiline=True)
        assert sorted(map(list, rows(back))) == sorted(lines)
    place = scratch("export.csv")
    assert csv_io.write_export(df.limit(0), place) == {"missing_availability": 0, "missing_stock": 0, "rows": 0}
    files = [f for f in (open(f, "rb").read() for f in glob.glob(place + "/part-*")) if f]
    assert files == [b"\xef\xbb\xbf" + ",".join(f'"{c}"' for c in csv_io.EXPORT_COLUMNS).encode() + b"\r\n"]
