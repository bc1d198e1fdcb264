"""Driver tables and their catalogue bindings.

The catalogue view joins ``lineitem`` to ``part`` and ``orders``:
title = p_name, price = l_extendedprice, rating = first digit of
o_orderpriority, category = p_type, stock = l_quantity, availability =
'yes' when l_returnflag = 'N'.  Both joins are on keys of dimension tables
that grow with the data (part = 200k x SF rows), so no side is forced to
broadcast; AQE chooses at run time from the measured sizes.

Listing and product pages for record extraction are derived from ``part``
by Spark (one listing page per up to 20 parts of a type, one product page
per part), so their size grows with the data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import Bands

CATALOGUE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
# price bands scaled to l_extendedprice (the default 20 / 40 / 50 fit book prices)
CATALOGUE_PRICE_BANDS = Bands.price().scaled(1000.0)
CATALOGUE_PROBLEMATIC = ("PROMO", "STANDARD")
LISTING_PAGE_SIZE = 20
# parts whose pages one task writes and takes apart (about a millisecond of CPU each)
PAGES_PER_TASK = 20_000
SITE = "http://books.example.com"


def _most_and_all(df: DataFrame) -> tuple[int, int]:
    """Rows of the largest partition and of all; no column is read for it."""
    per = df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    row = per.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    return row["most"], row["rows"]


def spread(df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Deals out the rows of an uneven input before CPU-heavy row work.

    Spark splits files by bytes but reads a Parquet row group in one task, so of
    several splits one may hold every row: the rows of each are counted.  Where the
    largest holds more than twice a core's share (with ``rows_per_task``: than that
    many rows) the rows are dealt out evenly; other inputs are left as they are."""
    most, rows = _most_and_all(df)
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if rows_per_task is None:
        even = most * tasks <= 2 * rows
    else:
        tasks = max(tasks, -(-rows // rows_per_task))
        even = most * tasks <= 2 * rows and most <= rows_per_task
    return df if even else df.repartition(tasks)


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """A driver table; ``spread_rows`` for inputs that feed CPU-heavy row
    work (regex over whole texts and pages, the catalogue join and ids)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


def catalogue_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw catalogue table (the nine raw columns) plus the four key columns."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        *CATALOGUE_KEY, "l_quantity", "l_extendedprice", "l_returnflag"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = (li.join(p, li["l_partkey"] == p["p_partkey"])
         .join(o, li["l_orderkey"] == o["o_orderkey"]))
    return j.select(
        *CATALOGUE_KEY,
        F.col("p_name").alias("title"),
        F.col("l_extendedprice").alias("price"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.col("p_type").alias("category"),
        F.lit("").alias("image"),
        F.lit("").alias("product_page"),
        F.when(F.col("l_returnflag") == "N", F.lit("yes")).otherwise(F.lit("no")).alias("availability"),
        F.col("l_quantity").cast("int").alias("stock"),
        F.lit("").alias("image_base64"),
    )


RATING_WORD_EXPR = ("CASE p_size % 5 WHEN 0 THEN 'One' WHEN 1 THEN 'Two' WHEN 2 THEN 'Three' "
                    "WHEN 3 THEN 'Four' ELSE 'Five' END")


def _item_path(key) -> F.Column:
    return F.concat(F.lit("catalogue/item-"), key.cast("string"), F.lit("/index.html"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html) listing pages built from ``part``.

    Parts are grouped by (type, partkey div 20): each group holds at most 20
    rows by construction, so the per-page ``collect_list`` is bounded.
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    href = F.concat(F.lit("../../../../"), _item_path(F.col("p_partkey")))
    article = F.concat(
        F.lit('<article class="product_pod"><div class="image_container"><a href="'), href,
        F.lit('"><img src="../../../../media/cache/'), F.col("p_partkey").cast("string"),
        F.lit('.jpg" alt="cover" class="thumbnail"></a></div><p class="star-rating '),
        F.expr(RATING_WORD_EXPR),
        F.lit('"><i class="icon-star"></i></p><h3><a href="'), href, F.lit('" title="'),
        F.col("p_name"), F.lit('">'), F.col("p_name"),
        F.lit('</a></h3><div class="product_price"><p class="price_color">£'),
        F.col("p_retailprice").cast("string"), F.lit("</p></div></article>"))
    grp = (F.col("p_partkey") / LISTING_PAGE_SIZE).cast("bigint")
    pages = (p.groupBy(F.col("p_type"), grp.alias("g"))
             .agg(F.min("p_partkey").alias("page_id"),
                  F.array_sort(F.collect_list(F.struct(F.col("p_partkey").alias("k"),
                                                       article.alias("a")))).alias("arts")))
    slug = F.lower(F.col("p_type"))
    # a number of partitions by rows: by bytes alone all pages would be one task's work
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-_most_and_all(p)[1] // PAGES_PER_TASK))
    pages = pages.repartition(tasks, "page_id")
    return pages.select(
        F.col("page_id"),
        F.concat(F.lit(SITE + "/catalogue/category/books/"), slug, F.lit("_"),
                 F.col("g").cast("string"), F.lit("/index.html")).alias("url"),
        F.concat(F.lit('<html><body><div class="page-header"><h1>'), F.col("p_type"),
                 F.lit("</h1></div><ol>"), F.array_join(F.transform("arts", lambda s: s["a"]), ""),
                 F.lit('</ol><ul class="pager"><li class="next"><a href="page-2.html">next</a></li></ul>'
                       '</body></html>')).alias("html"))


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, html) product pages built from ``part``; parts whose size is a
    multiple of 7 have no availability block."""
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), PAGES_PER_TASK)
    block = F.when(F.col("p_size") % 7 == 0, F.lit("")).otherwise(F.concat(
        F.lit('<p class="instock availability"><i class="icon-ok"></i> In stock ('),
        F.col("p_size").cast("string"), F.lit(" available)</p>")))
    return p.select(
        F.concat(F.lit(SITE + "/"), _item_path(F.col("p_partkey"))).alias("url"),
        F.concat(F.lit('<html><body><div class="item active"><img src="../../media/full/'),
                 F.col("p_partkey").cast("string"), F.lit('.jpg" alt="cover"></div>'), block,
                 F.lit("</body></html>")).alias("html"))


# Six ways in which people write the same page.  {k}: part key, {n}: name, {t}: type, {p}: price,
# {w}: rating word, {z}: size.
HANDWRITTEN = (
    # plain
    """<!DOCTYPE html><html lang="en"><head><title>{t} books</title></head><body>
<ul class="nav nav-list"><li><a href="index.html">All</a><ul><li><a href="../{t}_{z}/index.html"> {t} </a></li>
<li><a href="">none</a></li></ul></li></ul><h1>{t}</h1><div class="item"><img src="full/{k}.png"></div>
<article class="product_pod"><img src="cache/{k}.jpg"><p class="star-rating {w}"></p><h3><a href="../item-{k}/i.html#top" title="{n}">{n} ...</a></h3>
<p class="price_color">£{p}</p></article><p class="instock availability">In stock ({z} available)</p><ul><li class="next"><a href="page-{z}.html">next</a></li></ul></body></html>""",
    # upper case, single quotes, blanks around '=', self-closed tags
    """<HTML LANG='en'><HEAD><TITLE>
  {t} books </TITLE></HEAD><BODY CLASS = 'x'><UL CLASS = 'first nav nav-list'><LI><A HREF = 'index.html'>All</A><UL><LI><A
  HREF = '../{t}_{z}/index.html'>{t}</A></LI></UL></LI></UL><H1 >{t}</H1 ><DIV CLASS='big item'><IMG ALT='a "cover"' SRC='full/{k}.png' /></DIV>
<ARTICLE id='a' CLASS='product_pod'><IMG SRC='cache/{k}.jpg'/><P CLASS='star-rating {w}'/><H3><A TITLE='{n}' HREF='../item-{k}/i.html'>x</A></H3><P CLASS='price_color'>
  £{p}
</P></ARTICLE><P CLASS='instock availability'><I CLASS='icon'/>
 In stock <B>({z} available)</B></P><LI CLASS='next'><A HREF='page-{z}.html'>next</A></LI></BODY></HTML>""",
    # bare values, '>' in values, unclosed paragraphs and list items
    """<html lang=en><head><title>{t} books</title><body data-x="a > b"><ul class="nav nav-list" title='> >'><li><a href=index.html>All</a><ul><li><a href=../{t}_{z}/index.html title="1 > 0">{t}</a></ul></ul>
<h1 title="<h1>no</h1>">{t}</h1><div class=item><p>cover:<img alt='>' src=full/{k}.png></div><p>text<article class=product_pod title="a > b"><img src=cache/{k}.jpg><p class="star-rating {w}"><h3><a href=../item-{k}/i.html title="{n}">more ></a></h3>
<p class=price_color>£{p}</article><p class="instock  availability">In stock ({z} available)<ul><li class=next><a href=page-{z}.html>next</a></ul>""",
    # comments, scripts and styles that hold markup
    """<!-- <html lang="no"><h1>no</h1> --><html lang="en"><head><title>{t} books</title><style>p > a { color: red } /* <h1>no</h1> */</style>
<script>document.write('<article class="product_pod"><h1>no</h1></article><ul class="nav nav-list"><ul><li><a href="no">no</a>');</script></head><body><!-- <article class="product_pod"><h3><a href="no" title="no">no</a></h3></article> -->
<ul class="nav nav-list"><!--<li><ul><li><a href="no">no</a></li></ul></li>--><li><ul><li><a href="../{t}_{z}/index.html"><!-- no -->{t}</a></li></ul></li></ul><h1><!-- no -->{t}<script>"no"</script></h1>
<div class="item"><!--<img src="no.png">--><img src="full/{k}.png"></div><article class="product_pod"><!--><img src="cache/{k}.jpg"><script>var a = "</article>";</script><p class="star-rating {w}"></p>
<h3><!-- <a href="no">no</a> --><a href="../item-{k}/i.html"><b>{n}</b></a></h3><p class="price_color">£<!-- 0 -->{p}</p></article>
<!-- <p class="instock availability">In stock (0 available)</p> --><p class="instock availability"><!-- Out of stock -->In stock ({z} available)</p><li class="next"><!--<a href="no">--><a href="page-{z}.html">next</a></li></body></html>""",
    # elements within elements of the same name
    """<html lang="en"><head><title>{t} books</title></head><body><div><ul class="nav nav-list"><li><div><ul><li><span><a href="../{t}_{z}/index.html"><i>{t}</i></a></span></li></ul></div></li></ul></div><ul><li><a href="no">no</a></li></ul>
<div><div><h1><span>{t}</span></h1></div></div><div class="item"><div><div></div><img src="full/{k}.png"></div></div><div class="product_pod"><article>no</article></div>
<article class="product_pod"><div><div><img src="cache/{k}.jpg"></div></div><div><p class="star-rating {w}"><span><i></i></span></p></div><h3><span><a href="../item-{k}/i.html"><b> {n} </b></a></span><a href="no" title="no">no</a></h3>
<div><p class="price_color"><span>£</span><span>{p}</span></p></div></article><p class="instock availability"><span><b>In stock</b></span> <span>({z} available)</span></p><ul><li><ul><li class="last next"><b><a href="page-{z}.html">next</a></b></li></ul></li></ul></body></html>""",
    # references, repeated attributes, stray tags and signs
    """<html lang="no" lang="en"></b><head><title>{t}&#32;books</title></head></p><body></div></span><ul class="nav&#32;no" class="nav nav-list"><li></b><ul></i><li><a href="&#46;./{t}_{z}/index.html">{t}</a></li></ul></li></ul>
1 < 2 <3 & <> </> <? no ?><h1>{t}</h1></h1></article><div class="item"><img src="no" src="full/{k}.png"></div><article class="product_pod"></ul><img src="cache/{k}&period;jpg"><p class="star-rating {w}"></p></h3>
<h3><a title="" href="../item-{k}/i.html?">{n}</a></h3><p class="price_color">&pound;{p}</p></article></article><p class="instock availability">In stock &lpar;{z} available&rpar;</p><li class="next"></ul><a href="page-{z}.html">next</a></li><a """,
)


def handwritten_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): one page a part, written in one of six ways."""
    p = spread(table(spark, sf_dir, "part"), PAGES_PER_TASK)
    values = {"k": F.col("p_partkey").cast("string"), "n": F.col("p_name"), "t": F.col("p_type"), "p": F.col("p_retailprice").cast("string"),
              "w": F.expr(RATING_WORD_EXPR), "z": F.col("p_size").cast("string")}

    def written(way: str) -> F.Column:
        parts = re.split(r"\{(\w)\}", way)
        return F.concat(*(values[x] if i % 2 else F.lit(x) for i, x in enumerate(parts)))

    html = F.lit(None).cast("string")
    for i, way in enumerate(HANDWRITTEN):
        html = F.when(F.col("p_partkey") % len(HANDWRITTEN) == i, written(way)).otherwise(html)
    return p.select(F.col("p_partkey").alias("page_id"), F.concat(F.lit(SITE + "/hand/"), F.lower("p_type"), F.lit("/index.html")).alias("url"), html.alias("html"))
