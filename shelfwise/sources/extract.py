"""Record extraction from a table of stored HTML pages.

Listing pages give one row per ``article.product_pod``; product pages give
availability, stock and the large image; the two are joined on the
canonical product URL.  Navigation links, the next-page link and page-level
fields come from the same page table.  Pages are taken apart by
``functions.markup``; everything is column expressions plus ``posexplode`` and an
equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import BASE64_MIN_LENGTH, RATING_WORDS
from shelfwise.functions import markup as M
from shelfwise.functions import text as TX
from shelfwise.functions import urls as U

NAV_LINKS = "nav a"
SIDEBAR_LINKS = "ul.nav.nav-list ul li a"
BASE64_TEXT_RE = r"^[A-Za-z0-9+/=\s]{" + str(BASE64_MIN_LENGTH) + r",}$"


def _parsed(pages: DataFrame, html: str, *keep: Column) -> DataFrame:
    """``keep`` with the page's tokens and elements, each worked out once."""
    cut = pages.select(*keep, M.tokens(html).alias("_tok"))
    return cut.select("*", M.elements("_tok").alias("_el"))


def _arrays() -> tuple[Column, Column]:
    return F.col("_tok"), F.col("_el")


def rating_word(tok: Column, el: Column) -> Column:
    """The rating word among the classes of the first rating element, in their order;
    without one there, of another element that has just it and ``star-rating``."""
    words = [w for w, _ in RATING_WORDS]
    ratings = M.select(tok, el, "p.star-rating")
    own = M.first(F.filter(M.classes(M.tag(tok, M.first(ratings))), lambda c: c.isin(*words)))
    both = F.transform(ratings, lambda e: F.array_join(M.classes(M.tag(tok, e)), " "))
    other = M.first(F.filter(F.array(*map(F.lit, words)), lambda w: F.array_contains(both, F.concat(F.lit("star-rating "), w))))
    return F.coalesce(own, other)


def extract_listing_records(pages: DataFrame, key: str = "page_id", url: str = "url",
                            html: str = "html") -> DataFrame:
    """(key, position, title, price, rating, category, image, product_page)."""
    tok, el = _arrays()
    page = _parsed(pages, html, F.col(key), F.col(url).alias("_url"))
    articles = F.transform(M.select(tok, el, "article.product_pod"), lambda e: M.inside(tok, el, e))
    base = (page.select(key, "_url", M.text(tok, M.first(M.select(tok, el, "h1"))).alias("category"), articles.alias("_arts"))
            # the outer form avoids the optimizer re-running the page's work in
            # an inferred size(...) > 0 filter; pages without articles are dropped here
            .select(key, "_url", "category", F.posexplode_outer("_arts").alias("_pos", "_a"))
            .where(F.col("_a").isNotNull()))
    own = F.col("_a.tok"), F.col("_a.el")
    heading = M.inside(*own, M.first(M.select(*own, "h3")))
    # lookups first, texts and attributes next, URL resolution last: each once per article
    found = base.select(
        F.col(key), (F.col("_pos") + 1).cast("int").alias("position"), "category", "_url", own[0].alias("_tok"),
        heading.alias("_h3"), M.first(M.select(*own, "p.price_color")).alias("_price"),
        rating_word(*own).alias("_rating"), M.first(M.select(*own, "img")).alias("_image"))
    linked = found.select("*", M.first(M.select(F.col("_h3.tok"), F.col("_h3.el"), "a")).alias("_link"))
    link = M.tag(F.col("_h3.tok"), F.col("_link"))
    raw = linked.select(
        key, "position", "category", "_url", "_rating",
        M.decoded(title=M.raw_attribute(link, "title"), name=M.raw_text(M.content(F.col("_h3.tok"), F.col("_link"))),
                  price=M.raw_text(M.content(tok, F.col("_price"))), img=M.raw_attribute(M.tag(tok, F.col("_image")), "src"),
                  href=M.raw_attribute(link, "href")).alias("_f"))
    fields = raw.select(
        key, "position",
        F.coalesce(F.nullif("_f.title", F.lit("")), M.clean_text(F.col("_f.name"))).alias("title"),
        TX.parse_price(M.clean_text(F.col("_f.price"))).alias("price"),
        TX.rating_from_word(F.col("_rating")).alias("rating"), "category", "_url",
        F.nullif("_f.img", F.lit("")).alias("_img"), F.nullif("_f.href", F.lit("")).alias("_href"))
    with_img = U.with_resolved_url(fields, "_url", "_img", "image")
    with_page = U.with_resolved_url(with_img, "_url", "_href", "product_page", canonical=True)
    return with_page.select(key, "position", "title", "price", "rating", "category", "image", "product_page")


def extract_product_fields(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, in_stock, stock, page_image) of product pages; a page without
    the availability block gives (false, null)."""
    tok, el = _arrays()
    page = _parsed(pages, html, U.drop_fragment(F.col(url)).alias("url"), F.col(url).alias("_u"))
    # exactly these classes, in this order
    block = M.first(F.filter(M.select(tok, el, "p.instock.availability"),
                             lambda e: F.array_join(M.classes(M.tag(tok, e)), " ") == "instock availability"))
    image = F.coalesce(M.first(M.select(tok, el, ".thumbnail img")), M.first(M.select(tok, el, "div.item img")))
    found = page.select("url", "_u", "_tok", block.alias("_block"), image.alias("_image"))
    raw = found.select("url", "_u", "_block", M.decoded(
        text=M.raw_text(M.content(tok, F.col("_block"))), img=M.raw_attribute(M.tag(tok, F.col("_image")), "src")).alias("_f"))
    parsed = raw.select("url", "_u", "_block", TX.parse_availability(M.clean_text(F.col("_f.text"), " ")).alias("_p"),
                        F.nullif("_f.img", F.lit("")).alias("_img"))
    fields = parsed.select(
        "url", "_u", "_img",
        F.when(F.col("_block").isNull(), F.lit(False)).otherwise(F.col("_p.in_stock")).alias("in_stock"),
        F.when(F.col("_block").isNull(), F.lit(None).cast("bigint")).otherwise(F.col("_p.stock")).alias("stock"))
    return (U.with_resolved_url(fields, "_u", "_img", "page_image")
            .select("url", "in_stock", "stock", "page_image"))


def enrich_from_pages(listing: DataFrame, products: DataFrame) -> DataFrame:
    """Listing rows left-joined to their product page on the canonical URL.

    No product page (or no block) -> availability false, stock null; the
    product page image replaces the listing thumbnail when present.  Several
    stored pages of one URL count as one (the smallest by its fields), so a listing
    row comes out once.  Rows without a product URL go around the join.  The
    planner picks broadcast or sort-merge from the sizes it sees at run time.
    """
    one = products.where(F.col("url").isNotNull()).groupBy("url").agg(F.min(F.struct("in_stock", "stock", "page_image")).alias("_p"))
    p = one.select(F.col("url").alias("_purl"), "_p.in_stock", "_p.stock", "_p.page_image")
    out = [c for c in listing.columns if c not in ("image",)]
    # a null key is replaced by a hash of its row, which spreads such rows and matches nothing
    key = F.coalesce(F.col("product_page"), F.concat(F.lit("null:"), F.xxhash64(*listing.columns).cast("string")))
    j = listing.withColumn("_key", key).join(p, F.col("_key") == F.col("_purl"), "left")
    return j.select(*out, F.coalesce(F.col("page_image"), F.col("image")).alias("image"),
                    F.coalesce(F.col("in_stock"), F.lit(False)).alias("availability"), "stock")


def extract_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                  path: str = NAV_LINKS) -> DataFrame:
    """(key, position, name, href, link_url) of the links with an address that ``path``
    leads to, numbered through the page.  ``SIDEBAR_LINKS`` are the categories of a
    side navigation."""
    tok, el = _arrays()
    page = _parsed(pages, html, F.col(key), F.col(url).alias("_url"))
    found = F.transform(M.select(tok, el, path), lambda e: F.struct(M.raw_attribute(M.tag(tok, e), "href").alias("href"), M.raw_text(M.content(tok, e)).alias("name")))
    each = (page.select(key, "_url", F.posexplode_outer(F.filter(found, lambda x: x["href"].isNotNull())).alias("_pos", "_l"))
            .where(F.col("_l.href") != "")
            .select(key, "_url", (F.col("_pos") + 1).cast("int").alias("position"), M.decoded(href=F.col("_l.href"), name=F.col("_l.name")).alias("_l"))
            .select(key, "_url", "position", F.col("_l.href").alias("href"), M.clean_text(F.col("_l.name")).alias("name")))
    return (U.with_resolved_url(each, "_url", "href", "link_url", canonical=True)
            .select(key, "position", "name", "href", "link_url"))


def extract_next_url(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    tok, el = _arrays()
    page = _parsed(pages, html, F.col(key), F.col(url).alias("_u"))
    nxt = page.select(key, "_u", F.nullif(M.attribute(M.tag(tok, M.first(M.select(tok, el, "li.next a"))), "href"), F.lit("")).alias("_n"))
    return U.with_resolved_url(nxt, "_u", "_n", "next_url").select(key, "next_url")


def extract_page_fields(pages: DataFrame, key: str = "page_id", url: str = "url",
                        html: str = "html") -> DataFrame:
    """Per page: title, h1 text, language, number of links, length of its text."""
    tok, el = _arrays()
    page = _parsed(pages, html, F.col(key), U.drop_fragment(F.col(url)).alias("canonical_url"))
    one = lambda path: M.first(M.select(tok, el, path))
    raw = page.select(
        key, "canonical_url",
        M.decoded(title=M.raw_text(M.content(tok, one("title"))), heading=M.raw_text(M.content(tok, one("h1"))),
                  lang=M.raw_attribute(M.tag(tok, one("html")), "lang"), text=M.raw_text(tok)).alias("_f"),
        F.size(F.filter(M.select(tok, el, "a"), lambda e: M.raw_attribute(M.tag(tok, e), "href").isNotNull())).cast("bigint").alias("n_links"))
    return raw.select(key, "canonical_url", M.clean_text(F.col("_f.title")).alias("title"), M.clean_text(F.col("_f.heading")).alias("heading"),
                      F.col("_f.lang").alias("lang"), "n_links", F.char_length(M.clean_text(F.col("_f.text"))).cast("bigint").alias("text_length"))


def extract_summary(records: DataFrame, category: str = "category") -> DataFrame:
    """One row: number of categories and of records."""
    return records.agg(F.count_distinct(category).cast("bigint").alias("categories"),
                       F.count(F.lit(1)).cast("bigint").alias("records"))


def base64_passthrough(df: DataFrame, image: str = "image", b64: str = "image_base64",
                       out: str = "image_base64") -> DataFrame:
    """Keep an existing base64 image: the field if longer than 200, or the
    URL field when it is itself base64 text of 200+ characters; else ''."""
    i, b = F.col(image), F.col(b64)
    kept = (F.when(F.char_length(b) > BASE64_MIN_LENGTH, b)
            .when((F.char_length(i) > BASE64_MIN_LENGTH) & i.rlike(BASE64_TEXT_RE), i)
            .otherwise(F.lit("")))
    return df.withColumn(out, kept)
