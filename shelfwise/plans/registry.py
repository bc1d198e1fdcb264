"""Registered queries: one Spark plan per operator of the inventory, bound
to the driver tables, with the equivalent DuckDB SQL used as the oracle.

Every query reads whole tables (or pages Spark derives from them); limits
appear only where the limit is the operator (first-n, top-k, paging).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.config import BASE64_MIN_LENGTH, TITLE_LENGTH_BINS, TITLE_WORD_BINS, Bands, PipelineConfig
from shelfwise.functions import markup as M
from shelfwise.functions import text as TX
from shelfwise.functions import urls as U
from shelfwise.operators import clean as C
from shelfwise.operators import features as FE
from shelfwise.operators import profile as P
from shelfwise.operators import quality as Q
from shelfwise.operators import sketches as SK
from shelfwise.operators.common import staged as stage_table
from shelfwise.plans import etl as E
from shelfwise.plans import sqltext as S
from shelfwise.plans import tables as TB
from shelfwise.session import remove_path, staging_path
from shelfwise.sources import csv_io
from shelfwise.sources import extract as X

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def normalize_types(df: DataFrame) -> DataFrame:
    """Small integer types -> bigint, float -> double (oracle type parity)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def t(spark: SparkSession, sf: str, name: str, spread_rows: bool = False) -> DataFrame:
    """A driver table; ``spread_rows`` for queries that run regexes over
    whole texts or raw pages (see ``plans.tables.spread``)."""
    return TB.table(spark, sf, name, spread_rows=spread_rows)


CFG = PipelineConfig(price_bands=TB.CATALOGUE_PRICE_BANDS,
                     problematic_categories=TB.CATALOGUE_PROBLEMATIC)
KEY = list(TB.CATALOGUE_KEY)
KEY_SQL = ", ".join(KEY)

# ---------------------------------------------------------------------------------
# shared SQL building blocks
# ---------------------------------------------------------------------------------
CAT_SQL = f"""cat AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, p.p_name AS title,
         l.l_extendedprice AS price, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS rating,
         p.p_type AS category, '' AS image, '' AS product_page,
         CASE WHEN l.l_returnflag = 'N' THEN 'yes' ELSE 'no' END AS availability,
         CAST(l.l_quantity AS INTEGER) AS stock, '' AS image_base64
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_RAW_SQL = "title, price, rating, category, image, product_page, availability, stock, image_base64"
_RAW_LIST = [c.strip() for c in _RAW_SQL.split(",")]
# ids: md5 of the key; rows of a shared key get md5(content)[:16] and a copy number
IDS_SQL = f"""k0 AS (SELECT *, {S.key_digest(KEY)} AS _k FROM cat),
kc AS (SELECT _k, count(*) AS _n FROM k0 GROUP BY _k),
ids AS (
  SELECT 'book_' || k0._k AS id, {_RAW_SQL} FROM k0 JOIN kc USING (_k) WHERE kc._n = 1
  UNION ALL
  SELECT 'book_' || _k || '_' || {S.key_digest(_RAW_LIST)} || '_' || CAST(i AS VARCHAR) AS id, {_RAW_SQL}
  FROM (SELECT *, unnest(generate_series(1, _c)) AS i
        FROM (SELECT k0._k, {KEY_SQL}, {_RAW_SQL}, count(*) AS _c FROM k0 JOIN kc USING (_k)
              WHERE kc._n > 1 GROUP BY ALL) g) e)"""

PROC_SQL = f"""{IDS_SQL},
proc AS (
  SELECT id, title, price, rating,
         CASE WHEN category IN ('PROMO', 'STANDARD') THEN 'Outros' ELSE category END AS category,
         image, product_page, CASE WHEN lower(availability) = 'yes' THEN 1 ELSE 0 END AS availability,
         stock, image_base64
  FROM ids)"""

FEAT0_SQL = f"""feat0 AS (
  SELECT id, title, price, rating, category, image, product_page, availability, stock, image_base64,
         {S.band('price', CFG.price_bands)} AS price_range, {S.title_features('title')},
         {S.rating_label('rating')} AS rating_category, {S.band('stock', CFG.stock_bands)} AS stock_level,
         (rating / 5.0::DOUBLE) * 0.7::DOUBLE
           + (CAST(stock AS DOUBLE) / CAST(mx.m AS DOUBLE)) * 0.3::DOUBLE AS popularity_score
  FROM proc, (SELECT max(stock) AS m FROM proc) mx)"""

CAT_VOCAB = ("ECONOMY", "LARGE", "MEDIUM", "Outros", "SMALL")
ONE_HOT_SQL = ", ".join(
    f"CAST(CASE WHEN category = {S.q(v)} THEN 1 ELSE 0 END AS BIGINT) AS category_{v.lower()}"
    for v in CAT_VOCAB)
FEAT_SQL = f"feat AS (SELECT *, {ONE_HOT_SQL} FROM feat0)"

WITH_PROC = f"WITH {CAT_SQL},\n{PROC_SQL}\n"
WITH_FEAT = f"WITH {CAT_SQL},\n{PROC_SQL},\n{FEAT0_SQL},\n{FEAT_SQL}\n"

FEAT_OUT_SQL = ("id, title, price, CAST(rating AS BIGINT) AS rating, category, image, product_page, "
                "CAST(availability AS BIGINT) AS availability, CAST(stock AS BIGINT) AS stock, image_base64, "
                "price_range, has_subtitle, has_series, starts_with_the, title_length, rating_category, "
                "stock_level, title_word_count, has_numbers, popularity_score, "
                + ", ".join(f"category_{v.lower()}" for v in CAT_VOCAB))
PROC_OUT_SQL = ("id, title, price, CAST(rating AS BIGINT) AS rating, category, image, product_page, "
                "CAST(availability AS BIGINT) AS availability, CAST(stock AS BIGINT) AS stock, image_base64")

# derived listing / product pages (mirror of plans.tables)
_HREF = "'../../../../catalogue/item-' || CAST(p_partkey AS VARCHAR) || '/index.html'"
_ARTICLE = ("'<article class=\"product_pod\"><div class=\"image_container\"><a href=\"' || " + _HREF
            + " || '\"><img src=\"../../../../media/cache/' || CAST(p_partkey AS VARCHAR) || "
            "'.jpg\" alt=\"cover\" class=\"thumbnail\"></a></div><p class=\"star-rating ' || "
            + TB.RATING_WORD_EXPR + " || '\"><i class=\"icon-star\"></i></p><h3><a href=\"' || " + _HREF
            + " || '\" title=\"' || p_name || '\">' || p_name || "
            "'</a></h3><div class=\"product_price\"><p class=\"price_color\">£' || "
            "CAST(p_retailprice AS VARCHAR) || '</p></div></article>'")
LP_SQL = f"""lp AS (
  SELECT min(p_partkey) AS page_id,
         '{TB.SITE}/catalogue/category/books/' || lower(p_type) || '_' || CAST(g AS VARCHAR) || '/index.html' AS url,
         '<html><body><div class="page-header"><h1>' || p_type || '</h1></div><ol>'
           || string_agg(article, '' ORDER BY p_partkey)
           || '</ol><ul class="pager"><li class="next"><a href="page-2.html">next</a></li></ul></body></html>' AS html
  FROM (SELECT p_partkey, p_type, p_partkey // {TB.LISTING_PAGE_SIZE} AS g, {_ARTICLE} AS article FROM part) a
  GROUP BY p_type, g)"""
PP_SQL = f"""pp AS (
  SELECT '{TB.SITE}/catalogue/item-' || CAST(p_partkey AS VARCHAR) || '/index.html' AS url,
         '<html><body><div class="item active"><img src="../../media/full/' || CAST(p_partkey AS VARCHAR)
           || '.jpg" alt="cover"></div>'
           || CASE WHEN p_size % 7 = 0 THEN '' ELSE '<p class="instock availability"><i class="icon-ok"></i> In stock ('
              || CAST(p_size AS VARCHAR) || ' available)</p>' END || '</body></html>' AS html
  FROM part)"""


def _records_sql() -> str:
    # the oracle's own, simpler patterns: they know how the test pages are written
    a = "a"
    title_attr = S.first_match(a, '<h3><a href="[^"]*" title="([^"]+)"')
    title_text = S.node_text(S.first_match(a, '<h3><a[^>]*>([^<]*)</a>'))
    href = S.first_match(a, '<h3><a href="([^"]*)"')
    img = S.first_match(a, '<img src="([^"]*)"')
    return f"""arts AS (
  SELECT page_id, url, category, unnest(arr) AS a, unnest(generate_series(1, len(arr))) AS pos
  FROM (SELECT page_id, url, {S.node_text(S.first_match('html', '<h1>([^<]*)</h1>'))} AS category,
               string_split(html, '<article ')[2:] AS arr FROM lp) z),
recs AS (
  SELECT page_id, CAST(pos AS BIGINT) AS position,
         {S.decode_entities(f'coalesce({title_attr}, {title_text})')} AS title,
         {S.parse_price(S.node_text(S.first_match(a, 'class="price_color">([^<]*)<')))} AS price,
         CAST({S.rating_from_word(S.first_match(a, 'class="star-rating ([A-Za-z]+)"'))} AS BIGINT) AS rating,
         category,
         CASE WHEN nullif({img}, '') IS NOT NULL THEN {S.resolve_url('url', img)} END AS image,
         CASE WHEN nullif({href}, '') IS NOT NULL THEN {S.canonical_url('url', href)} END AS product_page
  FROM arts)"""


def _products_sql() -> str:
    block = S.first_match("html", '<p class="instock availability">(.*?)</p>')
    flag, stock = S.availability(S.node_text(block))
    img = S.first_match("html", '<div class="item active"><img src="([^"]*)"')
    return f"""prods AS (
  SELECT {S.drop_fragment('url')} AS purl,
         CASE WHEN {block} IS NULL THEN FALSE ELSE {flag} END AS in_stock,
         CASE WHEN {block} IS NULL THEN NULL ELSE {stock} END AS pstock,
         CASE WHEN nullif({img}, '') IS NOT NULL THEN {S.resolve_url('url', img)} END AS page_image
  FROM pp)"""


RECORDS_SQL = _records_sql()
PRODUCTS_SQL = _products_sql()
ENRICHED_SQL = """enr AS (
  SELECT r.page_id, r.position, r.title, r.price, r.rating, r.category, r.product_page,
         coalesce(p.page_image, r.image) AS image, coalesce(p.in_stock, FALSE) AS availability,
         CAST(p.pstock AS BIGINT) AS stock
  FROM recs r LEFT JOIN prods p ON r.product_page = p.purl)"""
WITH_RECS = f"WITH {LP_SQL},\n{RECORDS_SQL}\n"
WITH_ENR = f"WITH {LP_SQL},\n{PP_SQL},\n{RECORDS_SQL},\n{PRODUCTS_SQL},\n{ENRICHED_SQL}\n"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------------------------
# Spark building blocks
# ---------------------------------------------------------------------------------

def catalogue(spark, sf):
    return TB.catalogue_view(spark, sf)


def processed(spark, sf, with_id: bool = True):
    return E.cleaning_plan(catalogue(spark, sf), CFG, KEY, with_id=with_id)


def features(spark, sf, one_hot: bool = True, with_id: bool = True):
    return E.feature_plan(processed(spark, sf, with_id), CFG, vocabulary=None if one_hot else [])


def records(spark, sf):
    return X.extract_listing_records(TB.listing_pages(spark, sf))


def enriched(spark, sf):
    return X.enrich_from_pages(records(spark, sf), X.extract_product_fields(TB.product_pages(spark, sf)))


# =================================================================================
# 2.B  projections, predicates, features
# =================================================================================

@register("price_band", f"""SELECT event_id, value, {S.band('value', Bands.price())} AS price_range FROM events""")
def q_price_band(spark, sf):
    return FE.add_price_range(t(spark, sf, "events").select("event_id", "value"), "value")


@register("price_band_distribution", f"""SELECT {S.band('value', Bands.price())} AS value, count(*) AS count
FROM events GROUP BY 1""")
def q_price_band_distribution(spark, sf):
    return P.value_counts(FE.add_price_range(t(spark, sf, "events"), "value"), "price_range")


@register("title_features", f"""SELECT doc_id, {S.title_features('text')} FROM documents""")
def q_title_features(spark, sf):
    return t(spark, sf, "documents", spread_rows=True).select("doc_id", *TX.title_feature_columns("text"))


@register("title_pattern_counts", f"""SELECT
  count_if(regexp_matches(text, '[0-9]')) AS with_numbers,
  count_if(regexp_replace(text, '[\\p{{L}}\\p{{M}}\\p{{N}}_ \\r\\n\\t\\f\\v]', '', 'g') <> '') AS with_special,
  count_if(starts_with(text, 'The ')) AS starts_with_the,
  count_if(contains(text, ':')) AS with_colon,
  count_if(contains(text, '(')) AS with_paren
FROM documents""")
def q_title_pattern_counts(spark, sf):
    return P.title_pattern_counts(t(spark, sf, "documents", spread_rows=True), "text")


@register("rating_label", f"""SELECT o_orderkey,
  {S.rating_label('CAST(substr(o_orderpriority, 1, 1) AS INTEGER)')} AS rating_category FROM orders""")
def q_rating_label(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("r"))
    return FE.add_rating_category(o, "r").drop("r")


@register("stock_band", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {S.band('l_quantity', Bands.stock())} AS stock_level FROM lineitem""")
def q_stock_band(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return FE.add_stock_level(li, "l_quantity").drop("l_quantity")


@register("popularity_score", f"""{WITH_FEAT}SELECT id, popularity_score FROM feat0""")
def q_popularity_score(spark, sf):
    return FE.add_popularity_score(processed(spark, sf)).select("id", "popularity_score")


@register("one_hot", f"""SELECT p_partkey, {", ".join(
    f"CAST(CASE WHEN p_type = {S.q(v)} THEN 1 ELSE 0 END AS BIGINT) AS category_{v.lower()}"
    for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))} FROM part""")
def q_one_hot(spark, sf):
    return FE.add_one_hot(t(spark, sf, "part").select("p_partkey", "p_type"), "p_type").drop("p_type")


@register("one_hot_sums", _union([
    f"SELECT 'category_{v.lower()}' AS column, CAST(count_if(p_type = {S.q(v)}) AS BIGINT) AS total FROM part"
    for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]))
def q_one_hot_sums(spark, sf):
    return FE.one_hot_sums(FE.add_one_hot(t(spark, sf, "part").select("p_type"), "p_type"))


RV_COLS = ("c_acctbal AS price, c_nationkey AS rating, c_nationkey - 10 AS stock, "
           "c_nationkey % 3 AS availability")


@register("range_violations", f"""WITH c AS (SELECT {RV_COLS} FROM customer)
SELECT 'price_non_positive' AS rule, count_if(price <= 0) AS violations, count_if(price <= 0) = 0 AS passed FROM c
UNION ALL SELECT 'rating_outside_1_5', count_if(rating < 1 OR rating > 5), count_if(rating < 1 OR rating > 5) = 0 FROM c
UNION ALL SELECT 'stock_negative', count_if(stock < 0), count_if(stock < 0) = 0 FROM c
UNION ALL SELECT 'flag_not_0_1', count_if(availability NOT IN (0, 1)), count_if(availability NOT IN (0, 1)) = 0 FROM c""")
def q_range_violations(spark, sf):
    c = t(spark, sf, "customer").selectExpr(*[x.strip() for x in RV_COLS.split(",")])
    return Q.range_violations(c)


@register("zero_profile", _union([
    f"SELECT '{c}' AS column, count_if({c} = 0) AS zeros, round(count_if({c} = 0) * 100.0::DOUBLE / count(*), 6) AS percent FROM lineitem"
    for c in ("l_discount", "l_tax", "l_quantity")]))
def q_zero_profile(spark, sf):
    return Q.zero_profile(t(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_quantity"])


PH_EXPR = ("CASE c_nationkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN 'NULL' "
           "WHEN 4 THEN 'N/A' WHEN 5 THEN 'na' ELSE c_name END")
PH_EXPR2 = "CASE c_custkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE c_mktsegment END"


def _ph_frame(spark, sf):
    return t(spark, sf, "customer").select(
        "c_custkey", F.expr(PH_EXPR).alias("name_text"), F.expr(PH_EXPR2).alias("segment_text"))


@register("placeholder_profile", f"""WITH c AS (SELECT {PH_EXPR} AS name_text, {PH_EXPR2} AS segment_text FROM customer)
""" + _union([f"""SELECT '{c}' AS column, count_if({c} IS NULL) AS nulls, count_if({c} = '') AS empty,
  count_if({c} = '0') AS zero_text, count_if(lower({c}) = 'null') AS null_text,
  count_if(lower({c}) IN ('n/a', 'na')) AS na_text,
  count_if({c} IS NULL) + count_if({c} = '') + count_if({c} = '0') + count_if(lower({c}) = 'null')
    + count_if(lower({c}) IN ('n/a', 'na')) AS total,
  round((count_if({c} IS NULL) + count_if({c} = '') + count_if({c} = '0') + count_if(lower({c}) = 'null')
    + count_if(lower({c}) IN ('n/a', 'na'))) * 100.0::DOUBLE / count(*), 6) AS percent FROM c"""
                   for c in ("name_text", "segment_text")]))
def q_placeholder_profile(spark, sf):
    return Q.placeholder_profile(_ph_frame(spark, sf), ["name_text", "segment_text"])


@register("placeholder_examples", f"""SELECT c_custkey, name_text FROM (SELECT c_custkey, {PH_EXPR} AS name_text FROM customer)
WHERE name_text IS NULL OR name_text = '' OR name_text = '0' OR lower(name_text) IN ('null', 'n/a', 'na')
ORDER BY c_custkey LIMIT 3""")
def q_placeholder_examples(spark, sf):
    return Q.placeholder_examples(_ph_frame(spark, sf), "name_text", ["c_custkey", "name_text"], ["c_custkey"], 3)


@register("keyword_screen", """SELECT doc_id, lang FROM documents
WHERE contains(lower(text), 'license') OR contains(lower(text), 'copyright')""")
def q_keyword_screen(spark, sf):
    return P.keyword_screen(t(spark, sf, "documents"), "text", ("license", "copyright")).select("doc_id", "lang")


@register("url_checks", f"""{WITH_RECS}SELECT count_if(contains(image, '/media/')) AS media_urls,
  count_if(NOT regexp_matches(image, {S.q(P.IMAGE_EXTENSION_RE)})) AS no_image_extension,
  count(DISTINCT image) AS distinct_images, count(DISTINCT product_page) AS distinct_pages FROM recs""")
def q_url_checks(spark, sf):
    return P.url_checks(records(spark, sf), "image", "product_page")


B64_IMAGE = "CASE WHEN doc_id % 2 = 0 THEN text ELSE 'http://img.example.com/' || CAST(doc_id AS STRING) || '.png' END"


@register("base64_passthrough", f"""SELECT doc_id,
  CASE WHEN length(b64) > {BASE64_MIN_LENGTH} THEN b64
       WHEN length(image) > 200 AND regexp_matches(image, '^[A-Za-z0-9+/=]+$') THEN image
       ELSE '' END AS image_base64
FROM (SELECT doc_id, {B64_IMAGE} AS image,
             CASE WHEN doc_id % 3 = 0 THEN to_base64(encode(text)) ELSE '' END AS b64 FROM documents)""")
def q_base64_passthrough(spark, sf):
    d = t(spark, sf, "documents").select(
        "doc_id", F.expr(B64_IMAGE).alias("image"),
        F.when(F.col("doc_id") % 3 == 0, TX.base64_text(F.encode("text", "UTF-8"))).otherwise(F.lit("")).alias("b64"))
    return X.base64_passthrough(d, "image", "b64").select("doc_id", "image_base64")


# =================================================================================
# 2.B / 2.M  cleaning
# =================================================================================

SID_SQL = f"""WITH k AS (SELECT *, {S.key_digest(['text'])} AS _k FROM documents),
c AS (SELECT _k, count(*) AS n FROM k GROUP BY _k),
u AS (SELECT 'doc_' || k._k AS id, doc_id, lang FROM k JOIN c USING (_k) WHERE c.n = 1),
d AS (SELECT k._k, doc_id, text, lang, source, n_chars, count(*) AS cnt FROM k JOIN c USING (_k)
      WHERE c.n > 1 GROUP BY ALL)
SELECT id, doc_id, lang FROM u
UNION ALL
SELECT 'doc_' || _k || '_' || {S.key_digest(['doc_id', 'text', 'lang', 'source', 'n_chars'])}
       || '_' || CAST(i AS VARCHAR) AS id, doc_id, lang
FROM (SELECT *, unnest(generate_series(1, cnt)) AS i FROM d)"""


@register("surrogate_id", SID_SQL)
def q_surrogate_id(spark, sf):
    d = t(spark, sf, "documents")
    return C.add_surrogate_id(d, ["text"], prefix="doc_").select("id", "doc_id", "lang")


@register("category_replace", """SELECT p_partkey,
  CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN 'Outros' ELSE p_type END AS category FROM part""")
def q_category_replace(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.col("p_type").alias("category"))
    return C.replace_categories(p, "category", TB.CATALOGUE_PROBLEMATIC, "Outros")


@register("category_problem_counts", """SELECT p_type AS value, count(*) AS count FROM part
WHERE p_type IN ('PROMO', 'STANDARD') GROUP BY p_type""")
def q_category_problem_counts(spark, sf):
    return C.category_problem_counts(t(spark, sf, "part"), "p_type", TB.CATALOGUE_PROBLEMATIC)


FLAG_TEXT = "CASE l_returnflag WHEN 'N' THEN 'yes' WHEN 'R' THEN 'YES' ELSE 'no' END"


@register("flag_encode", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CASE WHEN lower({FLAG_TEXT}) = 'yes' THEN 1 ELSE 0 END AS BIGINT) AS availability FROM lineitem""")
def q_flag_encode(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         F.expr(FLAG_TEXT).alias("availability"))
    return C.encode_flag(li, "availability")


@register("flag_counts", f"""SELECT CAST(CASE WHEN lower({FLAG_TEXT}) = 'yes' THEN 1 ELSE 0 END AS BIGINT) AS value,
  count(*) AS count FROM lineitem GROUP BY 1""")
def q_flag_counts(spark, sf):
    li = t(spark, sf, "lineitem").select(F.expr(FLAG_TEXT).alias("availability"))
    return C.flag_counts(C.encode_flag(li, "availability"))


@register("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def q_dedup_rows(spark, sf):
    return C.dedup_rows(t(spark, sf, "documents").select("text", "lang"))


@register("duplicates_report", """SELECT p_name, p_type, count(*) AS copies FROM part
GROUP BY p_name, p_type HAVING count(*) > 1""")
def q_duplicates_report(spark, sf):
    return C.duplicates_report(t(spark, sf, "part").select("p_name", "p_type"))


@register("normalize_text", f"""SELECT doc_id, {S.normalize_text('text')} AS text FROM documents""")
def q_normalize_text(spark, sf):
    return C.normalize_columns(t(spark, sf, "documents", spread_rows=True).select("doc_id", "text"), ["text"])


LOCALE_TEXT = ("CASE l_linenumber % 3 WHEN 0 THEN 'R$ ' || replace(CAST(l_extendedprice AS STRING), '.', ',') "
               "WHEN 1 THEN CAST(l_extendedprice AS STRING) ELSE 'US$ ' || CAST(l_extendedprice AS STRING) END")


@register("parse_price_locale", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price_text,
  {S.parse_price_locale('price_text')} AS price FROM (SELECT *, {LOCALE_TEXT} AS price_text FROM lineitem)""")
def q_parse_price_locale(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         F.expr(LOCALE_TEXT).alias("price_text"))
    return li.withColumn("price", TX.parse_price_locale("price_text"))


# =================================================================================
# 2.D / 2.E / 2.F / 2.G  aggregations, windows, top-k, sets
# =================================================================================

@register("null_profile", f"""WITH c AS (SELECT c_custkey, {PH_EXPR} AS name_text, {PH_EXPR2} AS segment_text FROM customer)
""" + _union([f"SELECT '{c}' AS column, count_if({c} IS NULL) AS nulls FROM c"
              for c in ("c_custkey", "name_text", "segment_text")]))
def q_null_profile(spark, sf):
    return Q.null_counts(_ph_frame(spark, sf))


@register("value_counts", "SELECT p_type AS value, count(*) AS count FROM part GROUP BY p_type")
def q_value_counts(spark, sf):
    return P.value_counts(t(spark, sf, "part"), "p_type")


@register("value_counts_by_value", """SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS value, count(*) AS count
FROM orders GROUP BY 1""")
def q_value_counts_by_value(spark, sf):
    o = t(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"))
    return P.value_counts(o, "rating", by="value")


@register("value_share", """SELECT c_mktsegment AS value, count(*) AS count,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent FROM customer GROUP BY c_mktsegment""")
def q_value_share(spark, sf):
    return P.value_share(t(spark, sf, "customer"), "c_mktsegment")


PART_COLS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@register("distinct_counts", _union([
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS \"distinct\" FROM part"
    for c in PART_COLS]))
def q_distinct_counts(spark, sf):
    return P.distinct_counts(t(spark, sf, "part"), list(PART_COLS))


NUM_COLS = ("l_extendedprice", "l_quantity", "l_discount")


@register("numeric_summary", _union([
    f"""SELECT '{c}' AS column, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS median, round(stddev_samp({c}), 6) AS std
FROM lineitem""" for c in NUM_COLS]))
def q_numeric_summary(spark, sf):
    return P.numeric_summary(t(spark, sf, "lineitem"), list(NUM_COLS))


DESC_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("describe", _union([
    f"""SELECT '{c}' AS column, count({c}) AS count, count_if({c} IS NULL) AS null_count,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in DESC_COLS]))
def q_describe(spark, sf):
    return P.describe(t(spark, sf, "lineitem"), list(DESC_COLS))


# longs that no double tells apart from their neighbours
BIG_KEY = "l_orderkey * 4 + l_linenumber + 9007199254740993"


def _rank(p: float) -> str:
    return f"list_sort(list({BIG_KEY}))[CAST(floor((count(*) - 1) * CAST({p} AS DOUBLE) + 0.5) AS BIGINT) + 1]"


@register("integer_quartiles", f"""SELECT 'key' AS column, count(*) AS count, min({BIG_KEY}) AS min, {_rank(0.25)} AS q25,
  {_rank(0.5)} AS q50, {_rank(0.75)} AS q75, max({BIG_KEY}) AS max FROM lineitem""")
def q_integer_quartiles(spark, sf):
    keys = t(spark, sf, "lineitem").select(F.expr(BIG_KEY).alias("key"))
    return P.describe(keys, ["key"], interpolation="nearest").select("column", "count", "min", "q25", "q50", "q75", "max")


IQR_FENCES = """f AS (SELECT quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lo,
                 quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi
          FROM events)"""


@register("iqr_outliers", f"""WITH {IQR_FENCES}
SELECT event_id, value FROM events, f WHERE value < f.lo OR value > f.hi""")
def q_iqr_outliers(spark, sf):
    return FE.iqr_outliers(t(spark, sf, "events").select("event_id", "value"), "value")


@register("iqr_filter", f"""WITH {IQR_FENCES}
SELECT event_id, value FROM events, f WHERE NOT (value < f.lo OR value > f.hi)""")
def q_iqr_filter(spark, sf):
    return FE.iqr_filter(t(spark, sf, "events").select("event_id", "value"), ["value"])


CORR_COLS = ("price", "rating", "stock", "title_length", "title_word_count", "availability",
             "popularity_score", "has_subtitle", "has_series", "starts_with_the", "has_numbers")


def _corr_sql(a: str, b: str) -> str:
    """DuckDB's own corr over the rows with both values."""
    x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    both = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return (f"CASE WHEN min({x}) {both} = max({x}) {both} OR min({y}) {both} = max({y}) {both} THEN NULL "
            f"ELSE round(corr({x}, {y}), 6) END")


# nulls in both columns of many pairs
NULLED = {"price": "CASE WHEN stock % 7 = 0 THEN NULL ELSE price END",
          "rating": "CASE WHEN title_length % 5 = 0 THEN NULL ELSE rating END",
          "popularity_score": "CASE WHEN stock % 11 = 3 THEN NULL ELSE popularity_score END"}
FEAT_NULLED_SQL = "nulled AS (SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in NULLED.items()) + ") FROM feat0)"
WITH_NULLED = WITH_FEAT.rstrip() + ",\n" + FEAT_NULLED_SQL + "\n"


def _with_nulls(df):
    return df.select(*[F.expr(NULLED[c]).alias(c) if c in NULLED else F.col(c) for c in df.columns])


def _feat_numeric(spark, sf):
    df = _with_nulls(features(spark, sf, one_hot=False, with_id=False))
    return df.select(*[F.col(c).cast("int").alias(c) if c.startswith(("has_", "starts_with_")) else F.col(c)
                       for c in P.numeric_feature_columns(df, CORR_COLS[:7])])


@register("correlation_matrix", WITH_NULLED + "SELECT * FROM (" + _union([
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_corr_sql(a, b)} AS corr FROM nulled"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]) + ")")
def q_correlation_matrix(spark, sf):
    df = _feat_numeric(spark, sf)
    return P.correlation_matrix(df, list(df.columns))


@register("target_correlations", WITH_NULLED + "SELECT * FROM (" + _union([
    f"SELECT '{c}' AS column, 'price' AS target, {_corr_sql(c, 'price')} AS corr FROM nulled"
    for c in CORR_COLS if c != "price"]) + ")")
def q_target_correlations(spark, sf):
    df = _feat_numeric(spark, sf)
    return P.target_correlations(df, "price", [c for c in df.columns if c != "price"])


@register("feature_selection", WITH_NULLED + "SELECT *, coalesce(abs(corr) >= 0.1, FALSE) AS selected FROM (" + _union([
    f"SELECT '{c}' AS column, {_corr_sql(c, 'popularity_score')} AS corr FROM nulled"
    for c in ("price", "rating", "stock", "title_length", "title_word_count", "availability")]) + ")")
def q_feature_selection(spark, sf):
    df = _with_nulls(features(spark, sf, one_hot=False, with_id=False))
    return FE.selection_report(df, "popularity_score",
                               ["price", "rating", "stock", "title_length", "title_word_count", "availability"],
                               0.1)


@register("title_stats", f"""{WITH_FEAT}SELECT count_if(has_subtitle) AS has_subtitle, count_if(has_series) AS has_series,
  count_if(starts_with_the) AS starts_with_the, count_if(has_numbers) AS has_numbers,
  round(avg(title_length), 6) AS avg_title_length, round(avg(title_word_count), 6) AS avg_word_count FROM feat0""")
def q_title_stats(spark, sf):
    return P.title_stats(features(spark, sf, one_hot=False, with_id=False))


@register("text_length_stats", _union([
    f"""SELECT '{c}' AS column, CAST(min(length({c})) AS BIGINT) AS min_length, CAST(max(length({c})) AS BIGINT) AS max_length,
  round(avg(length({c})), 6) AS mean_length FROM documents""" for c in ("text", "lang", "source")]))
def q_text_length_stats(spark, sf):
    return P.text_length_stats(t(spark, sf, "documents"), ["text", "lang", "source"])


def _hist_sql(expr: str, bins: int) -> str:
    return f"""WITH v AS (SELECT CAST({expr} AS DOUBLE) AS x FROM documents),
m AS (SELECT min(x) AS mn, max(x) AS mx FROM v)
SELECT g.bin, round(mn + g.bin * ((mx - mn) / {bins}), 6) AS lower, round(mn + (g.bin + 1) * ((mx - mn) / {bins}), 6) AS upper,
       coalesce(count, 0) AS count
FROM m CROSS JOIN (SELECT unnest(range({bins})) AS bin) g LEFT JOIN
     (SELECT CAST(CASE WHEN mx - mn = 0 THEN 0 ELSE least(floor((x - mn) / (mx - mn) * {bins}), {bins - 1}) END AS BIGINT) AS bin,
             count(*) AS count
      FROM v, m WHERE x IS NOT NULL GROUP BY 1) h ON g.bin = h.bin WHERE mn IS NOT NULL"""


@register("histogram", _hist_sql("length(text)", TITLE_LENGTH_BINS))
def q_histogram(spark, sf):
    d = t(spark, sf, "documents").select(F.char_length("text").alias("title_length"))
    return P.histogram(d, "title_length", TITLE_LENGTH_BINS)


@register("histogram_words", _hist_sql(S.word_count("text"), TITLE_WORD_BINS))
def q_histogram_words(spark, sf):
    d = t(spark, sf, "documents").select(TX.word_count("text").alias("title_word_count"))
    return P.histogram(d, "title_word_count", TITLE_WORD_BINS)


MERGED_COLS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@register("merged_profile", _union([f"""SELECT '{c}' AS column, count({c}) AS count, count_if({c} IS NULL) AS nulls, TRUE AS distinct_near,
  {f"CAST(CAST(min({c}) AS DOUBLE) AS VARCHAR)" if c != "o_orderpriority" else f"min({c})"} AS min,
  {f"round(avg({c}), 4)" if c != "o_orderpriority" else "CAST(NULL AS DOUBLE)"} AS mean,
  {f"round(stddev_samp({c}), 4)" if c != "o_orderpriority" else "CAST(NULL AS DOUBLE)"} AS std
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice, o_orderpriority FROM orders)""" for c in MERGED_COLS]))
def q_merged_profile(spark, sf):
    """Profile of a table from the stored states of its four parts; the distinct counts
    of the sketches are held against exact ones."""
    orders = t(spark, sf, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END").alias("o_custkey"),
                                           "o_totalprice", "o_orderpriority")
    path = staging_path(spark, f"states-{uuid.uuid4().hex}")
    for i in range(4):
        SK.profile_states(orders.where(F.col("o_orderkey") % 4 == i), f"part{i}").write.mode("append").parquet(path)
    merged = SK.merged_profile(spark.read.schema(SK.STATE).parquet(path))
    exact = P.distinct_counts(orders).select(F.col("column").alias("_c"), F.col("distinct").alias("_exact"))
    near = F.abs(F.col("distinct") - F.col("_exact")) <= 0.05 * F.col("_exact")
    return (merged.join(exact, F.col("column") == F.col("_c"))
            .select("column", "count", "nulls", near.alias("distinct_near"), "min", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std")))


@register("duplicate_rows_title", """SELECT doc_id, lang FROM documents
WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""")
def q_duplicate_rows_title(spark, sf):
    return P.duplicate_rows(t(spark, sf, "documents"), "text").select("doc_id", "lang")


# whole URLs that repeat: what a link of the page leads to ('../up.html' and the like)
LINK_EXPR = "CASE page_id % 4 WHEN 0 THEN '/sitemap.html' WHEN 1 THEN '../../../../up.html#top' WHEN 2 THEN 'https://other.example.org/p?id=' || CAST(page_id % 50 AS STRING) ELSE '' END"


@register("duplicate_rows_url", f"""WITH r AS (SELECT page_id, {S.canonical_url('url', 'href')} AS link
  FROM (SELECT page_id, url, {LINK_EXPR} AS href FROM pages))
SELECT page_id, link FROM r WHERE link IN (SELECT link FROM r GROUP BY 1 HAVING count(*) > 1)""")
def q_duplicate_rows_url(spark, sf):
    p = t(spark, sf, "pages").select("page_id", "url", F.expr(LINK_EXPR).alias("href"))
    return P.duplicate_rows(U.with_resolved_url(p, "url", "href", "link", canonical=True).select("page_id", "link"), "link")


@register("top_k", """SELECT p_brand AS value, count(*) AS count FROM part GROUP BY p_brand
ORDER BY count DESC, value ASC LIMIT 10""")
def q_top_k(spark, sf):
    return P.top_k(t(spark, sf, "part"), "p_brand", 10)


@register("ranked_page", """SELECT p_brand AS value, count(*) AS count FROM part GROUP BY p_brand
ORDER BY count DESC, value ASC LIMIT 10 OFFSET 10""")
def q_ranked_page(spark, sf):
    return P.ranked_page(t(spark, sf, "part"), "p_brand", 10, 10)


@register("bottom_k", """SELECT p_brand AS value, count(*) AS count FROM part GROUP BY p_brand
ORDER BY count ASC, value DESC LIMIT 10""")
def q_bottom_k(spark, sf):
    return P.bottom_k(t(spark, sf, "part"), "p_brand", 10)


@register("extreme_by_length", """SELECT * FROM (SELECT 'longest' AS which, text AS value, CAST(length(text) AS BIGINT) AS length
  FROM documents ORDER BY length(text) DESC, text DESC LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'shortest', text, CAST(length(text) AS BIGINT) FROM documents
  ORDER BY length(text) ASC, text ASC LIMIT 1)""")
def q_extreme_by_length(spark, sf):
    return P.extreme_by_length(t(spark, sf, "documents"), "text")


@register("limit_first_n", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5")
def q_limit_first_n(spark, sf):
    return P.limit_first_n(t(spark, sf, "part").select("p_partkey", "p_name"), ["p_partkey"], 5)


@register("union_all", """SELECT p_name AS title, p_type AS category FROM part
UNION ALL SELECT c_name, c_mktsegment FROM customer""")
def q_union_all(spark, sf):
    return P.union_all([
        t(spark, sf, "part").select(F.col("p_name").alias("title"), F.col("p_type").alias("category")),
        t(spark, sf, "customer").select(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("category"))])


@register("distinct_sorted", "SELECT DISTINCT event_type AS value FROM events ORDER BY value")
def q_distinct_sorted(spark, sf):
    return P.distinct_sorted(t(spark, sf, "events"), "event_type")


@register("table_profile", _union([
    f"""SELECT '{c}' AS column, '{dt}' AS dtype, count({c}) AS count, count_if({c} IS NULL) AS nulls,
  CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS "distinct",
  CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
  {f"round(avg({c}), 6)" if num else "CAST(NULL AS DOUBLE)"} AS mean,
  {f"round(stddev_samp({c}), 6)" if num else "CAST(NULL AS DOUBLE)"} AS std FROM part"""
    for c, dt, num in (("p_partkey", "bigint", True), ("p_name", "string", False), ("p_brand", "string", False),
                       ("p_type", "string", False), ("p_size", "int", True), ("p_retailprice", "double", True))]))
def q_table_profile(spark, sf):
    return P.table_profile(t(spark, sf, "part"))


@register("stage_comparison", f"""{WITH_FEAT}SELECT 'raw' AS stage, count(*) AS rows, CAST(13 AS BIGINT) AS columns FROM cat
UNION ALL SELECT 'processed', count(*), CAST(10 AS BIGINT) FROM proc
UNION ALL SELECT 'features', count(*), CAST({20 + len(CAT_VOCAB)} AS BIGINT) FROM feat""")
def q_stage_comparison(spark, sf):
    raw, _ = stage_table(catalogue(spark, sf), "raw")       # the join runs once
    proc = E.cleaning_plan(raw, CFG, KEY, with_id=False)
    return P.stage_comparison([("raw", raw), ("processed", proc), ("features", E.feature_plan(proc, CFG))])


# =================================================================================
# 2.H  scalar functions
# =================================================================================

PRICE_TEXT = ("CASE p_size % 6 WHEN 4 THEN CAST(p_size AS STRING) || 'd' WHEN 0 THEN '£' || CAST(p_retailprice AS STRING) "
              "WHEN 1 THEN 'Â£' || CAST(p_retailprice AS STRING) "
              "WHEN 2 THEN ' ' || CAST(p_retailprice AS STRING) || ' ' ELSE 'n/a' END")


@register("parse_price", f"""SELECT p_partkey, price_text, {S.parse_price('price_text')} AS price
FROM (SELECT p_partkey, {PRICE_TEXT} AS price_text FROM part)""")
def q_parse_price(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.expr(PRICE_TEXT).alias("price_text"))
    return p.withColumn("price", TX.parse_price("price_text"))


RATING_TAG = ("'<p class=\"star-rating ' || CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'One' "
              "WHEN '2' THEN 'Two' WHEN '3' THEN 'Three' WHEN '4' THEN 'Four' ELSE 'Zero' END || '\"></p>'")
# the same classes the other way round
RATING_TAG = f"CASE WHEN o_orderkey % 3 = 0 THEN replace(replace({RATING_TAG}, 'star-rating Three', 'Three star-rating'), 'star-rating One', 'big One star-rating') ELSE {RATING_TAG} END"


@register("parse_rating_word", f"""SELECT o_orderkey, CAST(CASE WHEN contains(tag, 'One') THEN 1 WHEN contains(tag, 'Two') THEN 2
  WHEN contains(tag, 'Three') THEN 3 WHEN contains(tag, 'Four') THEN 4 END AS BIGINT) AS rating
FROM (SELECT o_orderkey, {RATING_TAG} AS tag FROM orders)""")
def q_parse_rating_word(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", M.tokens(F.expr(RATING_TAG)).alias("tok")).select("*", M.elements("tok").alias("el"))
    return o.select("o_orderkey", TX.rating_from_word(X.rating_word(F.col("tok"), F.col("el"))).alias("rating"))


AVAIL_TEXT = ("CASE p_size % 4 WHEN 0 THEN 'In stock (' || CAST(p_size AS STRING) || ' available)' "
              "WHEN 1 THEN 'In stock' WHEN 2 THEN CAST(p_size AS STRING) || ' left' ELSE '' END")
_AV_FLAG, _AV_STOCK = S.availability("avail_text")


@register("parse_availability", f"""SELECT p_partkey, {_AV_FLAG} AS in_stock, {_AV_STOCK} AS stock
FROM (SELECT p_partkey, {AVAIL_TEXT} AS avail_text FROM part)""")
def q_parse_availability(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.expr(AVAIL_TEXT).alias("avail_text"))
    a = TX.parse_availability("avail_text")
    return p.select("p_partkey", a["in_stock"].alias("in_stock"), a["stock"].alias("stock"))


@register("slug", f"""SELECT doc_id, {S.slug('text')} AS slug FROM documents""")
def q_slug(spark, sf):
    return t(spark, sf, "documents", spread_rows=True).select("doc_id", TX.slug("text").alias("slug"))


@register("url_extension", f"""SELECT page_id, {S.url_extension('url')} AS extension FROM pages""")
def q_url_extension(spark, sf):
    return t(spark, sf, "pages").select("page_id", U.url_extension("url").alias("extension"))


@register("extension_by_content_type", """SELECT page_id, CASE page_id % 8 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' WHEN 2 THEN '.gif'
  WHEN 3 THEN '.webp' WHEN 4 THEN '.svg' WHEN 5 THEN '.tar' ELSE '.jpg' END AS extension FROM pages""")
def q_extension_by_content_type(spark, sf):
    """The address of each page without its suffix, and what a server might have sent with it."""
    kind = F.get(F.array(*map(F.lit, ["image/png", "IMAGE/JPEG; charset=x", " image/gif ;q=1", "image/webp", "image/svg+xml", "image/png", "text/unknown", ""])),
                 (F.col("page_id") % 8).cast("int"))
    bare = F.concat(F.regexp_extract("url", "^([a-z]+://[^/]+)", 1), F.lit("/a.b/c"), F.when(F.col("page_id") % 8 == 5, F.lit(".TAR")).otherwise(F.lit("")), F.lit("?x=1.gif#y.png"))
    pages = t(spark, sf, "pages").select("page_id", bare.alias("url"), kind.alias("kind"))
    return pages.select("page_id", U.url_extension("url", "kind").alias("extension"))


@register("url_sha1", "SELECT page_id, sha1(url) AS url_key FROM pages")
def q_url_sha1(spark, sf):
    return t(spark, sf, "pages").select("page_id", U.url_sha1("url").alias("url_key"))


# relative references of several shapes, derived per page
HREF_EXPR = ("CASE page_id % 8 WHEN 0 THEN '../a/./b.html#frag' WHEN 1 THEN '//cdn.example.com/x.png' "
             "WHEN 2 THEN '?q=' || CAST(page_id AS STRING) WHEN 3 THEN 'sub/../c.html' "
             "WHEN 4 THEN '/root/../d/e/../f.html' WHEN 5 THEN '../../../../up.html' "
             "WHEN 6 THEN 'https://other.example.org/p?id=' || CAST(page_id AS STRING) ELSE '#top' END")


@register("canonical_url", f"""SELECT page_id, href, {S.canonical_url('url', 'href')} AS resolved
FROM (SELECT page_id, url, {HREF_EXPR} AS href FROM pages)""")
def q_canonical_url(spark, sf):
    p = t(spark, sf, "pages", spread_rows=True).select("page_id", "url", F.expr(HREF_EXPR).alias("href"))
    return U.with_resolved_url(p, "url", "href", "resolved", canonical=True).select("page_id", "href", "resolved")


# Texts and what they must become, written out; {k} is the part's key.  One row a case:
# slug in, out; price in, out; availability in, flag, stock; link in, resolved link.
LITERALS = (
    ("  Hello,  World {k}! ", "hello-world-{k}", "R$ {k},99", "{k}.99", "In stock ({k} available)", "TRUE", "{k}", "x{k}.html", "http://h.example.com/a/b/x{k}.html"),
    ("A--B__C {k}", "a-b__c-{k}", "1.234,5", "1234.5", "Out of stock", "FALSE", None, "../{k}", "http://h.example.com/a/{k}"),
    ("{k}", "{k}", "12.50", "12.5", "in STOCK", "TRUE", None, "/r/../s/./{k}#z", "http://h.example.com/s/{k}"),
    ("", "unknown", "free", None, "{k} left", "FALSE", "{k}", "https://o.example.org/{k}", "https://o.example.org/{k}"),
    ("!!{k}!!", "{k}", "1,234.56", "1234.56", "", "FALSE", None, "?p={k}", "http://h.example.com/a/b/c.html?p={k}"),
    ("\u00dcn\u00ef c\u00f6d\u00e9 {k}", "\u00fcn\u00ef-c\u00f6d\u00e9-{k}", "-{k}", "-{k}", "Only (7 available)", "TRUE", "7", "//n.example.org/{k}", "http://n.example.org/{k}"),
)


def _literal(column: int, kind: str | None = None) -> str:
    """SQL of a column of LITERALS, by the part's key."""
    def value(text):
        return "NULL" if text is None else S.q(text).replace("{k}", "' || p_partkey || '")
    cases = " ".join(f"WHEN {i} THEN {value(row[column])}" for i, row in enumerate(LITERALS))
    text = f"CASE p_partkey % {len(LITERALS)} {cases} END"
    return f"CAST({text} AS {kind})" if kind else text


@register("text_literals", f"""SELECT p_partkey, {_literal(1)} AS slug, {_literal(3, "DOUBLE")} AS price, {_literal(5, "BOOLEAN")} AS in_stock,
  {_literal(6, "BIGINT")} AS stock, {_literal(8)} AS link, 'a9993e364706816aba3e25717850c26c9cd0d89d' AS sha1_of_abc FROM part""")
def q_text_literals(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", *(F.expr(_literal(i)).alias(n) for i, n in ((0, "_slug"), (2, "_price"), (4, "_stock"), (7, "_href"))),
                                    F.lit("http://h.example.com/a/b/c.html?q=1#f").alias("_base"))
    found = p.select("p_partkey", "_base", "_href", TX.slug("_slug").alias("slug"), TX.parse_price_locale("_price").alias("price"),
                     TX.parse_availability(F.col("_stock")).alias("_a"), U.url_sha1(F.lit("abc")).alias("sha1_of_abc"))
    return (U.with_resolved_url(found, "_base", "_href", "link", canonical=True)
            .select("p_partkey", "slug", "price", F.col("_a.in_stock").alias("in_stock"), F.col("_a.stock").alias("stock"), "link", "sha1_of_abc"))


# =================================================================================
# 2.A / 2.C  sources, extraction, joins
# =================================================================================

def _links_sql() -> str:
    nav = "array_to_string(regexp_extract_all(html, '(?s)<nav>(.*?)</nav>', 1), ' ')"
    link = S.q('<a href="([^"]*)">([^<]*)</a>')
    return f"""WITH z AS (SELECT page_id, url, regexp_extract_all({nav}, {link}, 1) AS hrefs,
                  regexp_extract_all({nav}, {link}, 2) AS names FROM pages),
e AS (SELECT page_id, url, unnest(hrefs) AS href, unnest(names) AS name,
             unnest(generate_series(1, len(hrefs))) AS pos FROM z)
SELECT page_id, CAST(pos AS BIGINT) AS position, {S.node_text('name')} AS name, href,
       {S.canonical_url('url', 'href')} AS link_url FROM e WHERE href <> ''"""


@register("extract_links", _links_sql())
def q_extract_links(spark, sf):
    return X.extract_links(t(spark, sf, "pages", spread_rows=True))


@register("extract_page_fields", f"""SELECT page_id, {S.drop_fragment('url')} AS canonical_url,
  {S.node_text(S.first_match('html', '(?s)<title>(.*?)</title>'))} AS title,
  {S.node_text(S.first_match('html', '(?s)<h1>(.*?)</h1>'))} AS heading,
  {S.first_match('html', '<html lang="([^"]*)"')} AS lang,
  CAST(len(regexp_extract_all(html, '<a href="')) AS BIGINT) AS n_links,
  CAST(length({S.page_text('html')}) AS BIGINT) AS text_length FROM pages""")
def q_extract_page_fields(spark, sf):
    return X.extract_page_fields(t(spark, sf, "pages", spread_rows=True))


@register("next_page_links", f"""WITH {LP_SQL}
SELECT page_id, CASE WHEN {S.first_match('html', '<li class="next"><a href="([^"]*)"')} IS NOT NULL
  THEN {S.resolve_url('url', S.first_match('html', '<li class="next"><a href="([^"]*)"'))} END AS next_url FROM lp""")
def q_next_page_links(spark, sf):
    return X.extract_next_url(TB.listing_pages(spark, sf))


@register("extract_records", f"{WITH_RECS}SELECT * FROM recs")
def q_extract_records(spark, sf):
    return records(spark, sf)


@register("enrich_from_pages", f"{WITH_ENR}SELECT * FROM enr")
def q_enrich_from_pages(spark, sf):
    return enriched(spark, sf)


# Pages that people wrote in six ways (tables.HANDWRITTEN).  Their oracles read no page: they
# say what the part behind it must give.
_HAND = f"'{TB.SITE}/hand/' || "


@register("handwritten_records", f"""SELECT p_partkey AS page_id, CAST(1 AS BIGINT) AS position, p_name AS title, p_retailprice AS price,
  CAST(p_size % 5 + 1 AS BIGINT) AS rating, p_type AS category, {_HAND}lower(p_type) || '/cache/' || p_partkey || '.jpg' AS image,
  {_HAND}'item-' || p_partkey || '/i.html' || CASE WHEN p_partkey % 6 = 5 THEN '?' ELSE '' END AS product_page FROM part""")
def q_handwritten_records(spark, sf):
    return X.extract_listing_records(TB.handwritten_pages(spark, sf))


@register("sidebar_categories", f"""SELECT p_partkey AS page_id, CAST(1 AS BIGINT) AS position, p_type AS name, '../' || p_type || '_' || p_size || '/index.html' AS href,
  {_HAND}p_type || '_' || p_size || '/index.html' AS link_url FROM part""")
def q_sidebar_categories(spark, sf):
    return X.extract_links(TB.handwritten_pages(spark, sf), path=X.SIDEBAR_LINKS)


@register("handwritten_next_links", f"SELECT p_partkey AS page_id, {_HAND}lower(p_type) || '/page-' || p_size || '.html' AS next_url FROM part")
def q_handwritten_next_links(spark, sf):
    return X.extract_next_url(TB.handwritten_pages(spark, sf))


@register("handwritten_products", f"""SELECT {_HAND}lower(p_type) || '/index.html' AS url, TRUE AS in_stock, CAST(p_size AS BIGINT) AS stock,
  {_HAND}lower(p_type) || '/full/' || p_partkey || '.png' AS page_image FROM part""")
def q_handwritten_products(spark, sf):
    return X.extract_product_fields(TB.handwritten_pages(spark, sf))


@register("handwritten_fields", """SELECT p_partkey AS page_id, p_type || ' books' AS title, p_type AS heading, 'en' AS lang,
  CAST(CASE p_partkey % 6 WHEN 0 THEN 5 WHEN 3 THEN 3 WHEN 4 THEN 5 WHEN 5 THEN 3 ELSE 4 END AS BIGINT) AS n_links FROM part""")
def q_handwritten_fields(spark, sf):
    return X.extract_page_fields(TB.handwritten_pages(spark, sf)).select("page_id", "title", "heading", "lang", "n_links")


@register("extract_summary", f"""{WITH_RECS}SELECT count(DISTINCT category) AS categories, count(*) AS records FROM recs""")
def q_extract_summary(spark, sf):
    return X.extract_summary(records(spark, sf))


@register("export_encode", f"""{WITH_ENR}SELECT coalesce(title, '') AS title, coalesce(CAST(price AS VARCHAR), '') AS price,
  coalesce(CAST(rating AS VARCHAR), '') AS rating, coalesce(category, '') AS category, coalesce(image, '') AS image,
  coalesce(product_page, '') AS product_page,
  CASE WHEN availability THEN 'yes' WHEN NOT availability THEN 'no' ELSE '' END AS availability,
  coalesce(CAST(stock AS VARCHAR), '') AS stock, '' AS image_base64 FROM enr""")
def q_export_encode(spark, sf):
    return csv_io.export_encode(enriched(spark, sf).withColumn("image_base64", F.lit(None).cast("string")))


@register("export_missing_counts", f"""{WITH_ENR}SELECT count_if(availability IS NULL) AS missing_availability,
  count_if(stock IS NULL) AS missing_stock, count(*) AS rows FROM enr""")
def q_export_missing_counts(spark, sf):
    return csv_io.export_missing_counts(enriched(spark, sf))


ROUND_TRIP_SQL = """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE text END AS text,
  lang, source, n_chars FROM documents"""
RT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@register("scan_round_trip", ROUND_TRIP_SQL)
def q_scan_round_trip(spark, sf):
    """Write a CSV with nulls, empty strings, quotes and line breaks to the
    shared staging folder and read it back with an explicit schema."""
    d = t(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit(None).cast("string"))
        .when(F.col("doc_id") % 5 == 1, F.lit("")).otherwise(F.col("text")).alias("text"),
        "lang", "source", "n_chars")
    import time as _time
    path = staging_path(spark, f"round-trip-{_time.time_ns()}.csv")
    csv_io.write_csv(d, path)
    return csv_io.read_csv(spark, path, d.schema, multiline=True)


# A CSV in which every ninth price is no number and every eleventh line is cut short.
_LINE = """CASE WHEN p_partkey % 11 = 0 THEN p_partkey || ',"' || p_name || '"'
  ELSE p_partkey || ',"' || p_name || '",' || CASE WHEN p_partkey % 9 = 0 THEN 'n/a' ELSE CAST(p_retailprice AS STRING) END || ',' || p_size END"""
_FITS = "p_partkey % 11 <> 0 AND p_partkey % 9 <> 0"


@register("csv_quarantine", f"""SELECT p_partkey, p_name, p_retailprice, p_size, NULL AS line FROM part WHERE {_FITS}
UNION ALL SELECT NULL, NULL, NULL, NULL, {_LINE} AS line FROM part WHERE NOT ({_FITS})""")
def q_csv_quarantine(spark, sf):
    """Good rows, and the lines of the quarantine table, of a CSV with bad lines."""
    lines = t(spark, sf, "part").select(F.expr(_LINE).alias("value"))
    opens = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    base = staging_path(spark, f"quarantine-{uuid.uuid4().hex}")
    (lines.select(F.when(opens, F.concat(F.lit("p_partkey,p_name,p_retailprice,p_size\n"), F.col("value"))).otherwise(F.col("value")).alias("value"))
     .write.text(f"{base}/in.csv"))
    schema = T.StructType.fromDDL("p_partkey bigint, p_name string, p_retailprice double, p_size int")
    good, _, _ = csv_io.read_quarantined(spark, f"{base}/in.csv", f"{base}/bad", schema)
    refused = spark.read.parquet(f"{base}/bad").select("line")
    return good.unionByName(refused, allowMissingColumns=True)


@register("export_round_trip", f"""{WITH_ENR}SELECT coalesce(title, '') AS title, coalesce(CAST(price AS VARCHAR), '') AS price,
  CASE WHEN availability THEN 'yes' WHEN NOT availability THEN 'no' ELSE '' END AS availability,
  coalesce(CAST(stock AS VARCHAR), '') AS stock, '' AS image_base64 FROM enr""")
def q_export_round_trip(spark, sf):
    """The written export, with its byte-order marks, read back as text."""
    path = staging_path(spark, f"export-{uuid.uuid4().hex}.csv")
    csv_io.write_export(enriched(spark, sf).withColumn("image_base64", F.lit(None).cast("string")), path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in csv_io.EXPORT_COLUMNS])
    return csv_io.read_csv(spark, path, schema, multiline=True).select("title", "price", "availability", "stock", "image_base64")


# =================================================================================
# 2.K / 2.L  gates and pipelines
# =================================================================================

@register("gate_processed", f"""{WITH_PROC}SELECT 'columns_present' AS rule, CAST(0 AS BIGINT) AS violations, TRUE AS passed
UNION ALL SELECT 'id_unique', count(*) - count(DISTINCT id), count(*) - count(DISTINCT id) = 0 FROM proc
UNION ALL SELECT 'price_positive', count_if(price <= 0), count_if(price <= 0) = 0 FROM proc
UNION ALL SELECT 'rating_1_to_5', count_if(rating < 1 OR rating > 5), count_if(rating < 1 OR rating > 5) = 0 FROM proc
UNION ALL SELECT 'stock_non_negative', count_if(stock < 0), count_if(stock < 0) = 0 FROM proc
UNION ALL SELECT 'flag_0_or_1', count_if(availability NOT IN (0, 1)), count_if(availability NOT IN (0, 1)) = 0 FROM proc""")
def q_gate_processed(spark, sf):
    return Q.gate_processed(processed(spark, sf))


_SCORE_BAD = "coalesce(popularity_score < 0 OR popularity_score > 1 OR isnan(popularity_score), TRUE)"


@register("gate_features", f"""{WITH_FEAT}SELECT 'features_present' AS rule, CAST(0 AS BIGINT) AS violations, TRUE AS passed
UNION ALL SELECT 'title_length_non_negative', count_if(title_length < 0), count_if(title_length < 0) = 0 FROM feat
UNION ALL SELECT 'popularity_0_to_1', count_if({_SCORE_BAD}), count_if({_SCORE_BAD}) = 0 FROM feat
""" + "\n".join(f"UNION ALL SELECT '{b}_boolean', count_if({b} IS NULL), count_if({b} IS NULL) = 0 FROM feat"
                for b in ("has_subtitle", "has_series", "starts_with_the", "has_numbers")))
def q_gate_features(spark, sf):
    return Q.gate_features(features(spark, sf))


@register("quality_summary", f"""{WITH_PROC}SELECT count(*) AS total_rows,
  CAST({" + ".join(f"count_if({c} IS NULL)" for c in ("id", "title", "price", "rating", "category", "image",
                                                       "product_page", "availability", "stock", "image_base64"))} AS BIGINT) AS total_nulls,
  count(DISTINCT id) AS unique_ids FROM proc""")
def q_quality_summary(spark, sf):
    return Q.quality_summary(processed(spark, sf))


@register("clean_stage", f"{WITH_PROC}SELECT {PROC_OUT_SQL} FROM proc")
def q_clean_stage(spark, sf):
    df, _ = E.run_cleaning(catalogue(spark, sf), CFG, KEY, stage_input=True)
    return df


@register("feature_stage", f"{WITH_FEAT}SELECT {FEAT_OUT_SQL} FROM feat")
def q_feature_stage(spark, sf):
    """L2 as the reference runs it: phase 2 starts from the written
    processed table (staged here), not from the phase-1 plan."""
    staged, path = stage_table(processed(spark, sf), "processed")
    df, _ = E.run_features(staged, CFG)
    remove_path(spark, path)   # the feature table is written; the phase-1 copy is done
    return df


@register("full_etl", f"{WITH_FEAT}SELECT {FEAT_OUT_SQL} FROM feat")
def q_full_etl(spark, sf):
    df, _ = E.run_full(spark, catalogue(spark, sf), CFG, KEY, stage_input=True)
    return df


@register("run_stats", f"""{WITH_FEAT}SELECT count(*) AS total_records,
  CAST({" + ".join(f"count_if({c} IS NULL)" for c in ("title", "price", "rating", "category", "image",
                                                       "product_page", "availability", "stock", "image_base64"))} AS BIGINT) AS null_records_found,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM cat GROUP BY title) WHERE n > 1) AS duplicate_titles,
  count_if(category IN ('PROMO', 'STANDARD')) AS categories_cleaned,
  (SELECT count(*) FROM proc) AS processed_records,
  CAST({10 + len(CAT_VOCAB)} AS BIGINT) AS features_created FROM cat""")
def q_run_stats(spark, sf):
    raw, _ = stage_table(catalogue(spark, sf), "raw")       # the join runs once
    # row and column counts do not depend on the id values
    proc = E.cleaning_plan(raw, CFG, KEY, with_id=False)
    return E.stats_frame(raw, proc, E.feature_plan(proc, CFG), CFG)


# =================================================================================
# 2.M  scaling and split
# =================================================================================

@register("minmax_scale", """WITH m AS (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b,
                  CAST(min(p_size) AS DOUBLE) AS c, CAST(max(p_size) AS DOUBLE) AS d FROM part)
SELECT p_partkey, p_retailprice, CAST(p_size AS BIGINT) AS p_size,
  CASE WHEN b - a = 0 THEN 0.0 ELSE (p_retailprice - a) / (b - a) END AS p_retailprice_minmax,
  CASE WHEN d - c = 0 THEN 0.0 ELSE (CAST(p_size AS DOUBLE) - c) / (d - c) END AS p_size_minmax
FROM part, m""")
def q_minmax_scale(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")
    return FE.minmax_scale(p, ["p_retailprice", "p_size"])


@register("train_test_split", f"""SELECT {KEY_SQL},
  CASE WHEN CAST('0x' || substr({S.key_digest(KEY)}, 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM lineitem""")
def q_train_test_split(spark, sf):
    li = t(spark, sf, "lineitem").select(*KEY)
    return FE.with_split_label(li, KEY, 80)


@register("zero_examples", """SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount = 0
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 3""")
def q_zero_examples(spark, sf):
    li = t(spark, sf, "lineitem")
    return Q.zero_examples(li, "l_discount", ["l_orderkey", "l_linenumber", "l_discount"],
                           ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 3)


# =================================================================================
# streaming: the stateless operators on a file stream of the events table
# =================================================================================

STREAM_CFG = PipelineConfig(problematic_categories=("error",), default_category="Outros")


@register("stream_row_features", f"""SELECT event_id, value,
  CASE WHEN event_type IN ('error') THEN 'Outros' ELSE event_type END AS category,
  {S.band('value', Bands.price())} AS price_range FROM events""")
def q_stream_row_features(spark, sf):
    """events.parquet read as a file stream (availableNow), price band and
    category replacement applied per micro-batch, appended to a Parquet sink
    in the shared staging folder, then read back."""
    from shelfwise.streaming import rowwise as RW
    path = f"{sf.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    out = RW.run_available_now(
        RW.file_stream(spark, RW.single_file_glob(path), schema),
        lambda df: RW.row_features(df.select("event_id", "value", F.col("event_type").alias("category")),
                                   STREAM_CFG, price="value"),
        name="events")
    return spark.read.parquet(out).select("event_id", "value", "category", "price_range")
