"""Text expressions: title features, parsers, slugs, normalisation.

Regex classes are written with Unicode properties (``\\p{Nd}``, ``\\p{L}``)
so a letter such as 'é' is a letter, not a special character; both Java
regex (Spark) and RE2 understand them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.config import (RATING_WORDS, SERIES_MARK, SLUG_EMPTY, SLUG_MAX_LENGTH, SUBTITLE_MARK,
                              TITLE_PREFIX)

DIGIT_RE = r"\p{Nd}"
SPECIAL_RE = r"[^\p{L}\p{M}\p{N}_\s]"
# leading / trailing whitespace of any kind (Spark's trim removes blanks only)
EDGE_SPACE_RE = r"^\s+|\s+$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), EDGE_SPACE_RE, "")


# --- title features (B9-B15) -------------------------------------------------

def has_subtitle(col: Column | str) -> Column:
    return _c(col).contains(SUBTITLE_MARK)


def has_series(col: Column | str) -> Column:
    return _c(col).contains(SERIES_MARK)


def starts_with_the(col: Column | str) -> Column:
    return _c(col).startswith(TITLE_PREFIX)


def char_length(col: Column | str) -> Column:
    return F.char_length(_c(col))


def word_count(col: Column | str) -> Column:
    """Pieces when splitting on one blank: '' -> 1, 'a  b' -> 3, null -> null."""
    c = _c(col)
    return F.when(c.isNotNull(), F.size(F.split(c, " ", -1)))


def has_digit(col: Column | str) -> Column:
    return _c(col).rlike(DIGIT_RE)


def has_special(col: Column | str) -> Column:
    return _c(col).rlike(SPECIAL_RE)


def title_feature_columns(title: str = "title") -> list[Column]:
    """The six title features of the feature pipeline, aliased."""
    t = F.col(title)
    return [
        has_subtitle(t).alias("has_subtitle"),
        has_series(t).alias("has_series"),
        starts_with_the(t).alias("starts_with_the"),
        char_length(t).alias("title_length"),
        word_count(t).alias("title_word_count"),
        has_digit(t).alias("has_numbers"),
    ]


# --- parsers (H1-H3, M5) -----------------------------------------------------

NUMBER_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_price(col: Column | str) -> Column:
    """Drop the pound sign and its mojibake, trim, to double; failure -> null.
    Only plain numbers count (the cast alone would take "1d" for 1.0)."""
    cleaned = strip_ws(F.replace(F.replace(_c(col), F.lit("£"), F.lit("")), F.lit("Â"), F.lit("")))
    return F.when(cleaned.rlike(NUMBER_RE), cleaned).try_cast("double")


def parse_price_locale(col: Column | str) -> Column:
    """'R$ 10,99' -> 10.99, '12.50' -> 12.5, '1.234,5' -> 1234.5.

    Keep digits, separators and sign; a trailing ``,d`` or ``,dd`` marks a
    decimal comma (dots are then thousands separators), otherwise commas
    are thousands separators.
    """
    kept = F.regexp_replace(_c(col), r"[^0-9.,-]", "")
    decimal_comma = kept.rlike(r",[0-9]{1,2}$")
    as_dot = F.when(decimal_comma,
                    F.replace(F.replace(kept, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    return as_dot.otherwise(F.replace(kept, F.lit(","), F.lit(""))).try_cast("double")


def rating_from_word(col: Column | str) -> Column:
    c = _c(col)
    expr = None
    for word, value in RATING_WORDS:
        expr = F.when(c == word, F.lit(value)) if expr is None else expr.when(c == word, F.lit(value))
    return expr


def parse_availability(col: Column | str) -> Column:
    """struct(in_stock boolean, stock bigint).

    "(n available)" (any case) -> (true, n); else the first number with
    in_stock = text contains "in stock"; else (in_stock, null).
    """
    t = F.coalesce(strip_ws(_c(col)), F.lit(""))
    in_stock = F.lower(t).contains("in stock")
    avail_n = F.nullif(F.regexp_extract(t, r"(?i)\(([0-9]+)\s*available\)", 1), F.lit(""))
    first_n = F.nullif(F.regexp_extract(t, r"([0-9]+)", 1), F.lit(""))
    flag = F.when(avail_n.isNotNull(), F.lit(True)).otherwise(in_stock)
    stock = F.coalesce(avail_n, first_n).try_cast("bigint")
    return F.struct(flag.alias("in_stock"), stock.alias("stock"))


# --- slugs and normalisation (H5, H6, M4) -----------------------------------

def slug(col: Column | str, maxlen: int = SLUG_MAX_LENGTH) -> Column:
    """null / '' -> 'unknown'; trim, lower, keep word chars, blanks and '-',
    runs of blanks / '-' -> '-', cut to ``maxlen``, trim '-'."""
    c = _c(col)
    t = F.lower(strip_ws(c))
    t = F.regexp_replace(t, r"[^\p{L}\p{N}_\s-]", "")
    t = F.regexp_replace(t, r"[-\s]+", "-")
    t = F.substring(t, 1, maxlen)
    t = F.regexp_replace(t, r"^-+|-+$", "")
    return F.when(c.isNull() | (c == ""), F.lit(SLUG_EMPTY)).otherwise(t)


def column_slug(value: str) -> str:
    """One-hot column suffix of a category value (plan time, Python)."""
    return value.replace(" ", "_").replace("&", "and").lower()


def column_slug_of(col: Column | str) -> Column:
    """``column_slug`` of a column's values."""
    return F.lower(F.replace(F.replace(_c(col), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and")))


def normalize_text(col: Column | str) -> Column:
    """'+' -> blank, '&' -> ' and ', runs of blanks -> one, trimmed."""
    t = F.replace(_c(col), F.lit("+"), F.lit(" "))
    t = F.replace(t, F.lit("&"), F.lit(" and "))
    t = F.regexp_replace(t, r"\s+", " ")
    return strip_ws(t)


def is_placeholder(col: Column | str) -> Column:
    """null, '', '0', 'null', 'n/a' or 'na' (case-insensitive)."""
    c = _c(col)
    low = F.lower(c)
    return c.isNull() | (c == "") | (c == "0") | low.isin("null", "n/a", "na")


def base64_text(col: Column | str) -> Column:
    """Base64 of a binary (or UTF-8 text) column as one line, without the
    MIME line breaks Spark's ``base64`` may insert."""
    c = _c(col)
    return F.regexp_replace(F.base64(c), r"[\r\n]", "")
