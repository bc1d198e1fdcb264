"""URL expressions: resolve a reference against a page URL, drop the
fragment, file extension, SHA-1 key.  All are column expressions, so they
run inside whole-stage codegen with no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.-]*:"
ORIGIN_RE = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
# one path segment that is neither '.' nor '..' (nor empty)
SEGMENT_RE = r"([^./][^/]*|\.[^./][^/]*|\.\.[^/]+)"
# compiled '..' passes before the exact stack takes over
FAST_PASSES = 4
# one path segment that is neither '.' nor '..'

# --- fixed values: content type -> extension, and the default ---------------
CONTENT_TYPE_EXTENSIONS = (
    ("image/jpeg", ".jpg"),
    ("image/png", ".png"),
    ("image/gif", ".gif"),
    ("image/webp", ".webp"),
    ("image/svg+xml", ".svg"),
    ("image/bmp", ".bmp"),
    ("image/tiff", ".tiff"),
)
DEFAULT_EXTENSION = ".jpg"
# -----------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _stack_resolve(path: Column, keep_empty: Column) -> Column:
    """Exact '.' / '..' resolution at any depth: the segments are folded
    with a stack ('..' pops, '.' is skipped); empty middle segments are
    dropped for relative references and kept for root-relative ones; a
    final '.' or '..' leaves a trailing slash."""
    segs = F.split(path, "/", -1)
    rest = F.slice(segs, 2, F.size(segs) - 1)
    rest = F.when(keep_empty, rest).otherwise(
        F.filter(rest, lambda s, i: (s != "") | (i == F.size(rest) - 1)))
    stack = F.aggregate(
        rest, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))))
    trail = F.when(F.element_at(segs, -1).isin(".", "..") & (F.size(stack) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(stack, "/"), trail)


def remove_dot_segments(path: Column, keep_empty: Column) -> Column:
    """Resolve '.' and '..' in an absolute path exactly, at any depth.

    A few compiled regex passes resolve the usual shapes (each pass is one
    step of the stack fold: '/seg/..' removed, '/./' removed, '//' collapsed
    for relative references); a row that still holds a dot segment after
    them goes through the exact segment stack.
    """
    p = F.when(keep_empty, path).otherwise(F.regexp_replace(path, r"/{2,}", "/"))
    p = F.regexp_replace(p, r"(/\.)+/", "/")
    p = F.regexp_replace(p, r"/\.$", "/")
    for _ in range(FAST_PASSES):
        p = F.regexp_replace(p, "/" + SEGMENT_RE + r"/\.\.(/|$)", "/")
        p = F.regexp_replace(p, r"^/\.\.(/|$)", "/")
    return F.when(p.rlike(r"(^|/)\.\.?(/|$)"), _stack_resolve(p, keep_empty)).otherwise(p)


def drop_fragment(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), r"(?s)#.*$", "")


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Resolve ``href`` against the page URL ``base`` (RFC 3986 style).

    The dot-segment removal is applied once, to the path chosen by the
    reference's shape (root-relative or relative), so the expression stays
    small enough for whole-stage code generation.
    """
    b, h = _c(base), _c(href)
    origin = F.regexp_extract(b, ORIGIN_RE, 1)
    b_noquery = F.regexp_replace(b, r"(?s)[?#].*$", "")
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_rest = F.regexp_extract(h, r"(?s)^[^?#]*(.*)$", 1)
    b_dir = F.regexp_extract(F.substring(b_noquery, F.char_length(origin) + 1, 1 << 30), r"^(.*/)", 1)
    is_other = (h.isNull() | b.isNull() | (b == "") | (h == "") | h.rlike(SCHEME_RE)
                | h.startswith("?") | h.startswith("#") | h.startswith("//"))
    path_in = (F.when(is_other, F.lit(None).cast("string"))
               .when(h.startswith("/"), h_path)
               .otherwise(F.concat(F.when(b_dir == "", F.lit("/")).otherwise(b_dir), h_path)))
    keep_empty = F.coalesce(h.startswith("/"), F.lit(False))
    return (
        F.when(h.isNull(), F.lit(None).cast("string"))
        .when(b.isNull() | (b == ""), h)
        .when(h == "", b)
        .when(h.rlike(SCHEME_RE), h)
        .when(h.startswith("//"),
              F.concat(F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.lit(":"), h))
        .when(h.startswith("?"), F.concat(b_noquery, h))
        .when(h.startswith("#"), F.concat(F.regexp_replace(b, r"(?s)#.*$", ""), h))
        .otherwise(F.concat(origin, remove_dot_segments(path_in, keep_empty), h_rest))
    )


def canonical_url(base: Column | str, href: Column | str) -> Column:
    """Resolved URL without fragment (the product-page key)."""
    return drop_fragment(resolve_url(base, href))


def url_path(col: Column | str) -> Column:
    """Path of a URL: no scheme / host, no query, no fragment."""
    no_q = F.regexp_replace(_c(col), r"(?s)[?#].*$", "")
    return F.regexp_replace(no_q, r"^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/]*", "")


def url_extension(col: Column | str, content_type: Column | str | None = None,
                  default: str = DEFAULT_EXTENSION) -> Column:
    """Lower-case suffix of the last path segment ('.png'); a name that
    starts with its only dot or ends in a dot has none.  Falls back to the
    content type, then to ``default``."""
    name = F.regexp_extract(url_path(col), r"([^/]*)/*$", 1)
    ext = F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))
    ext = F.nullif(ext, F.lit(""))
    fallback = F.lit(default)
    if content_type is not None:
        ct = F.lower(strip_params(_c(content_type)))
        by_ct = None
        for mime, e in CONTENT_TYPE_EXTENSIONS:
            by_ct = F.when(ct == mime, F.lit(e)) if by_ct is None else by_ct.when(ct == mime, F.lit(e))
        fallback = F.coalesce(by_ct, fallback)
    return F.coalesce(ext, fallback)


def strip_params(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, r";.*$", ""), r"^\s+|\s+$", "")


def url_sha1(col: Column | str) -> Column:
    return F.sha1(_c(col).cast("binary"))


def with_resolved_url(df: DataFrame, base: str, href: str, out: str, canonical: bool = False) -> DataFrame:
    """``resolve_url`` (or ``canonical_url``) as successive projections.

    The URL parts, the shape of the reference, the compiled dot passes and
    the exact fallback each live in their own projection, so every regex
    runs once per row and the generated code stays small (the one-expression
    form repeats sub-trees wherever a part is used).  Same result as
    ``resolve_url`` / ``canonical_url``.
    """
    keep = list(df.columns)
    b, h = F.col(base), F.col(href)
    kind = (F.when(h.isNull(), F.lit("null"))
            .when(b.isNull() | (b == ""), F.lit("nobase"))
            .when(h == "", F.lit("empty"))
            .when(h.rlike(SCHEME_RE), F.lit("abs"))
            .when(h.startswith("//"), F.lit("net"))
            .when(h.startswith("?"), F.lit("query"))
            .when(h.startswith("#"), F.lit("frag"))
            .when(h.startswith("/"), F.lit("root"))
            .otherwise(F.lit("rel")))
    s1 = df.select(
        "*", kind.alias("_u_kind"), F.regexp_extract(b, ORIGIN_RE, 1).alias("_u_origin"),
        F.regexp_replace(b, r"(?s)[?#].*$", "").alias("_u_bnq"),
        F.regexp_extract(h, r"^([^?#]*)", 1).alias("_u_hpath"),
        F.regexp_extract(h, r"(?s)^[^?#]*(.*)$", 1).alias("_u_hrest"))
    b_dir = F.regexp_extract(F.substring("_u_bnq", F.char_length("_u_origin") + 1, 1 << 30), r"^(.*/)", 1)
    s2 = s1.select("*", F.when(F.col("_u_kind") == "root", F.col("_u_hpath"))
                   .when(F.col("_u_kind") == "rel",
                         F.concat(F.when(b_dir == "", F.lit("/")).otherwise(b_dir), F.col("_u_hpath")))
                   .alias("_u_pin"))
    keep_empty = F.col("_u_kind") == "root"
    p = F.when(keep_empty, F.col("_u_pin")).otherwise(F.regexp_replace("_u_pin", r"/{2,}", "/"))
    p = F.regexp_replace(p, r"(/\.)+/", "/")
    p = F.regexp_replace(p, r"/\.$", "/")
    for _ in range(FAST_PASSES):
        p = F.regexp_replace(p, "/" + SEGMENT_RE + r"/\.\.(/|$)", "/")
        p = F.regexp_replace(p, r"^/\.\.(/|$)", "/")
    s3 = s2.select("*", p.alias("_u_p1"))
    s4 = s3.select("*", F.when(F.col("_u_p1").rlike(r"(^|/)\.\.?(/|$)"),
                               _stack_resolve(F.col("_u_p1"), keep_empty)).otherwise(F.col("_u_p1"))
                   .alias("_u_path"))
    k = F.col("_u_kind")
    res = (F.when(k == "null", F.lit(None).cast("string"))
           .when(k == "nobase", h)
           .when(k == "empty", b)
           .when(k == "abs", h)
           .when(k == "net", F.concat(F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.lit(":"), h))
           .when(k == "query", F.concat(F.col("_u_bnq"), h))
           .when(k == "frag", F.concat(F.regexp_replace(b, r"(?s)#.*$", ""), h))
           .otherwise(F.concat(F.col("_u_origin"), F.col("_u_path"), F.col("_u_hrest"))))
    if canonical:
        res = drop_fragment(res)
    return s4.select(*[F.col(f"`{c}`") for c in keep if c != out], res.alias(out))
