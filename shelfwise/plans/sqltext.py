"""DuckDB SQL text of the column expressions, for the oracle queries.

Each function says in SQL what one expression builder of ``shelfwise.functions``
must give, with patterns of its own: none is taken from the engine, and they may
rely on how the test data are written.  What the formulas have in common with the
engine's is held against written-out values in ``text_literals``.  (DuckDB needs the
'g' flag to replace every match.)
"""

from __future__ import annotations

from shelfwise.config import RATING_LABELS, RATING_WORDS, SLUG_MAX_LENGTH, Bands


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(x: str, pat: str, rep: str = "") -> str:
    return f"regexp_replace({x}, {q(pat)}, {q(rep)}, 'g')"


def strip_ws(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def first_match(x: str, pat: str, group: int = 1) -> str:
    return f"(CASE WHEN regexp_matches({x}, {q(pat)}) THEN regexp_extract({x}, {q(pat)}, {group}) END)"


#: The entities that occur in the test pages, written out here on purpose: the oracle shares no list with the engine.
PAGE_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "©"),
                 ("&middot;", "·"), ("&pound;", "£"), ("&eacute;", "é"), ("&#233;", "é"), ("&#xe9;", "é"), ("&euro;", "€"),
                 ("&hellip;", "…"), ("&amp;", "&"))


def decode_entities(x: str) -> str:
    for ent, ch in PAGE_ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return f"replace({x}, '&amp', '&')"     # an old name may end without a semicolon; texts that are cut do


def node_text(x: str) -> str:
    return strip_ws(decode_entities(rr(x, "(?s)<[^>]*>")))


def page_text(x: str) -> str:
    """Text of a whole page: the pieces between tags, each without outer blanks."""
    shown = rr(x, "(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>", "<x>")
    pieces = f"regexp_split_to_array({shown}, '(?s)<[^>]*>')"
    return f"array_to_string(list_transform({pieces}, lambda p: {strip_ws(decode_entities('p'))}), '')"


def band(x: str, bands: Bands) -> str:
    parts = " ".join(f"WHEN {x} <= {float(u)!r} THEN {q(lab)}" for u, lab in bands.bounds)
    tail = f" ELSE {q(bands.top_label)}" if bands.top_label is not None else ""
    return f"(CASE {parts}{tail} END)"


def rating_label(x: str) -> str:
    return "(CASE " + " ".join(f"WHEN {x} = {v} THEN {q(lab)}" for v, lab in RATING_LABELS) + " END)"


def rating_from_word(x: str) -> str:
    return "(CASE " + " ".join(f"WHEN {x} = {q(w)} THEN {v}" for w, v in RATING_WORDS) + " END)"


def parse_price(x: str) -> str:
    cleaned = strip_ws(f"replace(replace({x}, {q('£')}, ''), {q('Â')}, '')")
    return f"CASE WHEN NOT regexp_matches({cleaned}, '[_a-zA-Z]') THEN TRY_CAST({cleaned} AS DOUBLE) END"


def parse_price_locale(x: str) -> str:
    kept = rr(x, r"[^0-9.,-]")
    return (f"TRY_CAST(CASE WHEN regexp_matches({kept}, {q(r',[0-9]{1,2}$')}) "
            f"THEN replace(replace({kept}, '.', ''), ',', '.') ELSE replace({kept}, ',', '') END AS DOUBLE)")


def availability(x: str) -> tuple[str, str]:
    t = f"coalesce({strip_ws(x)}, '')"
    avail_n = f"nullif(regexp_extract({t}, {q(r'(?i)\(([0-9]+)\s*available\)')}, 1), '')"
    first_n = f"nullif(regexp_extract({t}, {q(r'([0-9]+)')}, 1), '')"
    flag = f"(CASE WHEN {avail_n} IS NOT NULL THEN TRUE ELSE contains(lower({t}), 'in stock') END)"
    stock = f"TRY_CAST(coalesce({avail_n}, {first_n}) AS BIGINT)"
    return flag, stock


def slug(x: str, maxlen: int = SLUG_MAX_LENGTH) -> str:
    t = f"lower({strip_ws(x)})"
    t = rr(t, r"[^\p{L}\p{N}_\s-]")
    t = rr(t, r"[-\s]+", "-")
    t = f"substr({t}, 1, {maxlen})"
    t = rr(t, r"^-+|-+$")
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN 'unknown' ELSE {t} END)"


def normalize_text(x: str) -> str:
    t = f"replace(replace({x}, '+', ' '), '&', ' and ')"
    return strip_ws(rr(t, r"\s+", " "))


def drop_fragment(x: str) -> str:
    return rr(x, r"(?s)#.*$")


def remove_dot_segments(p: str, keep_empty: str) -> str:
    segs = f"string_split({p}, '/')"
    rest = f"({segs})[2:]"
    kept = (f"(CASE WHEN {keep_empty} THEN {rest} "
            f"ELSE list_filter({rest}, lambda s, i: s <> '' OR i = len({rest})) END)")
    stack = (f"list_reduce({kept}, lambda acc, s: CASE WHEN s = '..' THEN "
             f"(CASE WHEN len(acc) = 0 THEN acc ELSE acc[1:len(acc) - 1] END) "
             f"WHEN s = '.' THEN acc ELSE list_append(acc, s) END, []::VARCHAR[])")
    trail = f"(CASE WHEN ({segs})[-1] IN ('.', '..') AND len({stack}) > 0 THEN '/' ELSE '' END)"
    return f"('/' || array_to_string({stack}, '/') || {trail})"


def resolve_url(b: str, h: str) -> str:
    origin = f"regexp_extract({b}, {q("^(https?://[^/?#]+)")}, 1)"
    b_scheme = f"regexp_extract({b}, {q(r'^([A-Za-z][A-Za-z0-9+.-]*):')}, 1)"
    b_noquery = rr(b, r"(?s)[?#].*$")
    b_nofrag = rr(b, r"(?s)#.*$")
    b_dir = f"regexp_extract(substr({b_noquery}, length({origin}) + 1), {q(r'^(.*/)')}, 1)"
    h_path = f"regexp_extract({h}, {q(r'^([^?#]*)')}, 1)"
    h_rest = f"regexp_extract({h}, {q(r'(?s)^[^?#]*(.*)$')}, 1)"
    is_other = (f"({h} IS NULL OR {b} IS NULL OR {b} = '' OR {h} = '' OR regexp_matches({h}, {q("^[a-z]+:")}) "
                f"OR starts_with({h}, '?') OR starts_with({h}, '#') OR starts_with({h}, '//'))")
    path_in = (f"(CASE WHEN {is_other} THEN NULL WHEN starts_with({h}, '/') THEN {h_path} "
               f"ELSE (CASE WHEN {b_dir} = '' THEN '/' ELSE {b_dir} END) || {h_path} END)")
    return (f"(CASE WHEN {h} IS NULL THEN NULL "
            f"WHEN {b} IS NULL OR {b} = '' THEN {h} "
            f"WHEN {h} = '' THEN {b} "
            f"WHEN regexp_matches({h}, {q("^[a-z]+:")}) THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {b_scheme} || ':' || {h} "
            f"WHEN starts_with({h}, '?') THEN {b_noquery} || {h} "
            f"WHEN starts_with({h}, '#') THEN {b_nofrag} || {h} "
            f"ELSE {origin} || {remove_dot_segments(path_in, f'coalesce(starts_with({h}, {q(chr(47))}), FALSE)')} || {h_rest} END)")


def canonical_url(b: str, h: str) -> str:
    return drop_fragment(resolve_url(b, h))


def url_path(x: str) -> str:
    return rr(rr(x, r"(?s)[?#].*$"), r"^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/]*")


def url_extension(x: str) -> str:
    name = f"regexp_extract({url_path(x)}, {q(r'([^/]*)/*$')}, 1)"
    ext = f"nullif(lower(regexp_extract({name}, {q(r'^.+(\.[^.]+)$')}, 1)), '')"
    return f"coalesce({ext}, '.jpg')"


def key_digest(cols: list[str]) -> str:
    parts = " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)
    return f"md5({parts})"


def word_count(x: str) -> str:
    return f"CAST(len(string_split({x}, ' ')) AS BIGINT)"


def title_features(t: str) -> str:
    return (f"contains({t}, ':') AS has_subtitle, contains({t}, '(') AS has_series, "
            f"starts_with({t}, 'The ') AS starts_with_the, CAST(length({t}) AS BIGINT) AS title_length, "
            f"{word_count(t)} AS title_word_count, regexp_matches({t}, '[0-9]') AS has_numbers")
