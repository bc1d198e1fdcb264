"""HTML as an array of tags and texts, and the elements between them.

``tokens`` cuts a page into tags, texts, comments and declarations; quoted ``>``,
comments and the bodies of scripts and styles do not end or start a tag.
``elements`` pairs start and end tags with a stack, as lenient parsers do: an end tag
closes the last open element of its name and all that were opened within; one that
has nothing to close is ignored; void and self-closed elements end where they start;
what is open at the end lasts to the end.  Ranges of token numbers then answer which
element lies in which, and every lookup is an expression on the two arrays, so pages
are taken apart row by row in the JVM.

An element is ``struct<name, at, end>``: its start tag is token ``at`` (from 0), its
end tag token ``end``.  Names of tags and attributes are compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.html import decode_all, decode_entities

# Elements that never have content
VOID = ("area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input", "isindex",
        "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr")
# Elements whose content is no markup and no text of the page
RAW = ("script", "style")

# one attribute: a name, and a value in double quotes, in single quotes or bare
_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++)?)?"""
_ATTRIBUTES = rf"(?:[\s/]++|{_ATTRIBUTE})*+"
_TAG_START = r"<(?![a-zA-Z/!?])"        # a '<' that starts nothing is text
TOKEN_RE = "(?s)" + "|".join((
    r"<!--(?:-?>|.*?(?:--!?>|\z))",
    rf"<(?i:{'|'.join(RAW)})(?=[\s/>]){_ATTRIBUTES}>.*?(?:(?=</(?i:{'|'.join(RAW)})[\s/>])|\z)",
    r"</[a-zA-Z][^>]*+>",
    rf"<[a-zA-Z][^\s/>]*+{_ATTRIBUTES}>",
    r"<[!?/][^>]*+>?",
    rf"[^<]++(?:{_TAG_START}[^<]*+)*+",
    rf"(?:{_TAG_START}[^<]*+)++",
    r"<[^<]*+",                         # a tag that the end of the page cuts off
))
_EDGES = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"
_BETWEEN = "\uffff"                # no character: keeps texts apart while they are decoded together


def tokens(html: Column | str) -> Column:
    """Tags, texts, comments and declarations of a page, in order."""
    return F.regexp_extract_all(F.col(html) if isinstance(html, str) else html, F.lit(TOKEN_RE), 0)


def is_text(token: Column) -> Column:
    return ~token.rlike("^<[a-zA-Z/!?]")


def tag_name(token: Column) -> Column:
    """Lower-case name of a start or end tag, '' for any other token."""
    return F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^\s/>]*)", 1))


def elements(tokens_: Column | str) -> Column:
    """``array<struct<name, at, end>>`` of all elements, in document order."""
    tok = F.col(tokens_) if isinstance(tokens_, str) else tokens_
    element = "array<struct<name:string,at:int,end:int>>"
    tags = F.filter(F.transform(tok, lambda t, i: F.struct(
        tag_name(t).alias("name"), i.alias("at"), t.startswith("</").alias("ends"),
        (t.endswith("/>") & ~t.rlike(r"""=\s*[^\s"'>]+/>$""")).alias("empty"))), lambda t: t["name"] != "")
    alone = lambda t: ~t["ends"] & (t["empty"] | t["name"].isin(*VOID))
    start = F.struct(F.array().cast(element).alias("open"), F.array().cast(element).alias("done"))

    def step(acc, t):
        size = F.size(acc["open"])
        # the stack's top comes first, so the first of a name is the last opened
        depth = F.array_position(F.transform(acc["open"], lambda o: o["name"]), t["name"]).cast("int")
        opened = F.struct(F.concat(F.array(F.struct(t["name"].alias("name"), t["at"].alias("at"), t["at"].alias("end"))), acc["open"]).alias("open"),
                          acc["done"].alias("done"))
        closed = F.struct(
            F.slice(acc["open"], depth + 1, size).alias("open"),
            F.concat(acc["done"], F.transform(F.slice(acc["open"], F.lit(1), depth),
                                              lambda o: F.struct(o["name"].alias("name"), o["at"].alias("at"), t["at"].alias("end")))).alias("done"))
        return F.when(~t["ends"], opened).when(depth > 0, closed).otherwise(acc)

    def finish(acc):
        rest = F.transform(acc["open"], lambda o: F.struct(o["name"].alias("name"), o["at"].alias("at"), F.size(tok).alias("end")))
        return F.concat(acc["done"], rest)

    def both(listed):
        single = F.transform(F.filter(listed, alone), lambda t: F.struct(t["name"].alias("name"), t["at"].alias("at"), t["at"].alias("end")))
        return F.concat(single, F.aggregate(F.filter(listed, lambda t: ~alone(t)), start, step, finish))

    found = F.get(F.transform(F.array(tags), both), F.lit(0))       # the tags are worked out once
    return F.array_sort(found, lambda a, b: a["at"] - b["at"])


def raw_attribute(token: Column, name: str) -> Column:
    """Value of an attribute of a start tag as it is written: '' for a bare one, null
    for none; the last one counts where a name is repeated."""
    attributes = F.regexp_extract(token, rf"(?s)^<[a-zA-Z][^\s/>]*+({_ATTRIBUTES})", 1)
    own = F.filter(F.regexp_extract_all(attributes, F.lit(_ATTRIBUTE), 0), lambda a: a.rlike(rf"(?is)^{name}\s*(=|$)"))
    last = F.try_element_at(own, F.lit(-1))
    value = F.regexp_replace(F.regexp_replace(last, r"(?s)^[^=]*=?\s*", ""), r"""(?s)^(["'])(.*)\1$""", "$2")
    return F.when(F.contains(F.lower(token), F.lit(name)), value)


def attribute(token: Column, name: str) -> Column:
    """:func:`raw_attribute` with its character references decoded."""
    return decode_entities(raw_attribute(token, name))


def classes(token: Column) -> Column:
    """Classes of a start tag; names written with character references are not met."""
    return F.filter(F.split(raw_attribute(token, "class"), r"[ \t\n\f\r]+"), lambda c: c != "")


def has_classes(token: Column, *names: str) -> Column:
    """Whether a start tag has all these classes; the plain search comes first."""
    held = F.lit(True)
    for n in names:
        held = held & F.contains(token, F.lit(n))
    missing = F.array_except(F.array(*map(F.lit, names)), classes(token))
    return held & F.coalesce(F.size(missing) == 0, F.lit(False))


def select(tokens_: Column, elements_: Column, path: str) -> Column:
    """Elements that a path of steps like ``li`` or ``ul.nav.list`` leads to, each step
    within the one before, in document order; ``.item`` is an element of any name."""
    found = None
    for step in path.split():
        here = _named(tokens_, elements_, *step.split("."))
        found = here if found is None else _within(here, found)
    return found


def _named(tokens_: Column, elements_: Column, name: str, *wanted: str) -> Column:
    def fits(e):
        named = (e["name"] == name) if name else F.lit(True)
        return named & has_classes(F.get(tokens_, e["at"]), *wanted) if wanted else named
    return F.filter(elements_, fits)


def _within(these: Column, outer: Column) -> Column:
    # the outer elements are looked up once, not once for each of these
    return F.get(F.transform(F.array(outer), lambda found: F.filter(
        these, lambda e: F.exists(found, lambda o: (o["at"] < e["at"]) & (e["at"] < o["end"])))), F.lit(0))


def first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def tag(tokens_: Column, element: Column) -> Column:
    """Start tag of an element."""
    return F.get(tokens_, element["at"])


def inside(tokens_: Column, elements_: Column, element: Column) -> Column:
    """``struct<tok, el>``: an element as a page of its own, which it opens."""
    at, end = element["at"], element["end"]
    within = F.transform(F.filter(elements_, lambda e: (e["at"] >= at) & (e["at"] <= end)),
                         lambda e: F.struct(e["name"].alias("name"), (e["at"] - at).alias("at"), (e["end"] - at).alias("end")))
    return F.struct(F.slice(tokens_, at + 1, end - at + 1).alias("tok"), within.alias("el"))


def raw_text(texts: Column) -> Column:
    """Text tokens among ``texts``, as written, for :func:`clean_text` after decoding."""
    return F.array_join(F.filter(texts, is_text), _BETWEEN)


def clean_text(decoded: Column, separator: str = "") -> Column:
    """Each text without outer blanks, joined."""
    return F.array_join(F.filter(F.transform(F.split(decoded, _BETWEEN), lambda x: F.regexp_replace(x, _EDGES, "")), lambda x: x != ""), separator)


def content(tokens_: Column, element: Column) -> Column:
    """Tokens between the tags of an element; null for no element."""
    return F.slice(tokens_, element["at"] + 2, F.greatest(element["end"] - element["at"] - 1, F.lit(0)))


def text_of(texts: Column, separator: str = "") -> Column:
    """Text tokens among ``texts``, decoded, each without outer blanks, joined."""
    return clean_text(decode_entities(raw_text(texts)), separator)


def text(tokens_: Column, element: Column, separator: str = "") -> Column:
    """Text of an element, without scripts, styles and comments; null for no element."""
    return text_of(content(tokens_, element), separator)


def decoded(**fields: Column) -> Column:
    """``struct`` of the fields with their references decoded, by one expression."""
    names = list(fields)
    return F.transform(F.array(decode_all(F.array(*fields.values()))), lambda a: F.struct(*(a[i].alias(n) for i, n in enumerate(names))))[0]
