"""Character references of HTML as column expressions (see ``functions.markup`` for
tags and elements)."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# All named references of HTML 5, from the standard library's table: those with a
# semicolon by name, the old ones that also stand without one.  Each table is one
# text, searched by name, for a map of this size in a plan slows its planning.
_END, _IS = "\x01", "\x02"


def _table(entries: dict[str, str]) -> str:
    return _END + "".join(f"{k}{_IS}{v}{_END}" for k, v in entries.items())


_NAMED = _table({k[:-1]: v for k, v in html5.items() if k.endswith(";")})
_BARE = _table({k: v for k, v in html5.items() if not k.endswith(";")})
_BARE_RE = "^(" + "|".join(sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))) + ")"
# numbers 128 to 159 mean the Windows-1252 characters
_WINDOWS = _table({str(i): c for i in range(128, 160) if (c := bytes([i]).decode("cp1252", "replace")) != "\ufffd"})


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decode_entities(col: Column | str) -> Column:
    """Character references decoded once, from left to right: named ones,
    decimal and hexadecimal ones; what is no reference stays."""
    return decode_all(F.array(_c(col)))[0]      # the input is computed once


def decode_all(texts: Column) -> Column:
    """:func:`decode_entities` of each text of an array: one expression for many fields."""
    def look_up(table: str, name: Column) -> Column:
        at = F.instr(F.lit(table), F.concat(F.lit(_END), name, F.lit(_IS)))
        value = F.substring_index(F.substr(F.lit(table), at + F.length(name) + 2, F.lit(4)), _END, 1)
        return F.when((name != "") & (at > 0), value)

    def after(part: Column) -> Column:      # the text behind an ampersand
        name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        bare = F.regexp_extract(part, _BARE_RE, 1)
        decimal = F.regexp_extract(part, r"^#([0-9]{1,7});?", 1)
        hexa = F.regexp_extract(part, r"^#[xX]([0-9A-Fa-f]{1,6});?", 1)
        number = F.when(decimal != "", decimal.cast("int")).when(hexa != "", F.conv(hexa, 16, 10).cast("int"))
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.coalesce(look_up(_WINDOWS, number.cast("string")),
                          F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd")))
        return F.coalesce(
            F.when(number.isNotNull(), F.concat(char, F.regexp_replace(part, r"^#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});?", ""))),
            F.concat(look_up(_NAMED, name), F.substr(part, F.length(name) + 2)),
            F.concat(look_up(_BARE, bare), F.substr(part, F.length(bare) + 1)),
            F.concat(F.lit("&"), part))

    def whole(t: Column) -> Column:
        parts = F.split(t, "&")
        return F.when(F.contains(t, F.lit("&")),
                      F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), after), ""))).otherwise(t)

    return F.transform(texts, whole)
