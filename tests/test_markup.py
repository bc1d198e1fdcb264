"""The tag tokeniser against the standard library's HTML parser."""

import random
import time
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import markup as M


class Tree(HTMLParser):
    """Elements as [name, attributes, position in the document, ancestors, texts within]."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.all, self.open, self.data = [], [], ""
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        if self.data and not (self.open and self.open[-1][0] in M.RAW):
            for e in self.open:
                e[3].append(self.data)
        self.data = ""

    def handle_starttag(self, tag, attrs, closed=False):
        self.flush()
        element = (tag, {k: v or "" for k, v in attrs}, list(self.open), [])
        self.all.append(element)
        if not closed and tag not in M.VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, True)

    def handle_endtag(self, tag):
        self.flush()
        if any(e[0] == tag for e in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        self.data += data

    def handle_entityref(self, name):
        self.data += f"&{name};"

    def handle_charref(self, name):
        self.data += f"&#{name};"

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def select(self, path):
        found = None
        for step in path.split():
            name, *cls = step.split(".")
            found = [e for e in self.all if (not name or e[0] == name) and set(cls) <= set(e[1].get("class", "").split())
                     and (found is None or any(o is a for o in found for a in e[2]))]
        return found

    @staticmethod
    def text(e, sep=""):
        return sep.join(t for t in (unescape(x).strip() for x in e[3]) if t)


def page(rng, size):
    def attrs():
        out = []
        for _ in range(rng.randint(0, 3)):
            v = rng.choice(["a", "x y", "nav", "nav list", "a > b", "&amp;c", "q.html", ""])
            form = rng.choice([f'"{v}"', f"'{v}'", f' = "{v}"'.replace(' = ', ""), v if v and not set(v) & set(" >&") else f'"{v}"'])
            name = rng.choice(["class", "href", "CLASS", "title", "data-x"])
            out.append(rng.choice([f" {name}={form}", f"\n{name} = {form}", f" {name}"]))
        return "".join(out)

    parts = []
    for _ in range(size):
        tag = rng.choice(["div", "ul", "li", "a", "p", "b", "DIV", "nav", "span"])
        parts.append(rng.choice([
            lambda: f"<{tag}{attrs()}>", lambda: f"<{tag}{attrs()}>", lambda: f"</{tag}>", lambda: f"</{tag} >", lambda: f"<{tag}{attrs()} />",
            lambda: "<br>", lambda: f"<img{attrs()}>", lambda: "<!-- <a href='no'>no</a> -->", lambda: "<script>if (a < b) '<li></ul>'</script>",
            lambda: "<style>a > b {}</style>", lambda: " text ", lambda: "a &lt; b", lambda: "x < y", lambda: "\n", lambda: "caf&eacute;&#33;", lambda: "&nbsp;z"])())
    return "".join(parts)


PATHS = ["a", "nav a", "li.nav", "div.nav.list ul a", ".list b", "p", "ul li a"]


def test_random_pages_give_what_a_parser_gives(spark):
    rng = random.Random(8)
    pages = [page(rng, rng.randint(1, 60)) for _ in range(900)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    tok, el = F.col("t"), F.col("e")
    shown = lambda path: F.transform(M.select(tok, el, path), lambda e: F.struct(
        e["name"], M.attribute(M.tag(tok, e), "href"), M.attribute(M.tag(tok, e), "title"), M.text(tok, e), M.text(tok, e, "|")))
    got = (df.select("i", M.tokens("html").alias("t")).select("*", M.elements("t").alias("e"))
           .select("i", *(shown(p).alias(f"p{k}") for k, p in enumerate(PATHS))).collect())
    some = 0
    for r in got:
        tree = Tree(pages[r["i"]])
        for k, path in enumerate(PATHS):
            want = [(e[0], e[1].get("href"), e[1].get("title"), tree.text(e), tree.text(e, "|")) for e in tree.select(path)]
            assert [tuple(x) for x in r[f"p{k}"]] == want, (path, pages[r["i"]])
            some += len(want)
    assert some > 1000


@pytest.mark.parametrize("html, tokens", [
    ("", []), ("plain", ["plain"]), ("<", ["<"]), ("a<1<b>c", ["a<1", "<b>", "c"]), ("<a href='x>y' b>z", ["<a href='x>y' b>", "z"]),
    ("<!-- <b> --><b>", ["<!-- <b> -->", "<b>"]), ("<!--><b>", ["<!-->", "<b>"]), ("<!-- open <b>", ["<!-- open <b>"]),
    ("<script>a<b</script>c", ["<script>a<b", "</script>", "c"]), ("<SCRIPT x='>'>\n</a></Script >", ["<SCRIPT x='>'>\n</a>", "</Script >"]),
    ("<scripts>a</scripts>", ["<scripts>", "a", "</scripts>"]), ("<!DOCTYPE html><?x y?></ z>", ["<!DOCTYPE html>", "<?x y?>", "</ z>"]),
    ("<p>x<a href='cut", ["<p>", "x", "<a href='cut"]), ("<a b=c/>", ["<a b=c/>"])])
def test_tokens(spark, html, tokens):
    assert spark.createDataFrame([(html,)], "html string").select(M.tokens("html")).first()[0] == tokens


def test_long_pages_need_no_deep_stack(spark):
    """Many attributes, stray signs and siblings, deep nesting, one long text."""
    html = ("<a " + "x='1' " * 3000 + ">") + "< " * 20000 + "<!--" + "<" * 50000 + "-->" + "t" * 300000 + "<b>" * 800 + "</b>" * 800 + "</a>"
    row = spark.createDataFrame([(html,)], "html string").select(M.tokens("html").alias("t")).select(M.elements("t").alias("e"), F.size("t").alias("n")).first()
    assert len(row["e"]) == 801 and row["e"][0]["end"] == row["n"] - 1 and row["e"][800]["end"] - row["e"][800]["at"] == 1


def test_last_of_repeated_attributes_and_bare_ones(spark):
    df = spark.createDataFrame([("<a href=x HREF='y' title hrefs=z data-title='q' class=\"a\tb\nc\">",)], "t string")
    row = df.select(M.attribute(F.col("t"), "href"), M.attribute(F.col("t"), "title"), M.attribute(F.col("t"), "rel"), M.classes(F.col("t"))).first()
    assert tuple(row) == ("y", "", None, ["a", "b", "c"])


def test_steps_of_a_path_are_looked_up_once(spark):
    """Each step within the one before: not again for every element of the next."""
    n = 150
    html = '<ul class="nav nav-list">' + '<ul><li><a href="x">y</a></li></ul>' * n + "</ul>" + "<ul><li><a>no</a></li></ul>" * n
    df = spark.createDataFrame([(html,)], "html string").select(M.tokens("html").alias("t")).select("t", M.elements("t").alias("e"))
    start = time.monotonic()
    assert df.select(F.size(M.select(F.col("t"), F.col("e"), "ul.nav.nav-list ul li a"))).first()[0] == n
    assert time.monotonic() - start < 30


def test_all_classes_are_asked_for(spark):
    tags = ['<ul class="nav-list nav">', '<ul class="nav">', '<ul class="nav-list">', '<ul id="nav nav-list">', '<ul class="nav navx-list" title="nav-list">', None]
    df = spark.createDataFrame(list(enumerate(tags)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(M.has_classes(F.col("t"), "nav", "nav-list")).collect()]
    assert got[:5] == [True, False, False, False, False] and not got[5]
