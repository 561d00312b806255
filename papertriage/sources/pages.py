"""Stored web pages ``(page_id, url, html)``: field extraction.

Two paths:

* regex fast path (``regexp_extract``/``regexp_extract_all``), JVM side, for
  fixed markup such as the first ``<h1>`` or ``<a href>`` lists;
* ``extract_fields``: an Arrow-batched pandas UDF over the standard-library
  ``html.parser`` for pages that are not well formed (``xpath_*`` needs XML),
  entity decoding and selector rules (tag, id, classes).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import py_strip, strip_label_prefix
from ..session import bound_arrow_batches

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# Fixed regex rules for the fast path.
H1_PATTERN = r"(?s)<h1[^>]*>(.*?)</h1>"
TITLE_PATTERN = r"(?s)<title[^>]*>(.*?)</title>"
ANCHOR_PATTERN = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a\s*>"""
NEXT_PATTERN = r'<a\s(?:[^>]*\s)?(?:rel|class)="(?:[^"]*\s)?next(?:\s[^"]*)?"[^>]*>'
HREF_PATTERN = r'\shref="([^"]*)"'
LANG_PATTERN = r'<html[^>]*lang="([A-Za-z-]+)"'


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_h1_raw(html: Column | str) -> Column:
    """H7 fast path: inner markup of the first ``<h1>``; NULL when absent."""
    return F.nullif(F.regexp_extract(_c(html), H1_PATTERN, 1), F.lit(""))


def next_page_url(html: Column | str) -> Column:
    """H9: ``href`` of the first link with ``next`` among its ``rel`` or
    ``class`` words, attributes in any order; NULL when there is none."""
    return F.nullif(F.regexp_extract(F.regexp_extract(_c(html), NEXT_PATTERN, 0), HREF_PATTERN, 1), F.lit(""))


def page_lang(html: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(html), LANG_PATTERN, 1), F.lit(""))


def anchors(html: Column | str) -> Column:
    """H8 fast path: ``array<struct<href, text>>`` of the anchors in order, with
    any other attributes and quoting; markup inside the text is left out."""
    whole = F.regexp_extract_all(_c(html), F.lit(ANCHOR_PATTERN), F.lit(0))

    def fields(a):
        href = F.concat(*(F.regexp_extract(a, ANCHOR_PATTERN, k) for k in (1, 2, 3)))
        text = F.regexp_replace(F.regexp_extract(a, ANCHOR_PATTERN, 4), r"(?s)<[^>]*>", "")
        return F.struct(href.alias("href"), text.alias("text"))

    return F.transform(whole, fields)


# --- html.parser extraction -------------------------------------------------


@dataclass(frozen=True)
class Selector:
    """``tag`` / ``#id`` / ``.class`` rule; ``skip`` tags are left out of the
    element's text (their text, not their tail)."""

    tag: str | None = None
    id: str | None = None
    classes: tuple[str, ...] = ()
    skip: tuple[str, ...] = ()

    def matches(self, tag: str, attrs: dict) -> bool:
        if self.tag and tag != self.tag:
            return False
        if self.id and attrs.get("id") != self.id:
            return False
        if self.classes:
            have = set((attrs.get("class") or "").split())
            if not set(self.classes) <= have:
                return False
        return True


@dataclass(frozen=True)
class PageRules:
    title: Selector
    abstract: Selector
    # optional inner element preferred over the abstract element's own text (H6)
    abstract_inner: Selector | None = None
    # container whose anchors are the listing; None = every anchor
    links_in: Selector | None = None
    strip_abstract_label: bool = False
    # text as a browser shows it: line breaks and block elements end a line
    rendered: bool = False


# Selector rules of the three page layouts, plus the layout of
# the stored test pages.
RULES = {
    "generic": PageRules(title=Selector("h1"), abstract=Selector("article", skip=("h1",)), links_in=Selector("nav")),
    "aaai": PageRules(
        title=Selector("h1", classes=("page_title",)),
        abstract=Selector("section", classes=("item", "abstract")),
        abstract_inner=Selector("div"),
        links_in=Selector("h3", classes=("title",)),
        strip_abstract_label=True,
    ),
    "cvf": PageRules(title=Selector(id="papertitle"), abstract=Selector(id="abstract"), links_in=Selector("dt"), rendered=True),
    "eccv": PageRules(title=Selector("h1"), abstract=Selector(id="abstractExample"), links_in=Selector(id="paperlist"), rendered=True),
}

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_RAW_SKIP = {"script", "style"}
_LINE_END = set("br hr p div section article header footer ul ol li dl dt dd table tr h1 h2 h3 h4 h5 h6 blockquote pre".split())


class _Extractor(HTMLParser):
    """Single pass over one page: first title element, first abstract
    element (and its first inner element), anchors."""

    def __init__(self, rules: PageRules):
        super().__init__(convert_charrefs=True)
        self.rules = rules
        self.stack: list[str] = []
        self.targets: dict[str, dict] = {}
        self.links: list[tuple[str, str | None]] = []
        self._anchor: dict | None = None
        self._links_depth: int | None = None
        self.next_url: str | None = None

    def _open_target(self, name: str, sel: Selector | None, tag: str, attrs: dict) -> None:
        if sel is None or name in self.targets:
            return
        if sel.matches(tag, attrs):
            self.targets[name] = {"depth": len(self.stack), "parts": [], "skip_depth": None, "sel": sel, "open": True}

    def _end_line(self, tag: str) -> None:
        if self.rules.rendered and tag in _LINE_END:
            for t in self.targets.values():
                if t["open"] and t["skip_depth"] is None:
                    t["parts"].append("\n")

    def handle_starttag(self, tag, attrs):
        a = {k: (v or "") for k, v in attrs}
        self._end_line(tag)
        if tag in _VOID:
            return
        self.stack.append(tag)
        self._open_target("title", self.rules.title, tag, a)
        self._open_target("abstract", self.rules.abstract, tag, a)
        if "abstract" in self.targets and self.targets["abstract"]["open"] and self.rules.abstract_inner:
            if len(self.stack) > self.targets["abstract"]["depth"]:
                self._open_target("inner", self.rules.abstract_inner, tag, a)
        for t in self.targets.values():
            if t["open"] and t["skip_depth"] is None and (tag in t["sel"].skip or tag in _RAW_SKIP):
                t["skip_depth"] = len(self.stack)
        if self.rules.links_in is not None and self._links_depth is None and self.rules.links_in.matches(tag, a):
            self._links_depth = len(self.stack)
        if tag == "a":
            marks = a.get("rel", "").split() + a.get("class", "").split()
            if "next" in marks and self.next_url is None:
                self.next_url = a.get("href")
            in_scope = self.rules.links_in is None or self._links_depth is not None
            self._anchor = {"href": a.get("href"), "parts": []} if in_scope else None

    def handle_endtag(self, tag):
        if tag not in self.stack:
            return
        while self.stack:
            depth = len(self.stack)
            top = self.stack.pop()
            for t in self.targets.values():
                if t["open"] and t["skip_depth"] == depth:
                    t["skip_depth"] = None
                if t["open"] and t["depth"] == depth:
                    t["open"] = False
            if self._links_depth == depth:
                self._links_depth = None
            if top == "a" and self._anchor is not None:
                self.links.append(("".join(self._anchor["parts"]), self._anchor["href"]))
                self._anchor = None
            self._end_line(top)
            if top == tag:
                break

    def handle_data(self, data):
        raw = self.stack and self.stack[-1] in _RAW_SKIP
        for t in self.targets.values():
            if t["open"] and t["skip_depth"] is None and not raw:
                t["parts"].append(data)
        if self._anchor is not None and not raw:
            self._anchor["parts"].append(data)

    def text(self, name: str) -> str | None:
        t = self.targets.get(name)
        return None if t is None else "".join(t["parts"])


def extract_page(html: str | None, rules: PageRules) -> dict:
    """Raw texts and links of one page (the UDF's per-row step)."""
    if html is None:
        return dict.fromkeys(PAGE_PARTS.names)
    p = _Extractor(rules)
    p.feed(html)
    p.close()
    if p._anchor is not None:
        p.links.append(("".join(p._anchor["parts"]), p._anchor["href"]))
    links = [{"pos": i + 1, "text": t, "href": h} for i, (t, h) in enumerate(p.links)]
    return {"title": p.text("title"), "section": p.text("abstract"), "inner": p.text("inner"), "links": links, "next_url": p.next_url}


PAGE_PARTS = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("section", T.StringType()),
        T.StructField("inner", T.StringType()),
        T.StructField(
            "links",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("pos", T.IntegerType()),
                        T.StructField("text", T.StringType()),
                        T.StructField("href", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("next_url", T.StringType()),
    ]
)


def extract_fields(html: Column | str, layout: str = "generic") -> Column:
    """``struct<title, abstract, links, next_url>`` per page, parsed with
    ``html.parser`` inside an Arrow-batched pandas UDF; stripping and the
    label rule (H6) are column functions on its raw texts.

    The session's Arrow batch is lowered, so that a worker holds the pages and
    parts of one small batch, whatever a partition's size."""
    rules = RULES[layout]
    bound_arrow_batches(SparkSession.active())

    @F.pandas_udf(PAGE_PARTS)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([extract_page(h, rules) for h in s], columns=PAGE_PARTS.names)

    def clean(f: Column) -> Column:
        section = strip_label_prefix(f["section"]) if rules.strip_abstract_label else py_strip(f["section"])
        abstract = F.coalesce(py_strip(f["inner"]), section)
        return F.struct(py_strip(f["title"]).alias("title"), abstract.alias("abstract"), f["links"].alias("links"), f["next_url"].alias("next_url"))

    # evaluated once where written (see operators.score.similarity_struct): the
    # lambda's argument, which it may read more than once
    return F.transform(F.array(parse.asNondeterministic()(_c(html))), clean)[0]
