"""Text of web pages: the main container without chrome, one line for each text node."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.text import strip

# Elements without content; elements whose text never counts; where the main content
# is looked for, in order; what is dropped inside it.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr basefont bgsound command frame image isindex nextid spacer".split())
SILENT = frozenset(["script", "style", "noscript"])
CONTAINERS = ["div.mw-parser-output", "[role=main]", "main", "article", "div.body", "div.document", ".md-content", ".rst-content", "body"]
DROPPED = [
    ".reference", ".mw-editsection", "table.navbox", ".navbox", ".vertical-navbox", ".reflist", "#toc", ".toc",
    ".navigation-not-searchable", ".hatnote", ".ambox", "table.ambox", ".mbox-small", ".metadata", ".sistersitebox",
    ".shortdescription", ".noprint", ".mw-empty-elt", ".mw-jump-link", "#References", "#External_links",
    "#Further_reading", "#See_also", "nav", "header", "footer", ".sphinxsidebar", ".wy-nav-side", ".toctree-wrapper",
    ".headerlink", ".md-sidebar", ".md-header", ".md-footer", ".rst-footer-buttons", ".related", "#searchbox",
    ".breadcrumbs", ".wy-breadcrumbs", "[role=navigation]",
]
_SELECTOR = re.compile(r"([a-z0-9]*)(?:\.([\w-]+)|#([\w-]+)|\[(\w+)=([\w-]+)\])?\Z")
#: Breaks that end a line of text, a carriage return with its line feed as one.
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []

    def fits(self, selector: tuple) -> bool:
        tag, cls, ident, name, value = selector
        if tag and tag != self.tag:
            return False
        if cls and cls not in (self.attributes.get("class") or "").split():
            return False
        if ident and self.attributes.get("id") != ident:
            return False
        return not name or self.attributes.get(name) == value


class _Builder(HTMLParser):
    """A tree in which an end tag closes up to its start tag, and nothing else closes by itself."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.data = []

    def end_text(self, *_):
        """Ends a text node, as tags, comments and declarations do; a "<" that opens none of them does not."""
        if self.data:
            self.open[-1].children.append("".join(self.data))
            self.data = []

    handle_comment = handle_decl = handle_pi = unknown_decl = end_text

    def handle_starttag(self, tag, attrs):
        self.end_text()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.end_text()
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        self.end_text()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open[-1].tag not in SILENT:
            self.data.append(data)

    def close(self):
        super().close()
        self.end_text()


_WHERE = [_SELECTOR.match(s).groups() for s in CONTAINERS]
_GONE = [_SELECTOR.match(s).groups() for s in DROPPED]


def _walk(node: Node):
    """All elements below a node but those whose text never counts, in document order, without recursion."""
    stack = list(reversed(node.children))
    while stack:
        x = stack.pop()
        if isinstance(x, Node) and x.tag not in SILENT:
            yield x
            stack.extend(reversed(x.children))


def text_of(page: str) -> str:
    """The page's text, a line feed between text nodes."""
    builder = _Builder()
    builder.feed(page)
    builder.close()
    elements = list(_walk(builder.root))
    main = next((x for selector in _WHERE for x in elements if x.fits(selector)), builder.root)
    out, stack = [], list(reversed(main.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag not in SILENT and not any(x.fits(s) for s in _GONE):
            stack.extend(reversed(x.children))
    return "\n".join(out)


def lines_kept(text: Column) -> Column:
    """Lines stripped, blank runs as one blank line, none at either end."""
    lines = F.transform(F.split(text, LINE_BREAK, -1), strip)
    kept = F.filter(lines, lambda x, i: (x != "") | ((i > 0) & (F.get(lines, i - 1) != "")))
    return F.btrim(F.array_join(kept, "\n"), F.lit("\n"))


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The frame with text, the page's readable text; null pages give the empty text."""

    @F.pandas_udf("string")
    def raw_text(column: pd.Series) -> pd.Series:
        return column.map(lambda p: text_of(p or ""))

    raw = pages.withColumn("_raw", raw_text(F.col(html_col)))
    return raw.withColumn("text", lines_kept(F.col("_raw"))).drop("_raw")


def links(pages: DataFrame, id_col: str, html_col: str = "html") -> DataFrame:
    """id, n, href of the page's links in order, entities resolved for ampersands."""
    found = F.regexp_extract_all(F.col(html_col), F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))
    return pages.select(F.col(id_col), F.posexplode(found).alias("n", "href")).withColumn("href", F.replace("href", F.lit("&amp;"), F.lit("&")))
