"""HTML extraction by site template removal.

Pages are parsed into element trees. Every element below the body has a hash over its subtree (tag, class, id, text and
children). In Spark the hashes are counted per host, by distinct articles: a marked article is told by its longest text, so
that copies of one, which share true paragraphs, count once; a page that marks none by all its text. A subtree that at least MIN_ARTICLES articles and SHARE of all
articles of a host have is template: it is deleted from every page of the host that has it, inside an article as outside.
Elements whose tag, role, class or id names a part that is never main text (navigation, headers, footers, sidebars,
notices, adverts, forms, comments) are deleted everywhere, as some of them, like adverts, change from page to page. Within an
article a name must be the whole class or id, or made up of such words and words for a box; headings, and headers that
have one, stay. What remains of the article (or of the body, if a page marks none) is cut into blocks.

Only hashes move between pages. The subtrees to delete beyond the named parts are few; they are written per page, and
Spark joins them to the pages by their size: broadcast if small, else by page.

Defined cases: null or empty html, or a page that is all template, has the empty text. Markup that ends early is closed.
A null url is one host of its own name. Repeated pages count as pages. A null page_id is extracted by the named parts alone.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import staged

MIN_ARTICLES, SHARE = 3, 0.6

# Fixed values of HTML.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template"))
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
))
#: Elements an opening tag closes, if one of them is the innermost open block.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDS_P = BLOCKS - {"html", "body"}
#: Parts that are never main text, by tag, by role, and by a word of class or id.
DROPPED_TAGS = frozenset((
    "aside", "button", "canvas", "dialog", "footer", "form", "head", "header", "iframe", "input", "menu", "nav", "noscript", "object", "script", "select",
    "style", "svg", "template", "textarea", "title", "video", "audio",
))
DROPPED_ROLES = frozenset(("alert", "banner", "complementary", "contentinfo", "dialog", "navigation", "search"))
DROPPED_NAMES = frozenset((
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "footer", "header", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "share",
    "sharing", "sidebar", "social", "sponsored", "subscribe", "toolbar", "widget",
))
#: Words for a box, which add nothing to the name of a part.
BOX_NAMES = frozenset((
    "area", "bar", "block", "body", "bottom", "box", "buttons", "container", "content", "form", "group", "inner", "item", "left", "link", "links", "list",
    "outer", "panel", "post", "right", "section", "signup", "site", "slot", "thread", "top", "unit", "wrap", "wrapper",
))
COMMENT_NAMES = frozenset(("comment", "comments", "replies", "reply"))
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?:/?[a-zA-Z])[^>]*\Z", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Za-z]+|[0-9]+")


class Element:
    __slots__ = ("tag", "names", "role", "children", "hash")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.names, self.role, self.children, self.hash = tag, "", "", [], 0
        for m in _ATTRIBUTE.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "role":
                self.role = value.strip().lower()
            else:
                self.names += " " + value

    def dropped(self, inside: bool = False) -> bool:
        """Whether this part is never main text, by name; ``inside``: it stands within the marked main text."""
        if self.tag == "header" and inside and self.has_heading():
            return False
        if self.tag in DROPPED_TAGS or self.role in DROPPED_ROLES:
            return True
        if self.tag in ("html", "body", "main"):
            return False
        words = {w.lower() for w in _WORD.findall(self.names)}
        if self.tag == "article":
            return not words.isdisjoint(COMMENT_NAMES)
        if not inside:
            return not words.isdisjoint(DROPPED_NAMES)
        if self.tag in HEADINGS:
            return False
        for name in self.names.lower().split():
            parts = {w for w in _WORD.findall(name) if not w.isdigit()}
            if not parts.isdisjoint(DROPPED_NAMES) and parts <= DROPPED_NAMES | BOX_NAMES:
                return True
        return False

    def has_heading(self) -> bool:
        stack = [self]
        while stack:
            e = stack.pop()
            if e.tag in HEADINGS:
                return True
            stack += [c for c in e.children if isinstance(c, Element)]
        return False

    def hashed(self) -> int:
        """Set and return the hash of the subtree; a signed 64-bit number. Deep trees are walked without recursion."""
        order, stack = [], [self]
        while stack:
            e = stack.pop()
            order.append(e)
            stack += [c for c in e.children if isinstance(c, Element)]
        for e in reversed(order):
            parts = [e.tag, e.names, *(" ".join(c.split()) if isinstance(c, str) else str(c.hash) for c in e.children)]
            e.hash = xxhash.xxh3_64_intdigest("\0".join(parts).encode("utf-8", "replace")) - (1 << 63)
        return self.hash


def parsed(page: str) -> Element:
    """The element tree of a page, with the ends that HTML lets one leave out."""
    root = Element("html")
    stack, at, n = [root], 0, len(page)
    while at < n:
        m = _MARK.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if any(e.tag == tag for e in stack[1:]):
                while stack.pop().tag != tag:
                    pass
            continue
        if tag in ("html", "body") and stack[-1].tag in ("html", "body") and tag == "html":
            continue
        closed = CLOSES.get(tag, ("p",) if tag in ENDS_P else ())
        if closed:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closed:
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS:
                    break
        element = Element(tag, m[3])
        stack[-1].children.append(element)
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at)
            if tag in ("textarea", "title"):
                element.children.append(page[at : end.start()])
            at = end.end()
            continue
        stack.append(element)
    return root


def content(root: Element) -> tuple[list[Element], bool]:
    """The outermost elements that hold the main text, and whether the page marks them."""
    for tag in ("article", "main"):
        found, stack = [], [root]
        while stack:
            e = stack.pop()
            if (e.tag == tag and not e.dropped()) or (tag == "main" and e.role == "main"):
                found.append(e)
            elif not e.dropped():
                stack += [c for c in reversed(e.children) if isinstance(c, Element)]
        if found:
            return found, True
    return [root], False


def _walk(root: Element) -> Iterator[tuple[Element, bool]]:
    """(element, inside the marked main text) of all elements that are not dropped by name."""
    parts, marked = content(root)
    inner = {id(e) for e in parts} if marked else set()
    stack = [(root, False)]
    while stack:
        e, inside = stack.pop()
        if not e.dropped(inside):
            yield e, inside
            inside = inside or id(e) in inner
            stack += [(c, inside) for c in e.children if isinstance(c, Element)]


def subtrees(root: Element) -> Iterator[tuple[int, bool]]:
    """(hash, inside the marked main text) of each element that is not dropped by name and has text or children."""
    root.hashed()
    for e, inside in _walk(root):
        if e is not root and e.tag not in ("html", "body", "article", "main") and e.children:
            yield e.hash, inside


def article_of(root: Element) -> int:
    """What tells articles apart: a hash of the longest text of the marked main part, or of all text if a page marks none."""
    parts, marked = content(root)
    inner = {id(e) for e in parts}
    texts = [" ".join(c.split()) for e, inside in _walk(root) if inside or not marked or id(e) in inner for c in e.children if isinstance(c, str)]
    told = max(texts, key=lambda t: (len(t), t), default="") if marked else "\n".join(texts)
    return xxhash.xxh3_64_intdigest(told.encode("utf-8", "replace")) - (1 << 63)


def main_text(root: Element, deleted: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the main text, without the subtrees deleted, joined by an empty line."""
    blocks, held = [], []

    def close():
        text = " ".join(entities.unescape("".join(held)).split(" \t\n\r\x0b\x0c") if False else re.split(r"[\s ]+", entities.unescape("".join(held)))).strip()
        if text:
            blocks.append(text)
        held.clear()

    parts, inside = content(root)
    stack: list = list(reversed(parts))
    while stack:
        e = stack.pop()
        if e is None:
            close()
        elif isinstance(e, str):
            held.append(e)
        elif e.tag == "br":
            held.append(" ")
        elif not (e.dropped(inside) or e.hash in deleted):
            if e.tag in BLOCKS:
                close()
                stack.append(None)
            stack += reversed(e.children)
    close()
    return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def template_subtrees(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, gone): the subtrees to delete from a page because its host repeats them."""

    def run(batches):
        for batch in batches:
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for page_id, host, text in zip(*(batch.column(c).to_pylist() for c in ("page_id", "host", "html"))):
                root = parsed(text or "")
                own = [None, *dict.fromkeys(h for h, _ in subtrees(root))]  # a null hash stands for the page itself
                for column, values in zip(rows, ([page_id] * len(own), [host] * len(own), [article_of(root)] * len(own), own)):
                    column.extend(values)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], ["page_id", "host", "article", "hash"])

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    found = staged(source.mapInArrow(run, "page_id long, host string, article long, hash long"), "subtrees")
    # Distinct articles with a subtree: first one row for each, which a task does for its own rows before the shuffle.
    counts = found.select("host", "hash", "article").distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.where("hash is null").select("host", F.col("n").alias("articles"))
    repeated = counts.where((F.col("hash").isNotNull()) & (F.col("n") >= MIN_ARTICLES)).join(sizes, "host").where(F.col("n") >= SHARE * F.col("articles"))
    repeated = staged(repeated.select("host", "hash"), "templates")
    hits = found.join(repeated, ["host", "hash"])
    return staged(hits.groupBy("page_id").agg(F.collect_set("hash").alias("gone")).withColumnRenamed("page_id", "gone_id"), "deleted")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages``."""
    gone = template_subtrees(pages, id_col, url_col, html_col)

    @F.pandas_udf("string")
    def extract(texts, deleted):
        import pandas as pd

        out = []
        for text, hashes in zip(texts, deleted):
            root = parsed(text or "")
            if hashes is not None and len(hashes):
                root.hashed()
                out.append(main_text(root, set(np.asarray(hashes).tolist())))
            else:
                out.append(main_text(root))
        return pd.Series(out, dtype=object)

    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    joined = source.join(gone, source.page_id.cast("long") == gone.gone_id, "left")
    done = joined.select("page_id", "url", extract("html", "gone").alias("text"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
