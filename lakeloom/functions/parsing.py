"""Parsers that SQL lacks, as Arrow-batched functions; used on the rows that need them."""

from __future__ import annotations

import html
import json
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types as objects: a worker that imports this module has no session to read type names with.
TEXT, TEXTS = T.StringType(), T.ArrayType(T.StringType())
LINKS = T.ArrayType(T.StructType([T.StructField("href", TEXT), T.StructField("label", TEXT)]))
ROWS = T.ArrayType(T.MapType(TEXT, TEXT))
ENTITY = T.StructType([T.StructField("title", TEXT), T.StructField("category", TEXT), T.StructField("images", TEXTS), T.StructField("items", TEXTS)])


@F.pandas_udf(TEXT)
def html_unescape(text: pd.Series) -> pd.Series:
    """Entities to characters."""
    return text.map(lambda t: None if t is None else html.unescape(t))


@F.pandas_udf(TEXT)
def absolute_url(base: pd.Series, link: pd.Series) -> pd.Series:
    """``link`` resolved against ``base``."""
    return pd.Series([None if b is None or k is None else urljoin(b, k) for b, k in zip(base, link, strict=True)])


#: What may follow a quote that ends a string.
_AFTER = re.compile(r"\s*(?:[,}\]:]|$)")


def repair_quotes(body: str) -> str:
    """``body`` with quotes inside string values escaped: a quote ends a string only before , } ] or :."""
    out, inside, at = [], False, 0
    while at < len(body):
        c = body[at]
        if c == "\\" and inside:
            out.append(body[at : at + 2])
            at += 2
            continue
        if c == '"':
            if not inside:
                inside = True
            elif _AFTER.match(body, at + 1):
                inside = False
            else:
                out.append("\\")
        out.append(c)
        at += 1
    return "".join(out)


def _object_text(body: str | None) -> str | None:
    if not body or not body.strip() or body.lstrip().startswith("<"):
        return None
    for candidate in (body, None):
        try:
            found = json.loads(candidate if candidate is not None else repair_quotes(body))
        except (ValueError, RecursionError):
            continue
        return json.dumps(found) if isinstance(found, dict) and found else None
    return None


@F.pandas_udf(TEXT)
def lenient_object(body: pd.Series) -> pd.Series:
    """The body as strict JSON text of a non-empty object, repaired if need be; else null."""
    return body.map(_object_text)


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.links: list[tuple[str, str]] = []
        self.href: str | None = None
        self.words: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.href, self.words = dict(attrs).get("href"), []

    def handle_data(self, data):
        if self.href is not None:
            self.words.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            self.links.append((self.href, "".join(self.words).strip()))
            self.href = None


@F.pandas_udf(LINKS)
def html_links(body: pd.Series) -> pd.Series:
    """All links of a page with their text, in order."""

    def parse(text):
        p = _Links()
        p.feed(text or "")
        return [{"href": h, "label": t} for h, t in p.links]

    return body.map(parse)


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append("".join(self.cell).strip())
            self.cell = None


@F.pandas_udf(ROWS)
def html_table(body: pd.Series) -> pd.Series:
    """Rows of a page's tables by the names of the header row."""

    def parse(text):
        p = _Tables()
        p.feed(text or "")
        if not p.rows:
            return []
        head, *rows = p.rows
        return [dict(zip(head, row, strict=False)) for row in rows if row]

    return body.map(parse)


class _Entity(HTMLParser):
    """A page that describes one thing: title, class of the h2, links, list items, images."""

    def __init__(self) -> None:
        super().__init__()
        self.stack: list[str] = []
        self.title: list[str] = []
        self.category: str | None = None
        self.images: list[str] = []
        self.items: list[str] = []
        self.item: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        found = dict(attrs)
        if tag == "h2" and self.category is None:
            classes = (found.get("class") or "").split()
            self.category = classes[0] if len(classes) == 1 and "," not in classes[0] else "unknown"
        if tag == "img" and found.get("src"):
            self.images.append(found["src"])
        elif tag == "li":
            self.item = []
        if tag not in ("img", "meta", "br", "link", "input", "hr"):
            self.stack.append(tag)

    def handle_data(self, data):
        if self.stack and self.stack[-1] == "h1":
            self.title.append(data)
        if self.item is not None:
            self.item.append(data)

    def handle_endtag(self, tag):
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass
        if tag == "li" and self.item is not None:
            self.items.append("".join(self.item).strip())
            self.item = None


@F.pandas_udf(ENTITY)
def html_entity(body: pd.Series) -> pd.DataFrame:
    """Title, category, images and list items of an entity page."""
    rows = []
    for text in body:
        p = _Entity()
        p.feed(text or "")
        rows.append(("".join(p.title).strip() or None, p.category, p.images, p.items))
    return pd.DataFrame(rows, columns=["title", "category", "images", "items"])


class _Markdown(HTMLParser):
    def __init__(self, base: str) -> None:
        super().__init__()
        self.base, self.out, self.href = base, [], None

    def handle_starttag(self, tag, attrs):
        found = dict(attrs)
        if tag == "a":
            self.href = urljoin(self.base, found.get("href") or "")
            self.out.append("[")
        elif tag == "img":
            self.out.append(f"![{found.get('alt') or ''}]({urljoin(self.base, found.get('src') or '')})")
        elif tag in ("p", "div", "br"):
            self.out.append("\n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "li":
            self.out.append("\n* ")

    def handle_data(self, data):
        self.out.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            self.out.append(f"]({self.href})")
            self.href = None
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag in ("p", "div"):
            self.out.append("\n")


def markdown_of(text: str, base: str) -> str:
    """Markdown with absolute links; runs of blank lines become one."""
    p = _Markdown(base)
    p.feed(text)
    return re.sub(r"\n{3,}", "\n\n", "".join(p.out)).strip()


@F.pandas_udf(TEXT)
def html_to_markdown(body: pd.Series, base: pd.Series) -> pd.Series:
    """``markdown_of`` each body."""
    return pd.Series([None if t is None else markdown_of(t, b or "") for t, b in zip(body, base, strict=True)])
