"""Pages that describe one thing, as nested values: a tree of elements and paths into it.

Broken pages are read as they stand: an end tag closes what is open inside its element,
one that nothing opened is passed over, and what the page leaves open ends with it.
"""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import unquote_plus, urljoin, urlsplit

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .parsing import markdown_of

# Elements without content, and those that an element of the same kind ends.
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
SELF_ENDING = frozenset("li p option tr td th dt dd".split())

# Where a page has its parts.
PLACES = {
    "copied_name": "#content h1 #copy-link", "shown_name": "#content h1 span", "info": "section#tag-info-wrapper", "cover_link": "#tag-cover-wrapper a", "cover_image": "#tag-cover",
    "socials": "#socials > a", "description": "#description", "aliases": "#aliases ul li", "related": "#tags li", "outfits": "#outfits li",
}

_TEXT, _TEXTS = T.StringType(), T.ArrayType(T.StringType())
_SOCIAL = T.StructType([T.StructField("type", _TEXT), T.StructField("url", _TEXT)])
_ALIAS = T.StructType([T.StructField("name", _TEXT), T.StructField("type", _TEXT), T.StructField("is_language", T.BooleanType())])
_COVER = T.StructType([T.StructField("image_id", T.LongType()), T.StructField("image_url", _TEXT)])
PAGE = T.StructType([
    T.StructField("name", _TEXT), T.StructField("category", _TEXT), T.StructField("raw_category", _TEXT), T.StructField("cover", _COVER), T.StructField("socials", T.ArrayType(_SOCIAL)), T.StructField("description_md", _TEXT),
    T.StructField("aliases", T.ArrayType(_ALIAS)), T.StructField("langs", T.MapType(_TEXT, _TEXT)), T.StructField("related_tags", _TEXTS), T.StructField("outfit_tags", _TEXTS),
])


@functools.lru_cache(maxsize=1024)
def _steps(path: str) -> list[tuple]:
    """The steps of a path: whether directly below, the tag, ids and classes."""
    made, direct = [], False
    for step in path.split():
        if step != ">":
            marks = re.findall(r"([#.])([^#.]+)", step)
            of = lambda kind, marks=marks: frozenset(m for k, m in marks if k == kind)
            made.append((direct, re.match(r"[^#.]*", step).group(), of("#"), of(".")))
        direct = step == ">"
    return made


@dataclass
class Element:
    tag: str
    attrs: dict = field(default_factory=dict)
    inside: list = field(default_factory=list)
    #: All elements of the page in its order; this one's place there, and where what is below it ends.
    page: list = field(default_factory=list, repr=False, compare=False)
    at: int = -1
    end: int | None = None

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def elements(self) -> list[Element]:
        """All elements below, in the page's order."""
        return self.page[self.at + 1 : self.end]

    def text(self) -> str:
        """The text below with blanks collapsed."""
        parts: list[str] = []
        waiting: list = [self]
        while waiting:
            x = waiting.pop()
            if isinstance(x, Element):
                waiting.extend(reversed(x.inside))
            else:
                parts.append(x)
        return " ".join("".join(parts).split())

    def inner_html(self) -> str:
        """What is below, as HTML."""
        out: list[str] = []
        waiting: list = list(reversed(self.inside))
        while waiting:
            x = waiting.pop()
            if isinstance(x, tuple):
                out.append(x[0])
            elif isinstance(x, Element):
                given = "".join(f' {k}="{html.escape(v or "")}"' for k, v in x.attrs.items())
                out.append(f"<{x.tag}{given}>")
                if x.tag not in EMPTY:
                    waiting.append((f"</{x.tag}>",))
                    waiting.extend(reversed(x.inside))
            else:
                out.append(html.escape(x, quote=False))
        return "".join(out)

    def find(self, path: str) -> list[Element]:
        """Elements at a path such as ``section#info h2.kind > a``: tags, ids, classes; below, or directly below."""
        found = [self]
        for direct, tag, ids, classes in _steps(path):
            seen: dict[int, Element] = {}
            for f in found:
                for e in (x for x in f.inside if isinstance(x, Element)) if direct else f.elements():
                    if (not tag or e.tag == tag) and (not ids or ids == {e.attrs.get("id")}) and (not classes or classes.issubset(e.classes)):
                        seen.setdefault(id(e), e)
            found = list(seen.values())
        return found

    def first(self, path: str) -> Element | None:
        return next(iter(self.find(path)), None)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.page: list[Element] = []
        self.open = [Element("", page=self.page)]

    def _close(self, at: int) -> None:
        for x in self.open[at:]:
            x.end = len(self.page)
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in SELF_ENDING and self.open[-1].tag == tag:
            self._close(-1)
        made = Element(tag, {k: v for k, v in reversed(attrs)}, page=self.page, at=len(self.page))  # of repeated attributes the first counts
        self.page.append(made)
        self.open[-1].inside.append(made)
        if tag not in EMPTY:
            self.open.append(made)
        else:
            made.end = len(self.page)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag), 0)
        if at:
            self._close(at)

    def handle_data(self, data):
        self.open[-1].inside.append(data)


def tree(text: str) -> Element:
    builder = _Builder()
    builder.feed(text)
    builder.close()
    return builder.open[0]


def _joined(base: str, link: str | None) -> str | None:
    if link is None:
        return None
    try:
        return urljoin(base, link)
    except ValueError:  # no address at all
        return None


def _last_segment(base: str, link: str | None) -> str | None:
    whole = _joined(base, link)
    return None if whole is None else urlsplit(whole).path.split("/")[-1]


def _linked(page: Element, path: str, base: str) -> list[str]:
    """Names at the end of the links of a list; what only leads to more is left out."""
    links = [a.attrs.get("href") if (a := li.first("a")) else None for li in page.find(path) if "more" not in li.classes]
    return [unquote_plus(s) for s in (_last_segment(base, x) for x in links) if s is not None]


def entity_of(text: str | None, base: str, places: dict[str, str] = PLACES) -> tuple | None:
    """A page's values in the order of PAGE; null for a page without its main section."""
    page = tree(text or "")
    info = page.first(places["info"])
    if info is None or not info.inner_html().strip():
        return None
    copied, shown = page.first(places["copied_name"]), page.first(places["shown_name"])
    name = copied.attrs.get("data-value") if copied else shown.text() if shown else None
    head = info.first("h2")
    raw = head.attrs["class"].strip() if head and head.attrs.get("class") else None
    category = raw if raw and len(raw.split()) == 1 and "," not in raw else "unknown"
    link, image = page.first(places["cover_link"]), page.first(places["cover_image"])
    number = _last_segment(base, link.attrs.get("href")) if link else None
    cover = (int(number) if number and re.fullmatch(r"[0-9]{1,18}", number) else None, _joined(base, image.attrs.get("src")) if image else None)
    socials = []
    for a in page.find(places["socials"]):
        mark, url = a.first("s"), _joined(base, a.attrs.get("href"))
        if mark and mark.classes and url is not None:
            socials.append((mark.classes[-1], url))
    described = page.first(places["description"])
    aliases, langs = [], {}
    for li in page.find(places["aliases"]):
        if li.classes:
            kind, said = li.first("i"), li.first("span")
            kind = kind.text() if kind else ""
            alias = said.attrs.get("data-value") if said else None
            aliases.append((alias, kind, "language" in li.classes))
            if "language" in li.classes:
                langs.setdefault(kind, alias)
    return name, category, raw, cover, socials, markdown_of(described.inner_html(), base) if described else "", aliases, langs, _linked(page, places["related"], base), _linked(page, places["outfits"], base)


@F.pandas_udf(PAGE)
def html_page(body: pd.Series, base: pd.Series) -> pd.DataFrame:
    """The nested value of an entity page; all fields null where there is none."""
    nothing = (None,) * len(PAGE)
    return pd.DataFrame([entity_of(t, b or "") or nothing for t, b in zip(body, base, strict=True)], columns=PAGE.names)


#: Else a filter on a page's value is pushed below it, and each page is read twice.
html_page = html_page.asNondeterministic()
