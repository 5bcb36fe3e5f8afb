"""The raw web pages against a second, plain reading of them by patterns."""

import hashlib
import html
import re
from urllib.parse import urljoin

import pytest

from lakeloom.plans.catalog import QUERIES

PIECE = re.compile(r"<!--.*?-->|<!DOCTYPE[^>]*>|<(script|style)\b[^>]*>.*?</\1>|<[^>]+>|[^<]+", re.S)


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}


def pieces(text):
    """Tags as (name, attributes), texts as strings; what is inside scripts and styles is text as it stands."""
    for m in PIECE.finditer(text or ""):
        whole = m.group()
        if m.group(1):
            yield "<" + m.group(1), {}
            yield re.sub(r"^<[^>]*>|</[^>]*>$", "", whole)
            yield "</" + m.group(1), {}
        elif whole.startswith(("<!--", "<!")):
            continue
        elif whole.startswith("<"):
            name = re.match(r"</?[\w-]+", whole).group().lower()
            yield name, {k: html.unescape(v) for k, v in re.findall(r'([\w-]+)="([^"]*)"', whole)}
        else:
            yield html.unescape(whole)


def links_of(url, text):
    out, href, label = [], None, ""
    for p in pieces(text):
        if isinstance(p, str):
            label += p
        elif p[0] == "<a":
            href, label = p[1].get("href"), ""
        elif p[0] == "</a" and href is not None:
            out.append((urljoin(url, href), label.strip()))
            href = None
    return out


def markdown_of(url, text):
    out, href = "", None
    for p in pieces(text):
        if isinstance(p, str):
            out += p
            continue
        tag, attrs = p
        if tag == "<a":
            href = urljoin(url, attrs.get("href", ""))
            out += "["
        elif tag == "</a" and href is not None:
            out, href = f"{out}]({href})", None
        elif tag == "<img":
            out += f"![{attrs.get('alt', '')}]({urljoin(url, attrs.get('src', ''))})"
        elif tag in ("<p", "<div", "<br", "</p", "</div"):
            out += "\n"
        elif tag == "<li":
            out += "\n* "
        elif tag.lstrip("</") in ("b", "strong"):
            out += "**"
        elif tag.lstrip("</") in ("i", "em"):
            out += "*"
    return re.sub("\n{3,}", "\n\n", out).strip()


def test_links_and_headings_of_the_pages(spark, sf_dir, raw):
    expected = []
    for page, (url, text) in raw.items():
        heads = [p for p in re.findall(r"<h1>(.*?)</h1>", text or "", re.S)]
        title = html.unescape("".join(heads)).strip() or None
        items = len(re.findall(r"<li\b", re.sub(r"<script.*?</script>", "", text or "", flags=re.S)))
        found = links_of(url, text)
        expected += [(page, k, href, label, title, items) for k, (href, label) in enumerate(found)] or [(page, None, None, None, title, items)]
    got = QUERIES["scan_html_pages"](spark, sf_dir).select("page_id", "pos", "href", "label", "title", "n_items").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_pages_as_markdown(spark, sf_dir, raw):
    got = {r.page_id: r.markdown_sha256 for r in QUERIES["fn_html_pages_to_md"](spark, sf_dir).collect()}
    assert got == {page: hashlib.sha256(markdown_of(url, text).encode()).hexdigest() for page, (url, text) in raw.items()}


def test_entity_pages_are_read_once_by_many_tasks(spark, sf_dir):
    """The filter on a page's value doesn't read it again, and the parts of one small file are dealt to many tasks."""
    from lakeloom.plans.catalog import QUERIES

    made = QUERIES["scan_html_entity"](spark, sf_dir)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert made.rdd.getNumPartitions() >= 4
