"""Page metadata and body text from html: column expressions for what patterns can say, an Arrow parser for the rest."""

from __future__ import annotations

import html as entities
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import collapse_space, strip_tags, trim_space, units
from webloom.operators.links import unescape

#: Elements whose text is not page text.
SILENT = ("script", "style", "noscript", "iframe", "svg")
ATTRIBUTES = r"(?:[^\"'>]|\"[^\"]*\"|'[^']*')*?"
META_DESCRIPTION = rf"(?is)<meta\s(?={ATTRIBUTES}(?<=[\s\"'])name\s*=\s*(?:\"description\"|'description'|description(?=[\s/>]))){ATTRIBUTES}>"
SPA_ROOT = r"(?i)<div[^>]*id=[\"'](?:root|app|__next|__nuxt)[\"'][^>]*>\s*</div>"


def needs_rendering(url: Column, html: Column) -> Column:
    """Whether a page shows little without its scripts."""
    size = units(trim_space(collapse_space(strip_tags(html))))
    sparse = (size < 200) | html.rlike(SPA_ROOT) | (html.rlike("(?i)docsify") & (size < 2000))
    routed = url.rlike("#/[a-zA-Z]") | url.rlike("/app/|/dashboard/")
    return html.isNull() | (html == "") | F.coalesce(sparse, F.lit(False)) | F.coalesce(routed, F.lit(False))


def _inner(html: Column, tag: str) -> Column:
    found = F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)
    return trim_space(unescape(F.regexp_replace(found, "(?s)<[^>]*>", "")))


def page_title(html: Column) -> Column:
    return _inner(html, "title")


def page_heading(html: Column) -> Column:
    return _inner(html, "h1")


def page_description(html: Column) -> Column:
    """The first description, whatever the order, quotes and other attributes of its element."""
    tag = F.regexp_extract(html, META_DESCRIPTION, 0)
    written = F.regexp_extract(tag, r"(?is)\scontent\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return trim_space(unescape(F.regexp_replace(written, r"^[\"']|[\"']$", "")))


def body_text(html: Column, limit: int = 5000) -> Column:
    """Text of ``main``, else ``article``, else ``body``; white space collapsed; the field holds ``limit`` units by definition."""
    clean = html
    for tag in SILENT:
        clean = F.regexp_replace(clean, rf"(?is)<{tag}\b.*?</{tag}\s*>", "")
    inside = lambda tag: F.array_join(F.regexp_extract_all(clean, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), F.lit(1)), "")
    body = F.regexp_extract(clean, r"(?is)<body(?:\s[^>]*)?>(.*)", 1)
    chosen = F.when(clean.rlike(r"(?i)<main[\s>]"), inside("main")).when(clean.rlike(r"(?i)<article[\s>]"), inside("article")).otherwise(body)
    return F.left(trim_space(collapse_space(unescape(F.regexp_replace(chosen, "(?s)<[^>]*>", "")))), F.lit(limit))


class _Document(HTMLParser):
    """Elements that metadata is read from, and text blocks with what surrounds them."""

    BLOCKS = frozenset("p li h1 h2 h3 h4 h5 h6 pre blockquote td div article section main span".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.metas: list[dict[str, str]] = []
        self.times: list[tuple[dict, list[str]]] = []
        self.lang: str | None = None
        self.open: list[tuple[str, dict[str, str]]] = []
        self.blocks: list[list] = []  # tag, depth key, text parts, in link

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "html" and self.lang is None:
            self.lang = a.get("lang")
        if tag == "meta":
            self.metas.append(a)
            return
        if tag in ("br", "img", "hr", "input", "link"):
            return
        if tag == "time" or "itemprop" in a or a.get("rel") == "author":
            self.times.append(({"_tag": tag, "_element": a, **a}, []))
        self.open.append((tag, a))
        if tag in self.BLOCKS:
            holder = next((t for t, _ in reversed(self.open[:-1]) if t in ("div", "td", "article", "section", "main", "nav", "aside", "footer", "header", "body")), "body")
            self.blocks.append([tag, len(self.open), [], any(t == "a" for t, _ in self.open), holder, id(self.open[-2][1]) if len(self.open) > 1 else 0])

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if any(t in SILENT or t == "head" for t, _ in self.open):
            return
        for attrs, parts in self.times:
            if any(a is attrs["_element"] for _, a in self.open):
                parts.append(data)
        if self.blocks:
            self.blocks[-1][2].append(data)
            self.blocks[-1][3] |= any(t == "a" for t, _ in self.open)


def read_document(markup: str) -> _Document:
    doc = _Document()
    try:
        doc.feed(markup)
        doc.close()
    except AssertionError:  # the parser gives up on some broken declarations; what it read so far stands
        pass
    return doc


def document_meta(markup: str | None) -> dict[str, str | None]:
    """Description, author, dates, image and language by fallback order; blank values are passed over."""
    doc = read_document(markup or "")
    meta = lambda k, v: [m.get("content") for m in doc.metas if m.get(k) == v]

    def timed(match) -> list[str | None]:
        return [a.get("content") or a.get("datetime") or "".join(parts) for a, parts in doc.times if match(a)]

    first = lambda *lists: next((v.strip() for values in lists for v in values[:1] if v and v.strip()), None)
    return {
        "description": first(meta("name", "description"), meta("property", "og:description")),
        "author": first(meta("name", "author"), meta("property", "article:author"), timed(lambda a: a.get("rel") == "author")),
        "published": first(
            meta("property", "article:published_time"), timed(lambda a: a["_tag"] == "time" and a.get("itemprop") == "datePublished"),
            timed(lambda a: a.get("itemprop") == "datePublished"), timed(lambda a: a["_tag"] == "time" and "pubdate" in a),
        ),
        "modified": first(meta("property", "article:modified_time"), timed(lambda a: a["_tag"] == "time" and a.get("itemprop") == "dateModified")),
        "og_image": first(meta("property", "og:image")),
        "lang": doc.lang,
    }


def main_text(markup: str | None, least: int = 100) -> str | None:
    """Main text by density: the container whose own paragraphs hold most text outside links; null under ``least`` characters."""
    doc = read_document(markup or "")
    score: dict[int, int] = {}
    lines: list[tuple[int, str]] = []
    for tag, _, parts, link, _, holder in doc.blocks:
        text = " ".join("".join(parts).split())
        if not text:
            continue
        if not link and tag in ("p", "li", "pre", "blockquote", "td", "div"):
            score[holder] = score.get(holder, 0) + len(text) * (2 if text[-1:] in ".!?" else 1)
        if not link and tag != "h1":
            lines.append((holder, text))
    if not score:
        return None
    best = max(score, key=score.get)
    out = "\n".join(text for holder, text in lines if holder == best)
    return out if len(out) >= least else None


def extract_meta(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, description, author, published, modified, og_image, lang) by an Arrow-batched parser; null html gives nulls."""
    names = ("description", "author", "published", "modified", "og_image", "lang")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [document_meta(h) for h in frame[html]]
            yield pd.DataFrame({key: frame[key], **{n: [f[n] for f in found] for n in names}})

    return pages.select(key, html).mapInPandas(run, f"{key} {dict(pages.dtypes)[key]}, " + ", ".join(f"{n} string" for n in names))


def extract_main(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, content, excerpt, length): main text by density, one row for each page with html."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(h) for h in frame[html]]
            yield pd.DataFrame({key: frame[key], "content": texts, "excerpt": [t.split("\n")[0] if t else None for t in texts], "length": [len(t) if t else 0 for t in texts]})

    return pages.where(F.col(html).isNotNull()).select(key, html).mapInPandas(run, f"{key} {dict(pages.dtypes)[key]}, content string, excerpt string, length long")


def unescape_text(text: str) -> str:
    return entities.unescape(text)
