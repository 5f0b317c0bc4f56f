"""Links of pages: extraction in document order, filtering, edges and degrees."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import urls as U

#: File endings and path words of links that are not followed.
SKIPPED_ENDINGS = "pdf zip gz tar rar jpg jpeg png gif webp svg ico mp4 mp3 webm ogg css js json xml woff woff2 ttf eot".split()
SKIPPED_PATHS = r"(?i)/(login|logout|signin|signup|register|auth|account|cart|checkout)\b"
ANCHOR = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
INLINE_SCRIPT = r"(?is)<script(?![^>]*\ssrc\s*=)[^>]*>(.*?)</script>"
ROUTE = r"[\"'](#/[a-zA-Z0-9/_-]+)[\"']"


def unescape(text: Column) -> Column:
    out = text
    for entity, character in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(character))
    return out


def hrefs(html: Column) -> Column:
    """Link targets as written, anchors first, then hash routes named in inline scripts, in order."""
    quoted = F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1))
    anchors = F.transform(quoted, lambda h: unescape(F.regexp_replace(h, "^[\"']|[\"']$", "")))
    scripts = F.array_join(F.regexp_extract_all(html, F.lit(INLINE_SCRIPT), F.lit(1)), "\n")
    routes = F.regexp_extract_all(scripts, F.lit(ROUTE), F.lit(1))
    wanted = lambda h: (h != "") & ~h.rlike("^(mailto|tel|javascript):")
    return F.filter(F.concat(anchors, routes), wanted)


def extract_links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, position, link): resolved, distinct in each page, first position kept; null html has none."""
    return page_links(pages, key, url, html).select(key, "position", "link")


def page_links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, position, link, host): as ``extract_links``, with the host of the page.  No shuffle: the links of a page lie next to each other.

    The page's URL is taken apart once for a page, before its links multiply.  A fragment that starts
    ``#/`` is a route: it is cut at its question mark and the query goes.
    """
    written = pages.where(F.col(html).isNotNull() & U.is_url(F.col(url))).select(key, url, hrefs(F.col(html)).alias("_hrefs")).where(F.size("_hrefs") > 0)
    based = U.with_parts(written, url, "_b").drop(url)
    each = based.select(key, F.posexplode("_hrefs").alias("position", "_href"), *[f"_b_{k}" for k in U.PARTS])
    whole = each.select(key, "position", F.col("_b_host").alias("host"), U.resolve(F.col("_href"), "_b").alias("_whole"))
    parts = U.with_parts(whole, "_whole", "_l").where((F.col("_l_scheme") != "") & F.col("_l_host").rlike(r"^[^\s<>^|%\[\]]+$|^\[[0-9a-f:.]+\]$"))
    route = F.startswith("_l_hash", F.lit("#/"))
    found = parts.withColumns({"_l_search": F.when(route, F.lit("")).otherwise(F.col("_l_search")), "_l_hash": F.when(route, F.substring_index("_l_hash", "?", 1)).otherwise(F.col("_l_hash"))})
    found = found.select(key, "position", U.join_parts("_l", "path", "search", "hash").alias("link"), "host")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each link of a page once; a page begins where the position does not rise."""
        page, last, seen = object(), -1, set()
        for batch in batches:
            keep = []
            for k, position, link in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if k != page or position <= last:
                    page, seen = k, set()
                last = position
                keep.append(link not in seen)
                seen.add(link)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return found.mapInArrow(once, found.schema)


def filter_links(rows: DataFrame, link: str, domain: str) -> DataFrame:
    """Rows whose link is followed from a page of ``domain``: same host, no page anchor, no asset, no account page."""
    parts = U.with_parts(rows, link, "_l")
    c = lambda k: F.col(f"_l_{k}")
    root = c("path") == "/"
    anchor = root & (c("hash") != "") & ~F.startswith(c("hash"), F.lit("#/"))
    home = root & (c("search") == "") & (c("hash") == "")
    asset = F.lower(F.regexp_extract(c("path"), r"\.([^.]*)$", 1)).isin(SKIPPED_ENDINGS)
    follow = ~anchor & (home | (~asset & ~F.concat(c("path"), c("search")).rlike(SKIPPED_PATHS)))
    return U.drop_parts(parts.where(c("scheme").isin("http", "https") & (c("host") == F.col(domain)) & follow), "_l")


def distinct_edges(links: DataFrame, source: str = "from_url_id", target: str = "to_url_id") -> DataFrame:
    """Each edge once, with its first discovery."""
    return links.groupBy(source, target).agg(F.min("discovered_at").alias("discovered_at"))


def degrees(links: DataFrame, source: str = "from_url_id", target: str = "to_url_id") -> DataFrame:
    """(url_id, out_degree, in_degree) over distinct edges without self-links."""
    edges = links.where(F.col(source) != F.col(target)).select(source, target).distinct()
    ends = edges.select(F.col(source).alias("url_id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionAll(edges.select(F.col(target).alias("url_id"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return ends.groupBy("url_id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
