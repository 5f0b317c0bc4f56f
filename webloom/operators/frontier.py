"""The crawl frontier: deduplication, insert-or-ignore, upsert, status merges, breadth-first depth, sitemap seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.session import materialize

#: The status codes that no retry mends.
FINAL_CODES = [401, 403, 407, 429, 503, 999]


def normalized(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` plus ``normal`` and ``hash``; what is no URL has nulls."""
    return U.with_normal(urls, url).withColumn("hash", U.fingerprint(F.col("normal")))


def first_of_each(urls: DataFrame, key: str, order: list[Column], *columns: str) -> DataFrame:
    """One row for each non-null key: the first by ``order``, by a pre-aggregated minimum rather than a sort."""
    names = [c for c in (columns or urls.columns) if c != key]
    ordered = F.struct(*order).alias("_o")
    kept = urls.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*names), ordered).alias("_r"), F.count("*").alias("copies"))
    return kept.select(key, "_r.*", "copies")


def unseen(candidates: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """Insert-or-ignore: candidates of which no unique key (``hash`` by default) is known, each once; a null key clashes with nothing."""
    out = candidates
    for key in keys or ("hash",):
        out = out.join(known.select(F.col(key)), key, "left_anti").dropDuplicates([key])
    return out.select(*candidates.columns)


def upsert(known: DataFrame, batch: DataFrame, key: str = "hash") -> DataFrame:
    """Insert-or-update of a crawl start: a new row has no time, a known row gets status ``crawling`` and the time of the batch.

    ``known`` has (key, depth, status, last_crawled_at), ``batch`` (key, depth, at), unique keys each.
    """
    b = batch.select(F.col(key).alias("_k"), F.col("depth").alias("_d"), F.col("at").alias("_at"))
    joined = known.join(b, known[key] == F.col("_k"), "full_outer")
    touched = F.col("_k").isNotNull()
    return joined.select(
        F.coalesce(known[key], "_k").alias(key),
        F.coalesce("depth", "_d").alias("depth"),
        F.when(touched, F.lit("crawling")).otherwise(F.col("status")).alias("status"),
        F.when(touched & known[key].isNotNull(), F.col("_at")).otherwise(F.col("last_crawled_at")).alias("last_crawled_at"),
    )


def merge_status(known: DataFrame, events: DataFrame, key: str = "url_id") -> DataFrame:
    """The latest status event of each row wins; events of unknown rows change nothing.

    An event has (key, new_status, at, timed).  The latest timed one gives the time: a parsed page and
    a robots verdict are timed, a page without html and a failure are not.
    """
    last = events.groupBy(key).agg(F.max_by("new_status", F.struct("at", "new_status")).alias("_s"), F.max(F.when(F.col("timed"), F.col("at"))).alias("_at"))
    joined = known.join(last, key, "left")
    return joined.withColumn("status", F.coalesce("_s", "status")).withColumn("last_crawled_at", F.coalesce("_at", "last_crawled_at")).drop("_s", "_at")


def fetch_outcome(code: Column, network_error: Column, html: Column) -> Column:
    """What follows a fetch: ``final`` failure, ``retry``, ``skip`` (nothing to parse) or ``parse``."""
    return (
        F.when(code.isin(FINAL_CODES), "final").when(F.coalesce(network_error, F.lit(False)) | (code >= 400) | code.isNull(), "retry").when(html.isNull(), "skip").otherwise("parse")
    )


def within_size(html: Column, limit: int = 5_242_880) -> Column:
    return F.octet_length(html) <= limit


def is_html(content_type: Column) -> Column:
    return F.contains(content_type, F.lit("text/html")) | F.contains(content_type, F.lit("application/xhtml"))


def crawl_depths(edges: DataFrame, seeds: DataFrame, max_depth: int, source: str = "from_url_id", target: str = "to_url_id") -> DataFrame:
    """(url_id, depth): breadth-first from the seeds; least depth of each page, no deeper than ``max_depth``.

    Each level is written before the next, so the plan does not grow and a lost executor costs one level.
    """
    pairs = edges.select(F.col(source).alias("_s"), F.col(target).alias("_t")).where("_s <> _t").distinct()
    seen = materialize(seeds.select(F.col("url_id"), F.lit(0).alias("depth")).distinct(), "depth0")
    frontier = seen
    for depth in range(1, max_depth + 1):
        step = frontier.join(pairs, frontier["url_id"] == pairs["_s"]).select(F.col("_t").alias("url_id")).distinct()
        frontier = materialize(step.join(seen, "url_id", "left_anti").withColumn("depth", F.lit(depth)), f"depth{depth}")
        if frontier.isEmpty():
            break
        seen = seen.unionAll(frontier)
    return seen


def sitemap_roots(jobs: DataFrame, summary: DataFrame, domain: str = "domain", most: int = 3) -> DataFrame:
    """(domain, url): the first ``most`` sitemaps of each domain that has a job of depth 0; deeper jobs seed nothing."""
    starts = jobs.where("depth = 0").select(domain).distinct()
    return summary.join(starts, domain, "left_semi").select(domain, F.explode(F.slice("sitemaps", 1, most)).alias("url"))


def sitemap_seeds(found: DataFrame, domain: str = "domain", location: str = "location", limit: int = 5_000, known: DataFrame | None = None) -> DataFrame:
    """(domain, normal, hash, depth 1): same-host pages of a domain's sitemaps, each once and none that is ``known`` by hash, at most ``limit`` for each domain.

    The limit is the operator's contract (the first by URL), kept by a limited window that works before the shuffle.
    """
    rows = normalized(found.select(domain, location), location).where((U.hostname(F.col("normal")) == F.col(domain)) & F.col("hash").isNotNull())
    rows = rows.select(domain, "normal", "hash").distinct()
    if known is not None:
        rows = rows.join(known.select("hash"), "hash", "left_anti")
    order = Window.partitionBy(domain).orderBy("normal")
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n").withColumn("depth", F.lit(1))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose reference points nowhere; null references count as orphans."""
    return child.join(parent.select(F.col(parent_key or key).alias("_parent")), F.col(key) == F.col("_parent"), "left_anti")


def cascade_delete(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Rows that remain when the parents in ``deleted`` go."""
    return child.join(deleted.select(key).distinct(), key, "left_anti")


def latest_pages(pages: DataFrame, key: str = "url_id") -> DataFrame:
    """The newest row of each page of an append-only table; equal times are settled by the smaller page_id."""
    order = F.struct(F.col("fetched_at").isNotNull(), F.col("fetched_at"), -F.col("page_id"))
    return pages.groupBy(key).agg(F.max_by(F.struct(*[c for c in pages.columns if c != key]), order).alias("_r")).select(key, "_r.*")
