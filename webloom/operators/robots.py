"""Robots rules and sitemaps as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.functions.text import trim_space


def glob_pattern(glob: Column) -> Column:
    """A robots pattern as a regular expression from the start of the path; ``$`` stands for itself."""
    escaped = F.regexp_replace(glob, r"([.+^${}()|\[\]\\])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")))


def robots_lines(files: DataFrame, domain: str = "domain", body: str = "body") -> DataFrame:
    """(domain, line_no, key, value, relevant): directives; the latest user-agent line decides relevance."""
    lines = files.where(F.col(body).isNotNull()).select(domain, F.posexplode(F.split(F.col(body), "\n", -1)).alias("line_no", "raw"))
    lines = lines.withColumn("line", trim_space(F.col("raw"))).where((F.col("line") != "") & ~F.startswith("line", F.lit("#")))
    key = F.lower(trim_space(F.substring_index("line", ":", 1)))
    value = trim_space(F.when(F.contains("line", F.lit(":")), F.regexp_replace("line", "^[^:]*:", "")).otherwise(""))
    rows = lines.select(domain, "line_no", key.alias("key"), value.alias("value"))
    agent = F.when(F.col("key") == "user-agent", (F.col("value") == "*") | F.contains(F.lower("value"), F.lit("bot")))
    order = Window.partitionBy(domain).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("relevant", F.coalesce(F.last(agent, ignorenulls=True).over(order), F.lit(False)))


def robots_rules(files: DataFrame, domain: str = "domain", body: str = "body") -> DataFrame:
    """(domain, kind, pattern, line_no): allow and disallow rules that count."""
    rows = robots_lines(files, domain, body).where(F.col("relevant") & F.col("key").isin("allow", "disallow") & (F.col("value") != ""))
    return rows.select(domain, F.col("key").alias("kind"), glob_pattern(F.col("value")).alias("pattern"), "line_no")


def robots_summary(files: DataFrame, domain: str = "domain", body: str = "body") -> DataFrame:
    """(domain, disallow_count, crawl_delay, sitemaps): one row for each domain; default sitemaps where none is named."""
    rows = robots_lines(files, domain, body)
    number = F.regexp_extract("value", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", 0).try_cast("double")
    delay = F.when(F.col("relevant") & (F.col("key") == "crawl-delay"), number)
    found = rows.groupBy(domain).agg(
        F.count_if(F.col("relevant") & (F.col("key") == "disallow") & (F.col("value") != "")).alias("disallow_count"),
        F.max_by(delay, F.when(delay.isNotNull(), F.col("line_no"))).alias("crawl_delay"),
        F.array_sort(F.collect_list(F.when((F.col("key") == "sitemap") & (F.col("value") != ""), F.struct("line_no", "value")))).alias("named"),
    )
    out = files.select(domain).distinct().join(found, domain, "left")
    named = F.transform("named", lambda s: s["value"])
    default = F.array(F.concat(F.lit("https://"), F.col(domain), F.lit("/sitemap.xml")), F.concat(F.lit("https://"), F.col(domain), F.lit("/sitemap_index.xml")))
    return out.select(domain, F.coalesce("disallow_count", F.lit(0)).alias("disallow_count"), F.coalesce("crawl_delay", F.lit(0.0)).alias("crawl_delay"), F.when(F.size("named") > 0, named).otherwise(default).alias("sitemaps"))


def is_allowed(urls: DataFrame, rules: DataFrame, url: str = "url", domain: str = "domain") -> DataFrame:
    """``urls`` plus ``allowed``: any allow rule that matches the path wins, then any disallow rule, else allowed.

    Rules are gathered to one row for each host, so a host with many URLs meets its rules in one join
    without multiplying rows.
    """
    kinds = rules.groupBy(domain).agg(
        F.collect_list(F.when(F.col("kind") == "allow", F.col("pattern"))).alias("_allow"), F.collect_list(F.when(F.col("kind") == "disallow", F.col("pattern"))).alias("_deny")
    )
    kinds = kinds.withColumnRenamed(domain, "_host")
    rows = urls.withColumn("_at", U.hostname(F.col(url)))
    joined = rows.join(kinds, F.col("_at") == F.col("_host"), "left")
    path = U.pathname(F.col(url))
    hit = lambda c: F.exists(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda p: F.call_function("rlike", path, p))
    verdict = F.when(~U.is_url(F.col(url)), True).when(hit("_allow"), True).when(hit("_deny"), False).otherwise(True)
    return joined.withColumn("allowed", F.coalesce(verdict, F.lit(True))).drop("_at", "_host", "_allow", "_deny")


def cache_rows(files: DataFrame, fetched_at: Column, domain: str = "domain", body: str = "body", hours: int = 1) -> DataFrame:
    """Rows of the robots cache: the summary of each domain's rules, good for ``hours``."""
    found = robots_summary(files, domain, body)
    rows = found.select(domain, F.col("sitemaps").alias("sitemap_urls"), F.col("crawl_delay").cast("float").alias("crawl_delay_seconds"), F.col("disallow_count").cast("int").alias("disallow_count"), fetched_at.alias("fetched_at"))
    return rows.withColumn("expires_at", F.col("fetched_at") + F.expr(f"INTERVAL {hours} HOURS"))


def due_domains(domains: DataFrame, cache: DataFrame, now: Column, domain: str = "domain") -> DataFrame:
    """Domains whose rules must be fetched: not in the cache, or past their time there."""
    good = cache.where(F.col("expires_at") > now).select(domain)
    return domains.where(F.col(domain).isNotNull()).select(domain).distinct().join(good, domain, "left_anti")


LOCATION = r"(?i)<loc>\s*(https?://[^<]+?)\s*</loc>"


def sitemap_locations(files: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """(url, is_index, position, location) of each sitemap file."""
    rows = files.where(F.col(body).isNotNull()).select(url, F.contains(F.col(body), F.lit("<sitemapindex")).alias("is_index"), F.posexplode(F.regexp_extract_all(F.col(body), F.lit(LOCATION), F.lit(1))).alias("position", "found"))
    return rows.select(url, "is_index", "position", trim_space(F.col("found")).alias("location"))


def sitemap_urls(files: DataFrame, roots: DataFrame, url: str = "url", body: str = "body", levels: int = 3) -> DataFrame:
    """(root, location): pages named by sitemaps that are reached from ``roots`` through indexes, ``levels`` files deep."""
    found = sitemap_locations(files, url, body)
    level = roots.select(F.col(url).alias("root"), F.col(url).alias("file"))
    pages = None
    for _ in range(levels):
        step = level.join(found, level["file"] == found[url]).select("root", "is_index", "location")
        leaves = step.where(~F.col("is_index")).select("root", "location")
        pages = leaves if pages is None else pages.unionAll(leaves)
        level = step.where("is_index").select("root", F.col("location").alias("file"))
    return pages.distinct()
