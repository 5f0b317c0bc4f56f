import datetime as dt
import random

from pyspark.sql import functions as F

from webloom.operators import control, frontier, robots
from webloom.plans import catalogue


def test_rate_slots(spark):
    df = spark.createDataFrame([("d", 0, 1), ("d", 200, 2), ("d", 5000, 3)], "k string, at long, id long")
    assert [r.slot for r in control.rate_slots(df, "k", "at", "id", 0).orderBy("id").collect()] == [0, 1000, 5000]


def test_rate_slots_against_the_sequential_rule(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), rnd.randrange(200_000), i) for i in range(2000)]
    want, last = {}, {}
    for k, at, i in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        last[k] = max(at, last[k] + 1500) if k in last else at
        want[i] = last[k]
    found = control.rate_slots(spark.createDataFrame(rows, "k string, at long, id long"), "k", "at", "id", 1500).collect()
    assert {r.id: r.slot for r in found} == want


def test_retry_schedule(spark):
    df = spark.createDataFrame([(1, i) for i in range(4)], "k int, at int")
    found = control.retry_schedule(df, "k", "at", "at").orderBy("at").collect()
    assert [(r.delay_ms, r.exhausted) for r in found] == [(2000, False), (4000, False), (None, True), (None, True)]


def test_proxy_recovers_after_more_than_five_minutes(spark):
    rows = [("p", t, i, True) for i, t in enumerate((0, 1, 2))] + [("p", 300_002, 3, True), ("q", 0, 4, True), ("q", 1, 5, True), ("q", 2, 6, True), ("q", 300_003, 7, True), ("r", 0, 8, True), ("r", 1, 9, False)]
    found = control.proxy_health(spark.createDataFrame(rows, "k string, at long, id int, bad boolean"), "k", "at", "id", "bad").orderBy("id").collect()
    assert [(r.failures, r.healthy) for r in found] == [(1, True), (2, True), (3, False), (4, False), (1, True), (2, True), (3, False), (1, True), (1, True), (0, True)]


def test_locks(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 299_999, 1), ("a", 300_000, 2), ("b", 5, 3)], "k string, at long, id int")
    found = control.replay_locks(df, "k", "at", "id").orderBy("id").collect()
    assert [r.granted for r in found] == [True, False, True, True]


def test_upsert_twice(spark):
    known = spark.createDataFrame([], "hash string, depth int, status string, last_crawled_at timestamp_ntz")
    t = dt.datetime(2025, 1, 1)
    batch = spark.createDataFrame([("h", 2, t)], "hash string, depth int, at timestamp_ntz")
    once = frontier.upsert(known, batch)
    assert [tuple(r) for r in once.collect()] == [("h", 2, "crawling", None)]
    again = frontier.upsert(once, spark.createDataFrame([("h", 9, t)], batch.schema))
    assert [tuple(r) for r in again.collect()] == [("h", 2, "crawling", t)]


def test_insert_or_ignore(spark):
    new = spark.createDataFrame([("a",), ("b",), ("b",)], "hash string")
    assert [r.hash for r in frontier.unseen(new, spark.createDataFrame([("a",)], "hash string")).collect()] == ["b"]


def test_outcomes(spark):
    rows = [(200, False, "x"), (200, False, None), (403, False, None), (404, False, None), (0, True, None), (None, None, None)]
    df = spark.createDataFrame(rows, "c int, n boolean, h string")
    found = [r[0] for r in df.select(frontier.fetch_outcome(F.col("c"), F.col("n"), F.col("h"))).collect()]
    assert found == ["parse", "skip", "final", "retry", "retry", "retry"]


def test_depths_keep_the_least(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (2, 2)], "from_url_id long, to_url_id long")
    found = frontier.crawl_depths(edges, spark.createDataFrame([(1,)], "url_id long"), 3)
    assert {tuple(r) for r in found.collect()} == {(1, 0), (2, 1), (3, 1), (4, 2), (5, 3)}


def test_crawl_seeds_from_every_root(spark, tmp_path):
    rnd = random.Random(5)
    urls = [(i, rnd.choice([0, 0, 1, 2, None])) for i in range(300)]
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(250)]
    spark.createDataFrame(urls, "url_id long, depth int").write.parquet(f"{tmp_path}/urls.parquet")
    spark.createDataFrame(edges, "from_url_id long, to_url_id long").write.parquet(f"{tmp_path}/links.parquet")
    want = {i: 0 for i, depth in urls if depth == 0}
    for level in range(1, 4):
        for a, b in [(a, b) for a, b in edges if want.get(a) == level - 1]:
            want.setdefault(b, level)
    found = [tuple(r) for r in catalogue.crawl_bfs(spark, str(tmp_path)).select("url_id", "depth").collect()]
    assert len(found) == len(want) and dict(found) == want and {0, 1, 2, 3} == set(want.values())


def test_robots(spark):
    rules = robots.robots_rules(catalogue._robots(spark))
    assert {(r.domain, r.kind, r.pattern) for r in rules.collect()} == {
        ("h.com", "disallow", "^/private"), ("h.com", "allow", "^/private/ok"), ("h.com", "disallow", "^/.*\\.pdf\\$"), ("k.org", "disallow", "^/a.b")
    }
    found = {r.url: r.allowed for r in catalogue.robots_allowed(spark, "").collect()}
    assert found["https://h.com/a.pdf"] and not found["https://h.com/privateer"] and found["https://h.com/private/ok/1"] and found["not a url"]
    summary = {r.domain: (r.disallow_count, r.crawl_delay, len(r.sitemaps)) for r in robots.robots_summary(catalogue._robots(spark)).collect()}
    assert summary == {"h.com": (2, 2.0, 1), "k.org": (1, 1.5, 2), "empty.net": (0, 0.0, 2)}


def test_sitemaps_three_files_deep(spark):
    chain = [(f"https://h.com/{i}.xml", f"<sitemapindex><loc>https://h.com/{i + 1}.xml</loc></sitemapindex>") for i in range(3)] + [("https://h.com/3.xml", "<loc>https://h.com/late</loc>")]
    files = spark.createDataFrame(chain, "url string, body string")
    assert robots.sitemap_urls(files, spark.createDataFrame([("https://h.com/0.xml",)], "url string")).count() == 0
    assert robots.sitemap_urls(files, spark.createDataFrame([("https://h.com/1.xml",)], "url string")).count() == 1


def test_job_checks(spark):
    good = ("https://h.com", "x", "h.com", 0, 3, 0, 3, "queued")
    rows = [good, ("nope", *good[1:]), (*good[:3], -1, *good[4:]), (*good[:7], "odd"), (None, *good[1:])]
    df = spark.createDataFrame(rows, "url string, url_hash string, domain string, depth int, max_depth int, retry_count int, max_retries int, state string")
    valid, rejected = control.check_jobs(df)
    assert (valid.count(), rejected.count()) == (1, 4)


def test_rotation_and_cache(spark):
    df = spark.range(9).select(control.rotate(F.col("id"), ["a", "b", "c"]).alias("x"))
    assert "".join(r.x for r in df.collect()) == "abcabcabc"
    now = dt.datetime(2025, 1, 1, 12)
    df = spark.createDataFrame([(now - dt.timedelta(minutes=59),), (now - dt.timedelta(minutes=60),)], "at timestamp_ntz")
    assert control.fresh(df, "at", F.lit(now).cast("timestamp_ntz")).count() == 1
