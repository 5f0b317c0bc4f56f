"""Sequential control rules against plain restatements, and the boundaries of the session."""

import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom import session
from webloom.functions import urls as U
from webloom.operators import control, embedding, extraction, frontier, pipeline, search
from webloom.sources import tables


def test_no_private_folder_on_a_cluster():
    stub = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(stub)


def test_intermediates_are_removed(spark, tmp_path):
    path = session.materialize(spark.range(5), "gone").inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert __import__("os").path.isdir(path) and session.release(spark) >= 1
    assert not __import__("os").path.isdir(path) and session.release(spark) == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_slots_split_a_hot_key(spark, partitions):
    from webloom.operators.order import slots

    rnd = random.Random(4)
    rows = [(i, rnd.choice(["hot"] * 5 + ["a", None]), rnd.randint(0, 60) * 1000) for i in range(400)] + [(900, "hot", None)]
    got = {r.id: r.slot for r in slots(spark.createDataFrame(rows, "id long, k string, at long"), "k", [F.col("at").asc(), F.col("id").asc()], "at", 1500, partitions).collect()}
    free: dict = {}
    for i, k, at in sorted((r for r in rows if r[2] is not None and r[1] != "hot"), key=lambda r: (r[2], r[0])):
        free[k] = max(at, free.get(k, -(10**9)) + 1500)
        assert got[i] == free[k]
    assert len(got) == 401


def plain_pool(events, proxies):
    state, turn, out = {p: [True, 0, 0] for p in proxies}, 0, []
    for at, bad in events:
        for s in state.values():
            if not s[0] and at - s[2] > 300_000:
                s[0], s[1] = True, 0
        up = [p for p in proxies if state[p][0]]
        if up:
            p = up[turn % len(up)]
            turn = (turn + 1) % len(up)
        else:
            for s in state.values():
                s[0], s[1] = True, 0
            p = proxies[0]
        s = state[p]
        if bad:
            s[1], s[2] = s[1] + 1, at
            if s[1] >= 3:
                s[0] = False
        else:
            s[0], s[1] = True, 0
        out.append((p, sum(x[0] for x in state.values())))
    return out


def test_proxy_pool_against_a_plain_replay(spark):
    rnd = random.Random(2)
    rows = [(i, "pool", i * 20_000 + (400_000 if i > 60 else 0), rnd.random() < 0.8) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, pool string, at long, failed boolean")
    got = [(r.proxy, r.healthy) for r in control.proxy_choices(df, "pool", "at", "id", "failed", ["a", "b", "c"]).orderBy("id").collect()]
    assert got == plain_pool([(at, bad) for _, _, at, bad in rows], ["a", "b", "c"]) and {h for _, h in got} > {0, 3}
    assert control.proxy_choices(df.limit(1), "pool", "at", "id", "failed", []).first().proxy is None


def test_lock_release(spark):
    rows = [(1, "k", 0, False), (2, "k", 10, False), (3, "k", 20, True), (4, "k", 30, False), (5, "k", 300_029, False), (6, "k", 300_030, False)]
    df = spark.createDataFrame(rows, "id long, k string, at long, freed boolean")
    assert [r.granted for r in control.replay_locks(df, "k", "at", "id", 300, "freed").orderBy("id").collect()] == [True, False, False, True, False, True]


def test_status_times(spark):
    known = spark.createDataFrame([(1, "pending", None), (2, "crawled", 5), (3, "crawled", 7)], "url_id long, status string, last_crawled_at long")
    events = spark.createDataFrame([(1, "crawled", 10, True), (1, "failed", 12, False), (2, "crawled", 20, False), (9, "crawled", 1, True), (3, "disallowed", 30, True)], "url_id long, new_status string, at long, timed boolean")
    got = {r.url_id: (r.status, r.last_crawled_at) for r in frontier.merge_status(known, events).collect()}
    assert got == {1: ("failed", 10), 2: ("crawled", 5), 3: ("disallowed", 30)}


def test_known_by_any_unique_key(spark):
    new = spark.createDataFrame([("h1", "u1"), ("h2", "u2"), ("h3", "u3"), ("h3", "u3")], "hash string, url string")
    known = spark.createDataFrame([("h1", "x"), ("y", "u2")], "hash string, url string")
    assert [tuple(r) for r in frontier.unseen(new, known, "hash", "url").collect()] == [("h3", "u3")]


def test_sitemaps_only_for_start_pages(spark):
    jobs = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2)], "domain string, depth int")
    summary = spark.createDataFrame([("a", ["1", "2", "3", "4"]), ("b", ["5"])], "domain string, sitemaps array<string>")
    assert sorted(r.url for r in frontier.sitemap_roots(jobs, summary).collect()) == ["1", "2", "3"]


def test_dispatch_order(spark):
    jobs = spark.createDataFrame([("j1", "https://h.com/a", 5, "queued"), ("j2", "https://h.com/b", None, "running"), ("j3", "https://h.com/c", 1, "skipped"), ("j4", "nope", 0, "queued"), ("j5", "https://h.com/d", 0, "fetching")], "job_id string, url string, priority int, state string")
    jobs = jobs.withColumns({"url_hash": F.lit("x"), "domain": F.lit("h.com"), **{c: F.lit(0) for c in ("depth", "max_depth", "retry_count", "max_retries")}})
    assert [(r.job_id, r.place, r.state) for r in control.dispatch(jobs).orderBy("place").collect()] == [("j2", 1, "queued"), ("j3", 2, "queued"), ("j1", 3, "queued")]


def test_fetch_guards():
    page = {"url": "u", "status_code": 200, "content_type": "text/html; charset=utf-8", "body": b"caf\xc3\xa9 \xff", "proxy_used": "p"}
    assert tables.guard(page)["html"] == "café �" and tables.guard(page)["content_length"] == 7
    assert tables.guard(page, 31)["network_error"] and tables.guard(page, 31)["status_code"] == 0
    assert tables.guard(page | {"status_code": 429})["error_message"] == "RATE_LIMITED"
    assert tables.guard(page | {"content_type": "application/pdf"})["html"] is None and tables.guard(page | {"content_type": "application/pdf"})["error_message"] is None
    assert tables.guard(page | {"content_length": 6_000_000})["error_message"] == tables.guard(page | {"body": b"x" * 5_242_881})["error_message"] == "BODY_TOO_LARGE"
    assert tables.guard(page | {"body": b"x" * 5_242_880})["html"]


def test_query_kind():
    assert embedding.embed_queries(["a b", " ", ""], embedding.hashing_embedder(8)) == embedding.hashing_embedder(8)(["a b"])
    assert embedding.embed_queries(["q"], lambda texts, kind: [[kind]]) == [["search_query"]] and embedding.embed_queries([], lambda t, k: 1 / 0) == []


@pytest.mark.parametrize(
    "tag",
    ['<meta name="description" content="It works">', "<meta content='It works' name='description'>", '<meta property="x" content="It works" name=description />', "<META\n name='description'\n data-x='a>b' content=\"It works\">"],
)
def test_description_in_any_form(spark, tag):
    html = f'<html><head><meta name="author" content="No"><meta data-name="description" content="No">{tag}<meta name="description" content="Later"></head></html>'
    assert spark.createDataFrame([(html,)], "h string").select(extraction.page_description(F.col("h"))).first()[0] == "It works"


def test_paths_of_any_length(spark):
    long = "https://h.com/a/../" + "x" * 1_200_000
    row = spark.createDataFrame([(long,)], "u string").select(F.length(U.pathname(F.col("u"))).alias("n")).first()
    assert row.n == 1_200_001


def test_normal_forms_agree(spark):
    urls = ["https://h.com:443/a/../b/?utm_source=x&b=2&a=1#t", "http://U:p@H.com/?q=a%20b", "not a url", None, "https://h.com", "https://h.com/?", "https://h.com/a?b", "https://h.com/ a/", "http://[::1]:80/x", "ftp://h.com/x/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").withColumn("one", U.normalize(F.col("u")))
    assert all(r.one == r.two for r in U.with_normal(df, "u", "two").collect())


def test_cells_find_what_the_exact_search_finds(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding")
    rows = rows.unionByName(spark.createDataFrame([(-1, None), (-2, [1.0])], rows.schema))
    queries = rows.where("vec_id % 10 = 0")
    centres = search.fit_cells(rows, "vec_id", "embedding", cells=20)
    index = search.assign_cells(rows, "embedding", centres)
    want = {(r["query"], r.vec_id) for r in search.nearest(rows.where("vec_id >= 0"), queries, "vec_id", "embedding", 5, "cosine").collect()}
    got = {(r["query"], r.vec_id) for r in search.probe(index, queries, "vec_id", "embedding", centres, 5, probes=13).collect()}
    full = {(r["query"], r.vec_id) for r in search.probe(index, queries, "vec_id", "embedding", centres, 5, probes=20).collect()}
    assert len(got & want) >= 0.9 * len(want) and full == want and index.count() == rows.count() - 2
    few = search.nearest(rows.where("vec_id >= 0"), queries, "vec_id", "embedding", 5, "cosine", block=7)
    assert {(r["query"], r.vec_id) for r in few.collect()} == want


def test_pipeline_from_html(spark):
    body = "".join(f"<p>The {w} of the town keeps its doors open until the evening, and a guide tells of its past.</p>" for w in ("museum", "library", "market", "harbour"))
    html = f"<html lang='en'><head><title>Town</title><meta name='description' content='About'></head><body><article><h1>Town news</h1>{body}</article></body></html>"
    rows = [(1, 10, 200, html, None), (2, 11, 200, "<html><body></body></html>", "p"), (3, 12, 500, None, None)]
    fetched = spark.createDataFrame(rows, "fetch_id long, url_id long, status_code int, html string, proxy_used string")
    pages = pipeline.page_rows(pipeline.extract(fetched), F.col("fetch_id")).orderBy("page_id").collect()
    assert [p.page_id for p in pages] == [1, 2]
    good, empty = pages
    assert good.title == "Town" and good.h1 == "Town news" and good.description == "About" and good.lang == "en" and good.word_count == 76 and good.passes_quality_gate and good.excerpt.startswith("The museum")
    assert (empty.content, empty.quality_score, empty.quality_flags, empty.passes_quality_gate, empty.word_count, empty.reading_time, empty.proxy_used) == (None, 0, [], False, 0, 1, "p")
    chunks = pipeline.chunk_rows(spark.createDataFrame([p.asDict() for p in pages], pages and __import__("webloom.schemas", fromlist=["PAGES"]).PAGES), target=40, overlap=0, minimum=5)
    assert {r.page_id for r in chunks.collect()} == {1}
    assert np.all([r.url_id == 10 for r in chunks.collect()])
