from pyspark.sql import functions as F

from webloom.operators import links


def test_extraction_in_document_order(spark):
    html = '<a href="x">1</a><a href="/y">2</a><a href="x">3</a><a href="mailto:a@b.c">4</a><a href="#/r?id=1">5</a><script>go("#/s")</script>'
    df = spark.createDataFrame([(1, "https://h.com/d/p?z=1", html), (2, "https://h.com", None), (3, "nothing", html), (4, "https://h.com", "")], "k int, url string, html string")
    found = links.extract_links(df, "k", "url", "html").orderBy("k", "position").collect()
    assert [(r.k, r.link) for r in found] == [(1, "https://h.com/d/x"), (1, "https://h.com/y"), (1, "https://h.com/d/p#/r"), (1, "https://h.com/d/p#/s")]


def test_resolution_of_every_form(spark):
    hrefs = ["//o.org/a", "?q=1", "#frag", "../up", "./same", "HTTP://H.COM:80/b", "a b", "ftp://f.net/x", "javascript:void(0)", "tel:1"]
    html = "".join(f'<a class="c" href="{h}">t</a>' for h in hrefs)
    df = spark.createDataFrame([(1, "https://h.com/d/e/p.html?z=1", html)], "k int, url string, html string")
    found = [r.link for r in links.extract_links(df, "k", "url", "html").orderBy("position").collect()]
    assert found == [
        "https://o.org/a", "https://h.com/d/e/p.html?q=1", "https://h.com/d/e/p.html?z=1#frag", "https://h.com/d/up", "https://h.com/d/e/same", "http://h.com/b",
        "https://h.com/d/e/a%20b", "ftp://f.net/x",
    ]


def test_filter(spark):
    keep = ["https://h.com/", "https://h.com/a#sec", "https://h.com/#/cloud", "https://h.com/#/login", "https://h.com/author", "https://h.com/accounts", "https://h.com/a.html"]
    drop = ["https://h.com/#top", "https://www.h.com/", "ftp://h.com/x", "https://h.com/a.PDF", "https://h.com/login-help", "https://h.com/x?next=/cart"]
    df = spark.createDataFrame([(u, "h.com") for u in keep + drop] + [(None, "h.com")], "link string, domain string")
    found = {r.link for r in links.filter_links(df, "link", "domain").collect()}
    assert found == set(keep)


def test_edges_and_degrees(spark):
    df = spark.createDataFrame([(1, 2, 5), (1, 2, 3), (1, 1, 1), (2, 3, 1)], "from_url_id long, to_url_id long, discovered_at long")
    assert {tuple(r) for r in links.distinct_edges(df).collect()} == {(1, 2, 3), (1, 1, 1), (2, 3, 1)}
    assert {tuple(r) for r in links.degrees(df).collect()} == {(1, 1, 0), (2, 1, 1), (3, 0, 1)}
    assert links.degrees(df.where(F.lit(False))).count() == 0
