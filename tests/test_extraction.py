import pytest
from pyspark.sql import functions as F

from webloom.operators import extraction as E

PAGE = """<html lang="en"><head><title> A &amp; B </title><meta name="description" content=" D "><meta property="og:image" content="i.png"></head>
<body><nav><a href="/">Home</a></nav><article><h1>Big <b>one</b></h1><p>First long paragraph of the page, with quite some words in it.</p><p>Second paragraph, which is long enough to count as well.</p></article>
<footer><p><a href="/x">Legal</a></p></footer><time itemprop="datePublished" datetime="2024-05-01">May</time><span rel="author">Ann</span></body></html>"""


@pytest.mark.parametrize(
    ("url", "html", "needed"),
    [
        ("https://h.com", None, True), ("https://h.com", "", True), ("https://h.com", "x" * 199, True), ("https://h.com", "x" * 300, False), ("https://h.com/#/a", "x" * 300, True),
        ("https://h.com/app/x", "x" * 300, True), ("https://h.com", '<div id="root"> </div>' + "x" * 300, True), ("https://h.com", "docsify " + "x" * 300, True),
    ],
)
def test_needs_rendering(spark, url, html, needed):
    df = spark.createDataFrame([(url, html)], "u string, h string")
    assert df.select(E.needs_rendering(F.col("u"), F.col("h"))).collect()[0][0] is needed


def test_parts_of_a_page(spark):
    df = spark.createDataFrame([(PAGE,), ("<p>none</p>",)], "h string")
    h = F.col("h")
    rows = df.select(E.page_title(h), E.page_heading(h), E.page_description(h), E.body_text(h)).collect()
    assert tuple(rows[0])[:3] == ("A & B", "Big one", "D") and rows[0][3].startswith("Big oneFirst long")
    assert tuple(rows[1])[:3] == ("", "", "")


def test_meta_fallbacks(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, '<meta property="og:description" content="o"><meta name="description" content=" ">')], "k int, h string")
    found = {r.k: r for r in E.extract_meta(df, "k", "h").collect()}
    assert (found[1].description, found[1].author, found[1].published, found[1].og_image, found[1].lang) == ("D", "Ann", "2024-05-01", "i.png", "en")
    assert found[2].author is None and found[3].description == "o"


def test_main_text(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>short</p>"), (3, None)], "k int, h string")
    found = {r.k: r for r in E.extract_main(df, "k", "h").collect()}
    assert found[1].content.split("\n")[0].startswith("First long") and "Legal" not in found[1].content
    assert found[2].content is None and 3 not in found
