import pytest
from pyspark.sql import functions as F

from webloom.functions.quality import PARTS
from webloom.operators import quality


def score(spark, text, html, published=None):
    df = spark.createDataFrame([(text, html, published)], "t string, h string, p string")
    return quality.score_content(df, F.col("t"), F.col("h"), F.col("p")).collect()[0]


@pytest.mark.parametrize(
    ("text", "html", "parts", "total", "kind", "flags", "passes"),
    [
        ("Hello world.", "<h1>Hello</h1><p>Hello world.</p>", (2, 20, 12, 7, 10, 2), 53, "article", ["STUB_CONTENT"], True),
        ("404 page", "<p>404 page</p>", (2, 20, 4, 1, 10, 2), 39, "error", ["STUB_CONTENT", "NO_HEADINGS", "ERROR_PAGE"], False),
    ],
)
def test_hand_derived(spark, text, html, parts, total, kind, flags, passes):
    r = score(spark, text, html)
    assert tuple(r[p] for p in PARTS) == parts
    assert (r.total, r.content_type, r.flags, r.passes) == (total, kind, flags, passes)


@pytest.mark.parametrize(("n", "points"), [(49, 2), (50, 8), (149, 8), (150, 14), (499, 14), (500, 18), (1999, 18), (2000, 20)])
def test_length_steps(spark, n, points):
    assert score(spark, "word " * n, "").length_score == points


def test_first_head_only_and_scripts(spark):
    html = "<head>" + "x" * 500 + "</head><body><script>" + "y" * 500 + "</script><style>z</style>ab</body>"
    r = score(spark, "ab", html)
    assert r.body_units == len("<body>ab</body>")


def test_wall_of_text_and_boilerplate(spark):
    r = score(spark, "word " * 60, "")
    assert "WALL_OF_TEXT" in r.flags and r.density_score == 2 and r.sentence_count == 1
    r = score(spark, "Cookie policy. Privacy policy. Terms of service. Click here. Learn more.", "")
    assert r.uniqueness_score == 2 and "BOILERPLATE_HEAVY" in r.flags


@pytest.mark.parametrize(("html", "published", "points"), [('<meta property="article:published_time">', None, 10), ("2024-01-31", None, 6), ("", "x", 6), ("", None, 2)])
def test_freshness(spark, html, published, points):
    assert score(spark, "text", html, published).freshness_score == points


def test_priced_navigation_passes(spark):
    html = "<li>a" * 11
    assert score(spark, "few words", html).content_type == "navigation"
    assert score(spark, "few words", html + " $5").content_type == "product"


@pytest.mark.parametrize("text", [None, ""])
def test_unscored(spark, text):
    r = score(spark, text, None)
    assert (r.total, r.flags, r.passes, r.length_score, r.content_type) == (0, [], False, None, None)


def test_lengths_count_utf16_units(spark):
    assert score(spark, "😀", "").text_units == 2
