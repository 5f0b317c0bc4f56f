import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webloom.functions import urls as U

NORMAL = [
    ("https://Example.com/product?id=1&utm_source=ads", "https://example.com/product?id=1"),
    ("https://coinmarketcap.com/currencies/bitcoin/", "https://coinmarketcap.com/currencies/bitcoin"),
    ("https://h.com/?b=2&a=1#top", "https://h.com/?a=1&b=2"),
    ("https://h.com/", "https://h.com"),
    ("https://h.com:443/a/../b/", "https://h.com/b"),
    ("https://h.com/?utm_term=x", "https://h.com/?utm_term=x"),
    ("https://h.com/?UTM_SOURCE=x", "https://h.com/?UTM_SOURCE=x"),
    ("https://h.com/?ref=x", "https://h.com"),
    ("https://h.com/#/cloud", "https://h.com"),
    ("https://h.com/?q=a%20b", "https://h.com/?q=a+b"),
    ("https://h.com/?B=1&a=2&A=3&b=4", "https://h.com/?a=2&A=3&b=4&B=1"),
    ("https://u:p@h.com:8080/x?k=2&k=1", "https://u:p@h.com:8080/x?k=2&k=1"),
    ("not a url", None),
    ("", None),
    (None, None),
]


def values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, url string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_normal_form(spark):
    assert values(spark, [a for a, _ in NORMAL], U.normalize(F.col("url"))) == [b for _, b in NORMAL]


def test_fingerprint_of_normal_form(spark):
    found = values(spark, [NORMAL[0][0]], U.fingerprint(U.normalize(F.col("url"))))
    assert found == ["543fb921a42dc1f2b8d153e3ff891183901e139e7cd0f70d6a0f6a462036bc8a"]


@pytest.mark.parametrize(
    ("path", "kind"),
    [("/product/1", "detail"), ("/items?page=2", "detail"), ("/c?page=2", "listing"), ("/blog/list", "listing"), ("/news/1", "article"), ("/en/825", "unknown")],
)
def test_class(spark, path, kind):
    assert values(spark, ["https://h.com" + path], U.classify(F.col("url"))) == [kind]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["http", "https"]), st.from_regex(r"[a-z]{1,5}\.[a-z]{2}", fullmatch=True), st.from_regex(r"(/[a-zA-Z0-9._-]{0,4}){0,4}", fullmatch=True), st.from_regex(r"(\?[a-z]=[a-z0-9+]{0,3}(&[A-Z]=%20)?)?", fullmatch=True)), min_size=200, max_size=200))
def test_normal_form_is_stable(spark, parts):
    rows = [f"{s}://{h}{p}{q}" for s, h, p, q in parts]
    df = spark.createDataFrame([(r,) for r in rows], "url string").select(U.normalize(F.col("url")).alias("n"))
    assert df.where(U.normalize(F.col("n")) != F.col("n")).count() == 0


def test_proxy_parts(spark):
    found = values(spark, ["http://us%40er:p%3Ass@proxy.net:3128/", "socks5://proxy.net"], U.proxy_parts(F.col("url")))
    assert [tuple(f) for f in found] == [("http://proxy.net:3128", "us@er", "p:ss"), ("socks5://proxy.net", None, None)]
