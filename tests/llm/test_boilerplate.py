from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.llm import boilerplate as B


@pytest.fixture(scope="module")
def tables(spark):
    root = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{root}/pages.parquet").select("page_id", "fetch_id", "content")
    return pages, spark.read.parquet(f"{root}/fetch_results.parquet").select("fetch_id", "html")


def test_viterbi_against_every_path():
    rng = np.random.default_rng(0)
    for _ in range(20):
        field = B.ChainField()
        field.t[:] = rng.normal(size=(3, 3))
        s = rng.normal(size=6)
        value = lambda y: field.t[2, y[0]] + sum(s[i] * y[i] for i in range(6)) + sum(field.t[a, b] for a, b in zip(y, y[1:])) + field.t[y[-1], 2]  # noqa: E731,B023
        assert tuple(field.viterbi(s.tolist())) == max(product((0, 1), repeat=6), key=value)


def test_marginals_against_every_path():
    rng = np.random.default_rng(1)
    field = B.ChainField()
    field.t[:] = rng.normal(size=(3, 3))
    field.w[:5] = rng.normal(size=5)
    page = [[0], [1, 2], [3], [4, 0]]
    s = field.scores(page)
    weight = {}
    for y in product((0, 1), repeat=4):
        weight[y] = np.exp(field.t[2, y[0]] + sum(s[i] * y[i] for i in range(4)) + sum(field.t[a, b] for a, b in zip(y, y[1:])) + field.t[y[-1], 2])
    z = sum(weight.values())
    got, trans = field._marginals(page)
    assert np.allclose(got, [sum(w for y, w in weight.items() if y[i]) / z for i in range(4)], atol=1e-4)
    assert np.isclose(trans[:2, :2].sum(), 3, atol=1e-4)


def test_held_out_pages(tables):
    pages, fetched = tables
    rows = pages.join(fetched, "fetch_id").where("content is not null and html is not null").orderBy("page_id").select("content", "html").collect()
    rows = [(r[0], r[1]) for r in rows if B.inspect(r[0])[0] is None]
    field = B.ChainField().fit(B.training_pages(rows[: len(rows) // 2]))
    right = total = 0
    for feats, labels in B.training_pages(rows[len(rows) // 2 :]):
        got = field.viterbi(field.scores(feats).tolist())
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert total > 1000 and right / total > 0.97


def test_operator(spark, tables):
    pages, fetched = tables
    body = "The garden was quiet in the morning. A careful reader found the path after a long walk."
    html = f"<html><body><div class='x1'><li><a href='/0'>Home</a></li><li><a href='/1'>Topics</a></li></div><div class='x2'><h1>Title</h1><p>{body}</p></div><div class='x3'><span>Share this article with your friends</span></div></body></html>"
    content = f"Home\nTopics\n\n{body}\nShare this article with your friends"
    extra = spark.createDataFrame([(-1, -1, content, "x"), (-2, -1, content, "x"), (-3, None, content, "x"), (-4, -1, None, "x"), (-5, -1, "", "x"), (-6, -1, "Page not found", "x")], "page_id long, fetch_id long, content string, html string")
    more = fetched.unionByName(spark.createDataFrame([(-1, html), (-9, None)], fetched.schema))
    field = B.fit_field(pages, fetched, "page_id", "fetch_id", "content", "html", 300)
    found = sorted((r.page_id, r.line_no) for r in B.find_boilerplate(extra, more, "page_id", "fetch_id", field=field).collect())
    assert [f for f in found if f[0] != -3] == [(-2, 0), (-2, 1), (-2, 4), (-1, 0), (-1, 1), (-1, 4)]
    assert (-3, 4) in found and (-3, 3) not in found
    assert B.find_boilerplate(extra.where("false"), more, "page_id", "fetch_id", field=field).count() == 0
    long = spark.createDataFrame([(1, 5, "\n".join([body] * 4000))], "page_id long, fetch_id long, content string")
    assert B.find_boilerplate(long, fetched.where(F.lit(False)), "page_id", "fetch_id", field=field).count() < 100


def test_lines_of_one_text_take_their_blocks_in_order(spark):
    body = "A careful reader found the path after a long walk."
    html = f"<html><body><div><li><a href='/a'>Old mills</a></li><li><a href='/b'>Home</a></li></div><main><h2>Old mills</h2><p>{body}</p></main><div><a href='/a'>Old mills</a><p>Legal</p></div></body></html>"
    blocks = B.page_blocks(html)
    keys = [b[0] for b in blocks]
    assert [b[4] for b in blocks] == ["Old mills", "Home", "Old mills", body, "Old mills", "Legal"]
    sizes = [len(b[4]) for b in blocks]
    for lines, want in (([b[4] for b in blocks], list(range(6))), (["Home", "Old mills", body, "Legal"], [1, 2, 3, 5]), (["Old mills", body, "Old mills", "Legal"], [2, 3, 4, 5]), (["Old mills"] * 4, None)):
        got = B.align(lines, keys, sizes)
        assert got == want or want is None and got[:3] == [0, 2, 4] and got[3] == 4
    shared = spark.sparkContext.broadcast((np.arange(B.WIDTH, dtype=np.float32), None))
    row = B.dom_table(spark.createDataFrame([(1, html)], "fetch_id long, html string"), "fetch_id", "html", shared).first()
    assert list(row.dom_keys) == keys and len(set(row.dom_scores[i] for i in (0, 2, 4))) == 3
    assert sum(B.training_pages([("\n".join(b[4] for b in blocks), html)])[0][1]) == 2


def test_deep_markup_is_closed_and_seen():
    deep = "<div class='outer'>" + "<div>" * 40 + "<p>Deep inside stands a line.</p>" + "</div>" * 40 + "</div><p>After it all.</p>"
    broken = "<table><tr><td>" + "<div>" * 30 + "<p>Cell text.</p></td></tr></table><p>Outside.</p>"
    blocks = B.leaf_blocks(f"<body>{deep}</body>")
    assert [(b[0], len(b[2])) for b in blocks] == [("Deep inside stands a line.", 42), ("After it all.", 1)] and blocks[0][2][1].names == ("outer",)
    assert [(b[0], len(b[2])) for b in B.leaf_blocks(f"<body>{broken}</body>")][1] == ("Outside.", 1)
    far = B.feature("name=outer")
    assert far in B.page_blocks(f"<body>{deep}</body>")[0][2]


def test_features_read_the_whole_line():
    line = " ".join(f"w{c}x" for c in "abcdefghijklmnopqrstuvwxyz" * 2)
    other = line + " cookies"
    assert B.feature("w=cookies") in B.text_features(other, 0, 1) and B.feature("w=wzx") in B.text_features(line, 0, 1)
