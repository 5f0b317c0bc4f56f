import pytest
from pyspark.sql import functions as F

from webloom.llm import language


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")


@pytest.fixture(scope="module")
def net(docs):
    return language.fit_network([(docs.where(F.pmod("doc_id", F.lit(4)) != 0), "doc_id", "lang", "text")], rows=120)


def test_label_codes():
    given = {"en": "en", "en-US": "en", "EN_gb": "en", " de ": "de", "mul": None, "x-default": None, "": None, None: None, "und": None}
    assert {k: language.label_code(k) for k in given} == given


def test_held_out_accuracy(docs, net):
    labeller = language.Labeller(net)
    rows = docs.where("doc_id % 4 = 0 and length(text) > 300").collect()
    rows = [(language.label_code(r.lang), r.text) for r in rows if language.label_code(r.lang) in language.LANGUAGES]
    right = sum(labeller.document(t)[0] == c for c, t in rows)
    assert len(rows) > 100 and right / len(rows) > 0.97


def test_mixed_lines_and_quotations(spark, net, docs):
    english = docs.where("lang = 'en' and length(text) between 500 and 3000").orderBy("doc_id").first().text
    german = docs.where("lang = 'de' and length(text) > 500").orderBy("doc_id").first().text.split("\n")[0]
    quoted = english.split("\n")[0] + " A sign at the door reads “Die Stadtwerke bleiben heute leider den ganzen Tag geschlossen”."
    text = english + "\n" + german + "\n" + quoted
    n = len(english.split("\n"))
    rows = [(1, "de", text, 1), (1, "de", text, 1), (2, "en", english, 1), (3, None, None, 1), (4, "xx", "", 1), (5, "en", "12 34\n--", 1), (6, "en_GB", english * 200, 1)]
    df = spark.createDataFrame(rows, "k long, lang string, body string, confidence int")
    found = language.label_languages(df, "k", "lang", "body", net).collect()
    by = {r.k: r for r in found}
    assert len(found) == 7 and by[1].lang == "en" and by[1].label_wrong and [(s.line_no, s.lang) for s in by[1].segments] == [(n, "de")]
    assert not by[2].label_wrong and by[3].lang is None and by[4].lang is None and by[5].lang is None and not by[6].label_wrong
    assert language.label_languages(df.where("false"), "k", "lang", "body", net).count() == 0


def test_windows_cover_every_byte():
    for n in (0, 1, 64, 65, 128, 1000):
        raw = bytes(i % 251 for i in range(n))
        w = language.windows(raw)
        assert w.shape[1] == language.WINDOW and set(raw) <= set(w.reshape(-1).tolist())


def test_gradient(net):
    """The network learns a rule that only its convolutions can see."""
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.integers(97, 123, (800, language.WINDOW)).astype(np.uint8)
    y = rng.integers(0, 2, 800)
    for row, label in zip(x, y):
        at = rng.integers(0, language.WINDOW - 3)
        row[at : at + 3] = list(b"zqx" if label else b"xqz")
    model = language.ByteNet().fit(x[:600], y[:600], epochs=25)
    assert (model.log_probabilities(x[600:]).argmax(1) == y[600:]).mean() > 0.9


def test_no_labels(spark):
    df = spark.createDataFrame([(1, None, "text")], "k long, lang string, body string")
    assert isinstance(language.fit_network([(df, "k", "lang", "body")]), language.ByteNet)


def test_left_out_are_exactly_the_misread_and_residue_pages(spark, data):
    from webloom.llm import queries, residue

    pages = spark.read.parquet(f"{data}/pages.parquet").where("content is not null").select("page_id", "content").collect()
    misread = {r.record_id for r in queries.p2_found(spark, data).collect() if r.record_kind == "page"}
    gone = misread | {r.page_id for r in pages if residue.inspect(r.content)[0]}
    assert misread and {r.page_id for r in queries.p4_labels(spark, data).collect()} == {r.page_id for r in pages} - gone
