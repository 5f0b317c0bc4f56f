import re

import pytest
from pyspark.sql import functions as F

from webloom.llm import encoding


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", F.lower(F.substring("lang", 1, 2)).alias("lang"))
    return docs.where("text is not null and length(text) > 200").cache()


@pytest.fixture(scope="module")
def model(corpus):
    return encoding.fit_pairs(corpus.select("text"))


def test_counts_against_a_plain_count(spark):
    texts = ["Été à Ж", "été", None, "plain", ""]
    want: dict = {}
    joined = "\n".join(t for t in texts if t and not t.isascii()).lower()
    for a, b in zip(joined, joined[1:]):
        if ord(a) > 127 or ord(b) > 127:
            key = int(encoding.symbols(encoding.code_points(a))[0]) * encoding.SIZE + int(encoding.symbols(encoding.code_points(b))[0])
            want[key] = want.get(key, 0) + 1
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    assert {r.pair: r.n for r in encoding.pair_counts(df).collect()} == want


@pytest.mark.parametrize(
    ("lang", "written", "read"),
    [("de", "utf-8", "cp1252"), ("fr", "utf-8", "latin-1"), ("es", "utf-8", "cp850"), ("fr", "utf-8", "mac_roman"), ("ru", "utf-8", "cp1251"), ("ru", "cp1251", "koi8_r"), ("ru", "koi8_r", "cp1251"), ("ru", "cp1251", "cp866"), ("ru", "cp1251", "latin-1")],
)
def test_round_trip(corpus, model, lang, written, read):
    restorer = encoding.Restorer(model)
    right = total = 0
    for (text,) in corpus.where(F.col("lang") == lang).orderBy("doc_id").select("text").limit(25).collect():
        for line in text.split("\n"):
            raw = line.encode(written, "ignore")
            clean = raw.decode(written)
            try:
                bad = raw.decode(read)
            except UnicodeDecodeError:
                bad = "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in raw)
            if sum(ord(c) > 127 for c in clean) < 4:
                continue
            total += 1
            right += restorer.text(bad)[0] == clean
    assert total > 20 and right / total > 0.85, (right, total)


@pytest.mark.parametrize(("written", "read"), [("cp1251", "latin-1"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251")])
def test_long_passages_are_judged_whole(corpus, model, written, read):
    restorer = encoding.Restorer(model)
    head = "ъщэц щъцэ хъщё ёъэщ цщъэ эъщц щёцъ ъэщё цъщэ ёщъц щэъц ъцёщ эцщъ щъёэ "  # says nothing in either reading
    body = " ".join(re.findall("[а-яё]{3,}", " ".join(r.text for r in corpus.where("lang = 'ru'").orderBy("doc_id").select("text").limit(5).collect())))[:600]
    clean = head + body
    bad = clean.encode(written).decode(read)
    assert len(head) > encoding.PROBE
    assert restorer.fix("", bad, "") == clean


def test_characters_map_by_themselves():
    text = "Ã©Ðàöø ÿабвґџ„…‰ \x81\x8d\x98 ║╚é"
    for read, written in encoding.ONE_BYTE:
        piece = "".join(c for c in text if encoding._encode(c, read) is not None)
        raw = encoding._encode(piece, read)
        characters = "".join(set(piece))
        mapped = encoding._encode(characters, read).decode(written, "replace")
        assert piece.translate(str.maketrans(characters, mapped)) == raw.decode(written, "replace")


def test_clean_text_stays(corpus, model):
    restorer = encoding.Restorer(model)
    texts = [r.text for r in corpus.select("text").limit(400).collect()]
    changed = [t for t in texts if restorer.text(t)[0] != t]
    assert len(changed) <= 4
    for line in ("PROMOÇÃO E ATENÇÃO", "СЛЕДИТЕ ЗА НАМИ НА ВСЕХ КАНАЛАХ", "If the accents show up as “Ã©” or “â€™”, the file was read with the wrong table.", "The classic symptom is “Ã¼” where a ü should stand."):
        assert restorer.text(line) == (line, 0, 0)


def test_operator(spark, model):
    rows = [(1, "Die BÃ¼cherei fÃ¼hrt GÃ¤ste", 7), (1, "Die BÃ¼cherei fÃ¼hrt GÃ¤ste", 7), (2, "plain", 7), (3, None, 7), (4, "", 7), (5, "mid� mal", 7), (6, "dÃ©jÃ\xa0 vu " * 20_000, 7)]
    df = spark.createDataFrame(rows, "k long, body string, restored long")
    found = sorted((r.k, r.restored[:25], r.lost) for r in encoding.restore(df, "k", "body", model).collect())
    assert found == [(1, "Die Bücherei führt Gäste", 0), (1, "Die Bücherei führt Gäste", 0), (5, "mid� mal", 1), (6, "déjà vu déjà vu déjà vu d", 0)]
    empty = df.where("false")
    assert encoding.restore(empty, "k", "body", encoding.fit_pairs(empty.select("body"))).count() == 0


@pytest.mark.parametrize(
    ("lang", "written", "read", "copies"),
    [("fr", "utf-8", "cp1252", False), ("de", "utf-8", "latin-1", False), ("ru", "utf-8", "cp1252", False), ("ru", "utf-8", "cp1251", False), ("ru", "utf-8", "cp866", False), ("fr", "utf-8", "cp1252", True)],
)
def test_a_third_of_the_rows_misread(spark, corpus, lang, written, read, copies):
    clean = [r.text for r in corpus.orderBy("doc_id").select("text").limit(600).collect()]
    source = [r.text for r in corpus.where(F.col("lang") == lang).orderBy("doc_id").select("text").limit(300).collect()]

    def misread(text):
        return "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in text.encode(written))

    source = [t for t in source if sum(ord(c) > 127 for c in t) >= 4]
    bad = [misread(t) for t in (source[:1] * 300 if copies else (source * 300)[:300])]
    texts = spark.createDataFrame([(t,) for t in clean + bad], "t string").repartition(4)
    restorer = encoding.Restorer(encoding.fit_pairs(texts))
    found = [restorer.text(t)[1] > 0 for t in bad]
    assert sum(found) >= 0.99 * len(found), sum(found)
    assert sum(restorer.text(t)[0] != t for t in clean) <= 12
