import numpy as np
import pytest

from webloom.llm import reading


@pytest.fixture(scope="module")
def anchors(spark):
    return [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.01/level_anchors.parquet").orderBy("anchor_id").select("reading_level", "text").collect()]


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(20):
        x, y = np.arange(7.0), rng.integers(1, 6, 7).astype(float)
        knots, values = reading.isotonic(x, y)
        fit = np.interp(x, knots, values)
        best = min(((np.array(p) - y) ** 2).sum() for p in _monotone(7, np.unique([y[i:j].mean() for i in range(7) for j in range(i + 1, 8)])))
        assert (np.diff(fit) >= -1e-9).all() and ((fit - y) ** 2).sum() <= best + 1e-6


def _monotone(n, levels, low=0):
    if not n:
        yield ()
        return
    for k in range(low, len(levels)):
        if n > 4 and k - low > 6:
            break
        for rest in _monotone(n - 1, levels, k):
            yield (levels[k], *rest)


def test_held_out_anchors(anchors):
    right = 0
    for fold in range(6):
        model = reading.train([a for i, a in enumerate(anchors) if i % 6 != fold])
        for level, text in anchors[fold::6]:
            right += int(np.floor(model.level(model.score(reading.english_prose(text)[1])) + 0.5)) == level
    assert right >= 57


def test_length_and_layout_weigh_nothing(anchors):
    model = reading.train(anchors)
    for level, text in anchors[::7]:
        for variant in (text * 3, text.replace("\n", " "), text.replace(". ", ".\n")):
            assert abs(model.level(model.score(reading.english_prose(variant)[1])) - level) < 0.5


def test_operator(spark, anchors):
    model = reading.train(anchors)
    level, text = next(a for a in anchors if len(a[1].split()) >= 100)
    german = "Die Bücherei im Süden hat die Gebühren gesenkt und der Verein ist nicht mit dem Plan zufrieden. " * 12
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, "too short"), (5, german), (6, text + "\n" + german.replace(". ", ".\n")[:300]), (7, text * 300)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "k long, body string, score string")
    found = sorted((r.k, r.reading_level) for r in reading.reading_levels(df, "k", "body", model).collect())
    assert found == [(1, level), (1, level), (6, level), (7, level)]
    assert reading.reading_levels(df.where("false"), "k", "body", model).count() == 0


def test_all_pairs_without_a_cap(anchors):
    graded = [(level, f"{text} Note {i}.") for i in range(14) for level, text in anchors]
    assert sum(a[0] > b[0] for a in graded for b in graded) > 250_000
    one, many = reading.train(anchors), reading.train(graded, rounds=60)
    for level, text in anchors[::9]:
        assert abs(many.level(many.score(reading.english_prose(text)[1])) - level) < 0.5 and abs(one.level(one.score(reading.english_prose(text)[1])) - level) < 0.5
