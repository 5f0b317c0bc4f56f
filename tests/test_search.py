import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.functions import vectors as V
from webloom.operators import embedding, search


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("block", [3, 1024])
def test_exact_search_in_blocks(spark, metric, block):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[300:310] = x[0]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>")
    found = search.nearest(rows, rows.where("id % 50 = 0"), "id", "v", 5, metric, 8, block).collect()
    y = x.astype(float)
    for q in range(0, 400, 50):
        d = np.linalg.norm(y - y[q], axis=1) if metric == "l2" else 1 - y @ y[q] / (np.linalg.norm(y, axis=1) * np.linalg.norm(y[q]))
        want = np.lexsort((np.arange(400), np.round(d, 9)))[:5].tolist()
        got = [r.id for r in sorted((r for r in found if r["query"] == q), key=lambda r: r["rank"])]
        assert [round(float(d[i]), 6) for i in got] == [round(float(d[i]), 6) for i in want]


def test_no_queries(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<float>")
    assert search.nearest(rows, rows.where("id = 5"), "id", "v", 5, "l2", 2).count() == 0


def test_distances_and_text_form(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0]), ([1.0, 0.0], [0.0, 2.0])], "a array<float>, b array<float>")
    found = df.select(V.l2_distance(F.col("a"), F.col("b")), V.cosine_distance(F.col("a"), F.lit(None).cast("array<float>"))).collect()
    assert [r[0] for r in found] == [5.0, 5.0**0.5] and found[0][1] is None
    assert df.where(V.from_text(V.to_text(F.col("a"))) == F.col("a")).count() == 2


def test_usable_vectors(spark):
    rows = [([1.0, 2.0],), ([1.0],), (None,), ([1.0, float("nan")],), ([1.0, float("inf")],), ([1.0, None],)]
    good, bad = embedding.split_usable(spark.createDataFrame(rows, "v array<float>"), "v", 2)
    assert (good.count(), bad.count()) == (1, 5)


def test_embedding_round(spark):
    chunks = spark.createDataFrame([(1, None, None, "a b"), (2, [1.0], "m", "c"), (3, None, None, "")], "chunk_id long, embedding_vector array<float>, embedding_model string, input string")
    made = embedding.embed_chunks(embedding.unembedded(chunks), embedding.hashing_embedder(16), "h", batch=1)
    found = {r.chunk_id: r for r in embedding.apply_vectors(chunks, made).collect()}
    assert found[2].embedding_model == "m" and len(found[1].embedding_vector) == 16 and abs(np.linalg.norm(found[1].embedding_vector) - 1) < 1e-6
    assert [r.chunk_id for r in embedding.unembedded(chunks, 1).collect()] == [1]


def test_context(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "q int, r int, t string")
    assert {tuple(r) for r in search.context(df, "q", "r", "t").collect()} == {(1, "a\n\nb"), (2, "c")}
