import random

import pytest
from pyspark.sql import functions as F

from webloom.llm import capping


@pytest.mark.parametrize(("count", "share"), [(3, None), (None, 0.02), (40, 0.1)])
def test_against_a_plain_sort(spark, count, share):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["hot"] * 5 + ["a", "b", None]), rnd.choice([None, 1, 2, 3]), "clash") for i in range(500)]
    df = spark.createDataFrame(rows, "id int, who string, score int, _keep string")
    limit = min(x for x in (count, max(1, int(500 * share + 1e-9)) if share else None) if x)
    want = set()
    for who in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == who), key=lambda r: (-(r[2] or 0), r[0]))
        want |= {r[0] for r in own[:limit]}
    kept, dropped = capping.cap_contributors(df, "who", [F.col("score").desc_nulls_last(), F.col("id").asc()], count, share)
    assert {r.id for r in kept.collect()} == want and {r.id for r in dropped.collect()} == set(range(500)) - want


def test_empty_and_ties(spark):
    df = spark.createDataFrame([], "id int, who string")
    assert [x.count() for x in capping.cap_contributors(df, "who", [F.col("id").asc()], 1)] == [0, 0]
    same = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a")], "id int, who string")
    assert [x.count() for x in capping.cap_contributors(same, "who", [F.col("id").asc()], 2)] == [2, 1]
    with pytest.raises(ValueError):
        capping.cap_contributors(same, "who", [F.col("id").asc()])
