"""What is left of the pages table once the found rows and lines are gone."""

import pytest

from webloom.llm import queries


@pytest.mark.parametrize(("found", "left"), [("p1_found", "p1_kept"), ("p3_found", "p3_cleaned"), ("p7_found", "p7_main_body")])
def test_remaining_text(spark, data, found, left):
    pages = {r.page_id: r.content for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "content").collect()}
    gone = [tuple(r) for r in queries.QUERIES[found](spark, data).collect()]
    if found == "p1_found":
        rows = {(k,) for k, in gone}
        want = [(k, v) for k, v in pages.items() if (k,) not in rows]
    else:
        lines = {}
        for k, i in gone:
            lines.setdefault(k, set()).add(i)
        want = [(k, v if v is None else "\n".join(x for i, x in enumerate(v.split("\n")) if i not in lines.get(k, ()))) for k, v in pages.items()]
    got = [(r.page_id, r.content) for r in queries.QUERIES[left](spark, data).collect()]
    assert gone and sorted(got, key=repr) == sorted(want, key=repr)
