from pyspark.sql import functions as F

from webloom import schemas
from webloom.operators import frontier
from webloom.operators.order import running
from webloom.sources import tables


def test_declared_schemas_fit_the_tables(spark, data):
    for name, schema in (("urls", schemas.URLS), ("pages", schemas.PAGES), ("chunks", schemas.CHUNKS), ("fetch_results", schemas.FETCH_RESULTS), ("crawl_sessions", schemas.CRAWL_SESSIONS), ("links", schemas.LINKS)):
        found = spark.read.parquet(f"{data}/{name}.parquet")
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in schema], name


def test_missing_columns_read_as_null(spark, tmp_path):
    spark.range(2).select(F.col("id").alias("url_id")).write.parquet(str(tmp_path / "old"))
    assert tables.read_table(spark, str(tmp_path / "old"), schemas.URLS).where("url is null").count() == 2


def test_text_files(spark, tmp_path):
    (tmp_path / "robots.txt").write_bytes(b"User-agent: *\n\xff")
    (tmp_path / "big.txt").write_bytes(b"x" * 50)
    found = {r.path.rsplit("/", 1)[1]: r.body for r in tables.read_text_files(spark, str(tmp_path), limit=20).collect()}
    assert found == {"robots.txt": "User-agent: *\n�", "big.txt": None}


def test_live_fetch_boundary(spark):
    df = spark.createDataFrame([(1, "https://h.com"), (2, "https://k.org")], "url_id long, url string")
    found = tables.fetch_urls(df, lambda urls: [{"url": u, "status_code": 200, "html": "<p>"} for u in urls], batch=1)
    assert {(r.url_id, r.url, r.status_code, r.error_message) for r in found.collect()} == {(1, "https://h.com", 200, None), (2, "https://k.org", 200, None)}


def test_seeds(spark):
    found = tables.seed(spark, ["https://Example.com/a/", "https://example.com/a", "bad"], "s").collect()
    assert [(r.url, r.domain, r.depth, r.state) for r in found] == [("https://example.com/a", "example.com", 0, "discovered")]


def test_append_and_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"a":1}')], "k int, document string")
    for _ in range(2):
        tables.append(df, str(tmp_path / "t"), "k")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    tables.write_documents(df, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).collect()[0].a == 1


def test_running_sums_of_any_partitioning(spark):
    rows = [("a" if i % 3 else None, i % 7, i, None if i % 11 == 0 else i) for i in range(200)] + [("hot", 1, 1000 + i, 1) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o int, id int, v int")
    want = {}
    for g in {r[0] for r in rows}:
        total = 0
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            want[r[2]] = (n, total)
            total += r[3] or 0
    for n in (1, 5):
        found = running(df, ["g"], [F.col("o").desc(), F.col("id").asc()], "v", n).collect()
        assert {r.id: (r.position, r.before) for r in found} == want
    assert running(df.where("id < 0"), ["g"], [F.col("id").asc()]).count() == 0


def test_integrity_and_cascade(spark):
    child = spark.createDataFrame([(1, 1), (2, 5), (3, None)], "id int, url_id int")
    parent = spark.createDataFrame([(1,)], "url_id int")
    assert sorted(r.id for r in frontier.orphans(child, parent, "url_id").collect()) == [2, 3]
    assert sorted(r.id for r in frontier.cascade_delete(child, parent, "url_id").collect()) == [2, 3]
