import datetime as dt

from webloom.operators.embedding import hashing_embedder
from webloom.streaming import jobs


def test_queue_dedup(spark, tmp_path):
    t = dt.datetime(2025, 1, 1)
    rows = [("https://h.com/a/", t), ("https://H.com/a", t), ("bad", t), ("https://h.com/b?ref=1", t)]
    spark.createDataFrame(rows, "url string, at timestamp").write.parquet(str(tmp_path / "in"))
    stream = jobs.read_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    jobs.append_stream(jobs.new_jobs(stream, "url", "at"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.normal for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["https://h.com/a", "https://h.com/b"]


def test_windows(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet").selectExpr("cast(ts as timestamp) as ts", "event_type")
    events.write.parquet(str(tmp_path / "in"))
    stream = jobs.read_stream(spark, str(tmp_path / "in"), events.schema)
    query = jobs.event_windows(stream, "ts", "event_type").writeStream.format("memory").queryName("w").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert spark.sql("select sum(n) from w").collect()[0][0] == events.count()


def test_embedding_loop(spark, tmp_path):
    rows = [(i, None, None, f"text {i}", None if i % 2 else "S") for i in range(7)] + [(99, [1.0], "m", "done", None)]
    df = spark.createDataFrame(rows, "chunk_id long, embedding_vector array<float>, embedding_model string, text string, section_heading string")
    df.write.parquet(str(tmp_path / "in"))
    stream = jobs.read_stream(spark, str(tmp_path / "in"), df.schema)
    query = jobs.embed_stream(stream, hashing_embedder(8), "h", 8, str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7 and spark.read.parquet(str(tmp_path / "bad")).count() == 0
