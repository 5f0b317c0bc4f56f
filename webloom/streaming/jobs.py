"""Structured Streaming forms: the job queue, bounded deduplication, the embedding loop, windowed event counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from webloom.functions import urls as U
from webloom.functions.vectors import is_usable
from webloom.operators.chunking import embedding_input
from webloom.operators.embedding import Embedder, embed_chunks


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """Files that arrive in a folder, as a queue."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def new_jobs(stream: DataFrame, url: str, at: str, late: str = "1 hour") -> DataFrame:
    """Jobs with normalised URL and hash, each hash once while the watermark holds its state."""
    rows = stream.withColumn("normal", U.normalize(F.col(url))).withColumn("hash", U.fingerprint(F.col("normal"))).where("hash is not null")
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(["hash"])


def event_windows(stream: DataFrame, at: str, kind: str, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Counts by window and kind; rows later than the watermark are left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def append_stream(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append to a Parquet sink; without ``every`` all that is there is processed, then the query ends."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start(path)


def embed_stream(chunks: DataFrame, embedder: Embedder, model: str, dimensions: int, out: str, rejected: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """The embedding loop: chunks without vectors come in, vectors go out, misshapen ones apart."""

    def step(batch: DataFrame, _: int) -> None:
        todo = batch.where("embedding_vector is null and embedding_model is null").select("chunk_id", embedding_input(F.col("text"), F.col("section_heading")).alias("input"))
        found = embed_chunks(todo, embedder, model).persist()
        good = is_usable(F.col("embedding_vector"), dimensions)
        found.where(good).write.mode("append").parquet(out)
        found.where(~good).write.mode("append").parquet(rejected)
        found.unpersist()

    writer = chunks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
