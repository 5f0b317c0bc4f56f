"""Sources and sinks: Parquet tables, text files, JDBC, JSON documents, and the boundary to live fetching."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from webloom.schemas import FETCH_RESULTS


def load(spark: SparkSession, root: str, name: str, *columns) -> DataFrame:
    """Read ``root/name.parquet``, a file or a folder, pruned to ``columns`` when given."""
    df = spark.read.parquet(f"{root}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table under its declared schema: columns that the files lack read as null."""
    return spark.read.schema(schema).parquet(path)


def read_text_files(spark: SparkSession, path: str, limit: int = 2_097_152) -> DataFrame:
    """(path, body): whole files, robots and sitemaps for example; files above the size limit read as null, as a failed fetch does."""
    files = spark.read.format("binaryFile").load(path)
    body = F.when(F.col("length") <= limit, F.make_valid_utf8(F.col("content").cast("string")))
    return files.select("path", body.alias("body"))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, partitions: int, **options: str) -> DataFrame:
    """A relational table in parallel ranges of a numeric key."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=partitions, properties=options)


#: The largest body that is read, and the seconds after which a fetch is given up.
MAX_BODY, TIMEOUT_S = 5_242_880, 30.0


def guard(record: dict, seconds: float | None = None) -> dict:
    """A raw fetch (url, status_code, content_type, body as bytes, declared content_length) as a record of the fetch schema.

    Too slow or failed: a network error of status 0.  Status 429, no html, or a body above MAX_BODY: no
    html, with the message that says so.  Broken UTF-8 becomes replacement characters.
    """
    out = {k: record.get(k) for k in ("url", "status_code", "proxy_used", "fetched_at")} | {"html": None, "network_error": False, "error_message": None, "content_length": None}
    if record.get("network_error") or (seconds is not None and seconds > TIMEOUT_S):
        return out | {"status_code": 0, "network_error": True, "error_message": record.get("error_message") or f"no answer within {TIMEOUT_S:g} s"}
    if record.get("status_code") == 429:
        return out | {"error_message": "RATE_LIMITED", "proxy_used": None}
    kind, body = record.get("content_type") or "", record.get("body") or b""
    if "text/html" not in kind and "application/xhtml" not in kind:
        return out
    if (record.get("content_length") or 0) > MAX_BODY or len(body) > MAX_BODY:
        return out | {"error_message": "BODY_TOO_LARGE", "proxy_used": None}
    return out | {"html": body.decode("utf-8", "replace"), "content_length": len(body)}


def fetch_urls(urls: DataFrame, fetcher: Callable[[list[str]], list[dict]], batch: int = 100) -> DataFrame:
    """Live fetching behind a boundary: ``fetcher`` takes URLs and returns records of the fetch schema (see ``guard`` for raw answers); called in the tasks."""
    names = [f.name for f in FETCH_RESULTS.fields if f.name not in ("fetch_id", "url_id")]
    schema = StructType([FETCH_RESULTS["url_id"], *[FETCH_RESULTS[n] for n in names]])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [r for at in range(0, len(frame), batch) for r in fetcher(frame["url"].iloc[at : at + batch].tolist())]
            yield pd.DataFrame({"url_id": frame["url_id"].tolist(), **{n: [r.get(n) for r in found] for n in names}})

    return urls.select("url_id", "url").mapInPandas(run, schema)


def append(df: DataFrame, path: str, *partition_by: str) -> None:
    """Append-only sink: a re-crawl adds rows."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_documents(documents: DataFrame, path: str, column: str = "document") -> None:
    """JSON documents, one to a line."""
    documents.select(column).write.mode("append").text(path)


def seed(spark: SparkSession, urls: list[str], session: str, max_depth: int = 3) -> DataFrame:
    """Jobs for seed URLs at depth 0."""
    from webloom.functions import urls as U
    from webloom.operators.control import job_id

    rows = spark.createDataFrame([(u,) for u in urls], "raw string").select(U.normalize(F.col("raw")).alias("url")).where("url is not null").dropDuplicates(["url"])
    rows = rows.withColumns({"url_hash": U.fingerprint(F.col("url")), "domain": U.hostname(F.col("url")), "session_id": F.lit(session), "depth": F.lit(0), "max_depth": F.lit(max_depth)})
    return rows.withColumns({"priority": F.lit(0), "retry_count": F.lit(0), "max_retries": F.lit(3), "state": F.lit("discovered"), "job_id": job_id(F.col("session_id"), F.col("url_hash"))})
