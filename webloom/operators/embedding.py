"""Embedding of chunks that have no vector yet, behind a pluggable embedder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.vectors import is_usable

Embedder = Callable[[list[str]], "list[list[float]]"]


def hashing_embedder(dimensions: int = 64) -> Embedder:
    """An offline embedder: signed counts of hashed words, of unit length; the same text always has the same vector."""
    import zlib

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = np.zeros(dimensions)
            for word in text.lower().split():
                h = zlib.crc32(word.encode())
                v[h % dimensions] += 1 if h >> 31 else -1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).astype(np.float32).tolist())
        return out

    return embed


def unembedded(chunks: DataFrame, limit: int | None = None) -> DataFrame:
    """Chunks without vector and model, by id; ``limit`` makes it the next batch of a queue."""
    rows = chunks.where(F.col("embedding_vector").isNull() & F.col("embedding_model").isNull())
    return rows.orderBy("chunk_id").limit(limit) if limit else rows


def embed_chunks(chunks: DataFrame, embedder: Embedder, model: str, key: str = "chunk_id", text: str = "input", batch: int = 50) -> DataFrame:
    """(key, embedding_vector, embedding_model): calls the embedder with at most ``batch`` texts at a time, in the tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors = [v for at in range(0, len(frame), batch) for v in embedder(frame[text].iloc[at : at + batch].tolist())]
            yield pd.DataFrame({key: frame[key], "embedding_vector": vectors, "embedding_model": model})

    return chunks.select(key, text).mapInPandas(run, f"{key} {dict(chunks.dtypes)[key]}, embedding_vector array<float>, embedding_model string")


def embed_queries(questions: list[str], embedder: Callable[..., list[list[float]]], kind: str = "search_query") -> list[list[float]]:
    """Vectors of search questions: an embedder that tells questions from documents takes ``kind`` as its second argument; blank questions have none."""
    import inspect

    told = len(inspect.signature(embedder).parameters) > 1
    asked = [q for q in questions if q and q.strip()]
    return (embedder(asked, kind) if told else embedder(asked)) if asked else []


def split_usable(vectors: DataFrame, vector: str, dimensions: int) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): vectors of the wrong length or with entries that are no finite numbers are kept apart, not read forever."""
    good = is_usable(F.col(vector), dimensions)
    return vectors.where(good), vectors.where(~good)


def apply_vectors(chunks: DataFrame, vectors: DataFrame, key: str = "chunk_id") -> DataFrame:
    """``chunks`` with vector and model taken from ``vectors`` where there is one; keys are unique on both sides."""
    v = vectors.select(F.col(key).alias("_k"), F.col("embedding_vector").alias("_v"), F.col("embedding_model").alias("_m"))
    joined = chunks.join(v, chunks[key] == F.col("_k"), "left")
    has = F.col("_k").isNotNull()
    return joined.withColumn("embedding_vector", F.when(has, F.col("_v")).otherwise(F.col("embedding_vector"))).withColumn("embedding_model", F.when(has, F.col("_m")).otherwise(F.col("embedding_model"))).drop("_k", "_v", "_m")
