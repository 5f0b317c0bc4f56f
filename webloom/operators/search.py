"""Exact vector search for a stated set of queries, and the context that is built from what it finds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from webloom.functions.vectors import is_usable
from webloom.operators.order import running

#: Queries of one scan of the rows, which are broadcast (at 64 dimensions 512 bytes each, so 32 MB), and those multiplied at a time.
BLOCK, AT_ONCE = 65_536, 1_024


def _matrix(column: pa.ChunkedArray | pa.Array, dimensions: int) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks).flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)


def nearest(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 5, metric: str = "l2", dimensions: int = 64, block: int = BLOCK) -> DataFrame:
    """(query, key, distance, rank): the k nearest usable rows of every query, exactly; ties by the smaller key.

    Queries (key, vector) are taken in blocks of a fixed size; each block is broadcast and meets
    every row once in numpy.  A task keeps a running best k for each query and sends those once.
    """
    spark = rows.sparkSession
    chosen = queries.select(F.col(key).cast("long").alias("q"), F.col(vector).alias("v"))
    total, out = chosen.count(), None
    ordered = running(chosen, [], [F.col("q").asc()]) if total > block else chosen.withColumn("position", F.lit(1))
    for first in range(0, max(total, 1), block):
        part = ordered.where((F.col("position") > first) & (F.col("position") <= first + block)) if total > block else ordered
        table = part.select("q", "v").toArrow()
        ids = table["q"].to_numpy()
        shared = spark.sparkContext.broadcast((ids, _matrix(table["v"], dimensions) if len(ids) else np.zeros((0, dimensions))))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, q = shared.value
            best = _Best(len(names), k)
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, v = batch.column(0).to_numpy(), _matrix(batch.column(1), dimensions)
                for at in range(0, len(names), AT_ONCE):
                    best.offer(slice(at, min(at + AT_ONCE, len(names))), keys, distances(q[at : at + AT_ONCE], v, metric))
            yield from best.rows(names)

        found = rows.select(F.col(key).cast("long"), F.col(vector)).mapInArrow(run, "query long, key long, distance double")
        out = found if out is None else out.unionAll(found)
    return _ranked(out, key, k)


def _ranked(found: DataFrame, key: str, k: int) -> DataFrame:
    ranked = found.where(~F.isnan("distance")).groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "key"))), 1, k).alias("top"))
    return ranked.select("query", F.posexplode("top").alias("rank", "t")).select("query", F.col("t.key").alias(key), F.col("t.distance").alias("distance"), (F.col("rank") + 1).alias("rank"))


def distances(q: np.ndarray, v: np.ndarray, metric: str) -> np.ndarray:
    """Of every query to every row; rows or queries without direction have no cosine."""
    if metric == "l2":
        return np.sqrt(np.maximum((q * q).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * (q @ v.T), 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1 - (q @ v.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(v, axis=1)[None, :])


class _Best:
    """The k least distances of each query so far, ties by the smaller key."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.d, self.keys = np.full((queries, k), np.inf), np.full((queries, k), -1, np.int64)
        self.filled = np.zeros((queries, k), bool)

    def offer(self, at, keys: np.ndarray, d: np.ndarray) -> None:
        d = np.where(np.isnan(d), np.inf, d)
        order = np.lexsort((np.broadcast_to(keys, d.shape), d))[:, : self.k] if d.shape[1] <= 4 * self.k else _best(d, keys, self.k)
        near, names = np.take_along_axis(d, order, 1), keys[order]
        d, names = np.concatenate([self.d[at], near], 1), np.concatenate([self.keys[at], names], 1)
        real = np.concatenate([self.filled[at], np.isfinite(near)], 1)
        order = np.lexsort((names, np.where(real, d, np.inf)))[:, : self.k]
        self.d[at], self.keys[at], self.filled[at] = (np.take_along_axis(x, order, 1) for x in (d, names, real))

    def rows(self, names: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(self.filled.any(1))
        for some in (at[i : i + 4096] for i in range(0, len(at), 4096)):
            ok = self.filled[some]
            yield pa.RecordBatch.from_pydict({"query": np.repeat(names[some], ok.sum(1)), "key": self.keys[some][ok], "distance": self.d[some][ok]})


def fit_cells(rows: DataFrame, key: str, vector: str, cells: int = 100, dimensions: int = 64, sample: int = 20_000, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Centroids of an inverted index by cosine, from at most ``sample`` usable rows, those of smallest hash of their key."""
    few = rows.where(is_usable(F.col(vector), dimensions)).select(key, vector).orderBy(F.xxhash64(key), key).limit(sample).toArrow()
    v = _unit(_matrix(few[vector], dimensions) if few.num_rows else np.zeros((0, dimensions)))
    if not len(v):
        return np.zeros((1, dimensions))
    centres = v[np.random.default_rng(seed).choice(len(v), min(cells, len(v)), replace=False)]
    for _ in range(rounds):
        own = (v @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, v)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), centres)
    return centres


def assign_cells(rows: DataFrame, vector: str, centres: np.ndarray, dimensions: int = 64) -> DataFrame:
    """``rows`` plus ``cell``, by which an index is laid out (``partitionBy("cell")``); rows without usable vector are left out."""
    good = rows.where(is_usable(F.col(vector), dimensions))
    shared, place = rows.sparkSession.sparkContext.broadcast(centres), good.columns.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = (_unit(_matrix(batch.column(place), dimensions)) @ shared.value.T).argmax(1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], names=[*batch.schema.names, "cell"])

    return good.mapInArrow(run, StructType([*good.schema.fields, StructField("cell", IntegerType())]))


def probe(index: DataFrame, queries: DataFrame, key: str, vector: str, centres: np.ndarray, k: int = 5, metric: str = "cosine", probes: int = 10, dimensions: int = 64) -> DataFrame:
    """(query, key, distance, rank): the k nearest rows among those of the ``probes`` cells next to each query.

    Queries are a stated set of at most BLOCK; more are given in blocks.  Only the cells that a query
    probes are read where the index is laid out by cell.
    """
    table = queries.where(is_usable(F.col(vector), dimensions)).select(F.col(key).cast("long").alias("q"), vector).limit(BLOCK + 1).toArrow()
    if table.num_rows > BLOCK:
        raise ValueError(f"give at most {BLOCK} queries at a time")
    ids, q = table["q"].to_numpy(), _matrix(table[vector], dimensions) if table.num_rows else np.zeros((0, dimensions))
    near = np.argsort(-(_unit(q) @ centres.T), 1)[:, :probes]
    shared = index.sparkSession.sparkContext.broadcast((ids, q, near))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q_, near_ = shared.value
        best = _Best(len(names), k)
        for batch in batches:
            cells, keys = batch.column(2).to_numpy(), batch.column(0).to_numpy()
            for cell in np.unique(cells):
                mine, asking = np.flatnonzero(cells == cell), np.flatnonzero((near_ == cell).any(1))
                if len(asking):
                    best.offer(asking, keys[mine], distances(q_[asking], _matrix(batch.column(1).take(pa.array(mine)), dimensions), metric))
        yield from best.rows(names)

    wanted = index.where(F.col("cell").isin(np.unique(near).tolist()))
    return _ranked(wanted.select(F.col(key).cast("long"), vector, "cell").mapInArrow(run, "query long, key long, distance double"), key, k)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _best(d: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    cut = np.partition(d, k - 1, 1)[:, k - 1 : k]
    out = np.empty((len(d), k), np.int64)
    for i, row in enumerate(d):
        near = np.flatnonzero(row <= cut[i])
        out[i] = near[np.lexsort((keys[near], row[near]))[:k]]
    return out


def context(found: DataFrame, group: str, rank: str, text: str) -> DataFrame:
    """(group, context): texts in rank order with a blank line between; a group holds at most the k rows of a search."""
    return found.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(rank, text))), lambda s: s[text]), "\n\n").alias("context"))


def prompt(context_text: Column, question: Column) -> Column:
    """The message for a chat model; sending it is left to the caller."""
    return F.concat(F.lit("Context:\n"), context_text, F.lit("\n\nQuestion:\n"), question)
