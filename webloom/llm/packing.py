"""Problem 8: filling containers of fixed capacity with items of varying length.

The global histogram of lengths goes to the driver (at most ``capacity`` bins, whatever the
corpus).  Dynamic programming chooses the bucket bounds that minimise padding up to the bound.
Token-budget batches form inside each bucket: a container takes as many items of the bucket as its
capacity holds.  Long items leave room that no item of their own bucket fits into, so the rest of a
container is topped up with batches of smaller buckets, best fit first; without that step (``top_up
=False``) the pure method leaves far more space unused.  The plan is a list of runs (bucket, first
rank, count, first container), and an item finds its container by its rank inside its bucket.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.operators.order import running

BUCKETS = 128


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
    """Upper bounds of at most ``buckets`` buckets with least total padding; optimal, by the convex hull form of the recurrence."""
    n = len(lengths)
    if n <= buckets:
        return lengths.copy()
    cum = np.r_[0, np.cumsum(counts)].tolist()
    total = np.r_[0, np.cumsum(counts * lengths)].tolist()
    high = lengths.tolist()
    best = [high[j - 1] * cum[j] - total[j] if j else 0 for j in range(n + 1)]
    choices = []
    for _ in range(buckets - 1):
        following, choice = [0] * (n + 1), [0] * (n + 1)
        hull: list[tuple[int, int, int]] = []  # slope, intercept, index; slopes fall
        head = 0
        for j in range(n + 1):
            if j:
                x = high[j - 1]
                while head + 1 < len(hull) and hull[head + 1][0] * x + hull[head + 1][1] <= hull[head][0] * x + hull[head][1]:
                    head += 1
                slope, cut, i = hull[head]
                following[j] = slope * x + cut + x * cum[j] - total[j]
                choice[j] = i
            m, c = -cum[j], best[j] + total[j]
            while len(hull) - head >= 2 and (c - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - m):
                hull.pop()
            hull.append((m, c, j))
        best = following
        choices.append(choice)
    bounds, j = [], n
    for choice in reversed(choices):
        bounds.append(high[j - 1])
        j = choice[j]
        if not j:
            break
    if j:
        bounds.append(high[j - 1])
    return np.array(sorted(set(bounds)))


def plan_batches(bounds: np.ndarray, counts: np.ndarray, capacity: int, top_up: bool = True) -> tuple[list[tuple[int, int, int, int]], int]:
    """([(bucket, first rank, count, first container)], containers): a run puts one item into each of ``count`` containers in a row."""
    runs: list[tuple[int, int, int, int]] = []
    opened = 0
    rooms: list[int] = []  # rooms with open containers, ascending
    ranges: dict[int, list[tuple[int, int]]] = {}

    def give(room: int, start: int, count: int) -> None:
        if room <= 0 or count <= 0 or not top_up:
            return
        if room not in ranges:
            bisect.insort(rooms, room)
            ranges[room] = []
        held = ranges[room]
        if held and held[-1][0] + held[-1][1] == start:
            held[-1] = (held[-1][0], held[-1][1] + count)
        else:
            held.append((start, count))

    for bucket in range(len(bounds) - 1, -1, -1):
        size, left, rank = int(bounds[bucket]), int(counts[bucket]), 0
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                break
            room = rooms[at]
            start, count = ranges[room].pop()
            if not ranges[room]:
                del ranges[room], rooms[at]
            deep = min(room // size, max(1, left // max(1, min(count, left))))
            width = min(count, left)
            if width < count:
                give(room, start + width, count - width)
            for _ in range(deep):
                runs.append((bucket, rank, width, start))
                rank += width
            left -= width * deep
            give(room - size * deep, start, width)
        if left:
            fits = capacity // size
            whole, rest = divmod(left, fits)
            for layer in range(fits):
                width = whole + (layer < rest)
                if width:
                    # the last container, which is not full, takes one of each of the first layers
                    runs.append((bucket, rank, width, opened))
                    rank += width
            give(capacity - size * fits, opened, whole)
            if rest:
                give(capacity - size * rest, opened + whole, 1)
            opened += whole + (rest > 0)
    return runs, opened


def pack(items: DataFrame, key: str, size: str, containers: dict[str, int], buckets: int = BUCKETS, top_up: bool = True) -> DataFrame:
    """(container_kind, container, key, piece, tokens): every item of every size into containers of each kind.

    An item above the capacity is divided into full pieces and a rest; no other item is divided.
    Items of null or no size need no container and have no row.  Keys must be unique.  Containers of
    a kind are numbered from 0: those of the plan first, then those that hold a full piece each.
    """
    spark = items.sparkSession
    kinds = F.create_map(*[x for k, c in containers.items() for x in (F.lit(k), F.lit(int(c)))])
    rows = items.where(F.col(size) > 0).select(F.col(key).alias("key"), F.col(size).cast("long").alias("size"), F.explode(kinds).alias("kind", "capacity"))
    rests = rows.select("key", "kind", "capacity", "size", F.pmod("size", "capacity").alias("rest")).where("rest > 0")
    histogram: dict[str, list[tuple[int, int]]] = {k: [] for k in containers}
    for r in rests.groupBy("kind", "rest").count().collect():  # at most the capacities' sum of rows
        histogram[r["kind"]].append((r["rest"], r["count"]))
    plans, opened = {}, {}
    for kind, capacity in containers.items():
        pairs = sorted(histogram[kind])
        lengths, counts = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
        bounds = bucket_bounds(lengths, counts, buckets) if len(pairs) else np.zeros(0, np.int64)
        place = np.searchsorted(bounds, lengths)
        runs, opened[kind] = plan_batches(bounds, np.bincount(place, counts, len(bounds)).astype(np.int64) if len(pairs) else counts, int(capacity), top_up)
        lookup: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for bucket in {r[0] for r in runs}:
            own = sorted((r[1], r[3]) for r in runs if r[0] == bucket)
            lookup[bucket] = (np.array([a for a, _ in own]), np.array([b for _, b in own]))
        plans[kind] = (bounds, lookup)
    shared = spark.sparkContext.broadcast(plans)

    def buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, kind = batch.column(2).to_numpy(), batch.column(1).to_pylist()
            bucket = np.zeros(len(rest), np.int32)
            for name, (bounds, _) in shared.value.items():
                mine = np.array([k == name for k in kind], bool)
                bucket[mine] = np.searchsorted(bounds, rest[mine])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket, pa.int32())], names=[*batch.schema.names, "bucket"])

    shape = f"key {dict(items.dtypes)[key]}, kind string, rest long, size long, capacity int"
    bucketed = rests.select("key", "kind", F.col("rest").cast("long"), "size", F.col("capacity").cast("int")).mapInArrow(buckets_of, shape + ", bucket int")
    ranked = running(bucketed, ["kind", "bucket"], [F.xxhash64("key").asc(), F.col("key").asc()])

    def place_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds_, bucket, rank = batch.column(1).to_pylist(), batch.column(5).to_numpy(), batch.column(6).to_numpy() - 1
            out = np.zeros(len(rank), np.int64)
            names = list(shared.value)
            number = {k: i for i, k in enumerate(names)}
            cell = np.array([number[k] for k in kinds_], np.int64) << 32 | bucket
            for value in np.unique(cell):
                mine = np.flatnonzero(cell == value)
                first, start = shared.value[names[value >> 32]][1][int(value & 0xFFFFFFFF)]
                run = np.searchsorted(first, rank[mine], "right") - 1
                out[mine] = start[run] + rank[mine] - first[run]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "container"])

    placed = ranked.select("key", "kind", "rest", "size", "capacity", "bucket", "position").mapInArrow(place_of, shape + ", bucket int, position long, container long")
    placed = placed.select(F.col("kind").alias("container_kind"), "container", F.col("key").alias(key), F.floor(F.col("size") / F.col("capacity")).cast("int").alias("piece"), F.col("rest").alias("tokens"))
    whole = rows.where(F.col("size") >= F.col("capacity")).select("key", "kind", "capacity", F.floor(F.col("size") / F.col("capacity")).cast("int").alias("pieces"))
    whole = running(whole, ["kind"], [F.col("key").asc()], "pieces")
    base = F.create_map(*[x for k, n in opened.items() for x in (F.lit(k), F.lit(n))])
    whole = whole.select(
        F.col("kind").alias("container_kind"), (base[F.col("kind")] + F.col("before")).alias("first"), F.col("key").alias(key), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.col("capacity").cast("long").alias("tokens")
    )
    return placed.unionByName(whole.select("container_kind", (F.col("first") + F.col("piece")).alias("container"), key, "piece", "tokens"))


def fill_report(packed: DataFrame, containers: dict[str, int]) -> DataFrame:
    """(container_kind, containers, items, tokens, fullest, fill): how full the containers are."""
    kinds = F.create_map(*[x for k, c in containers.items() for x in (F.lit(k), F.lit(int(c)))])
    each = packed.groupBy("container_kind", "container").agg(F.sum("tokens").alias("t"), F.count("*").alias("i"))
    total = each.groupBy("container_kind").agg(F.count("*").alias("containers"), F.sum("i").alias("items"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"))
    return total.withColumn("fill", F.col("tokens") / (F.col("containers") * kinds[F.col("container_kind")]))
