"""Problem 5: the most similar vectors of every vector.

A forest of random-projection trees: each node splits its part at the median of a random direction,
the difference of two randomly seeded centroids of the part.  The upper half of the levels is built
on the driver from a sample of SAMPLE vectors for each of its leaves, the lower half in tasks, one
for each upper leaf, so that every node of every level has seen that many vectors a leaf however
many vectors there are.  Every vector is indexed in every tree.

A query visits leaves in the order of one priority queue shared by all trees, cheapest first; the
cost of a leaf is the sum of the squared margins of the wrong turns on the way to it.  A child never
costs less than its parent, so the cheapest ``visits`` nodes of a level hold the cheapest ``visits``
leaves, and the queue runs level by level for a whole batch: the work for a vector grows with the
depth, not with the number of leaves.

The vectors of the visited leaves are ranked by single-precision products, and the best of them are
ranked again from the original vectors in double precision.  Whole subtrees are the unit of
distribution: a task holds the vectors of one subtree, and a query is sent once to each subtree that
has leaves it visits.  How many subtrees there are changes no result.  Equal vectors are indexed
once; their copies are put back at the end, so a vector repeated without limit grows no leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.session import materialize

TREES, VISITS = 2, 32
#: Vectors of a leaf, and at most of a subtree that one task holds (256 bytes each).
LEAF, SUBTREE = 1_024, 262_144
#: Vectors that the trees are built on, for each leaf.
SAMPLE = 64
#: Candidates of a subtree that are ranked again beyond the k best.
SPARE = 4
#: Unit vectors that agree to this many bits in every entry count as equal.
EQUAL_BITS = 22
#: Levels with at most so many nodes are multiplied as a whole instead of node by node.
WHOLE_LEVEL = 512


def pack(v: np.ndarray) -> pa.Array:
    """Rows of float32 as bytes, without loss: as half floats where these hold the same values."""
    with np.errstate(over="ignore"):
        half = v.astype("<f2")
    same = (half.astype(np.float32) == v).all(1)
    return pa.array([h.tobytes() if s else x.tobytes() for h, x, s in zip(half, v.astype("<f4"), same.tolist())], pa.binary())


def unpack(codes: pa.Array, dimensions: int) -> np.ndarray:
    raw = codes.to_pylist()
    half = np.array([len(x) == 2 * dimensions for x in raw], bool)
    if half.all():
        return np.frombuffer(b"".join(raw), "<f2").reshape(-1, dimensions).astype(np.float32)
    out = np.empty((len(raw), dimensions), np.float32)
    out[half] = np.frombuffer(b"".join(x for x, h in zip(raw, half) if h), "<f2").reshape(-1, dimensions)
    out[~half] = np.frombuffer(b"".join(x for x, h in zip(raw, half) if not h), "<f4").reshape(-1, dimensions)
    return out


def unit(v: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision; the squares of float32 entries neither overflow nor vanish in double."""
    wide = v.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def encode(df: DataFrame, key: str, vector: str, dimensions: int, codes: bool = True) -> DataFrame:
    """(id, a, b) and, with ``codes``, the packed vector ``code`` of the usable rows; equal directions have equal (a, b).

    A vector is usable if it has ``dimensions`` entries, all finite, and not all zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = np.random.default_rng(41).integers(0, 1 << 63, (2, dimensions), np.int64) | 1
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            offsets = lists.offsets.to_numpy()
            right = np.flatnonzero((np.diff(offsets) == dimensions) & ~np.asarray(lists.is_null()))
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float32)
            v = flat[offsets[right][:, None] + np.arange(dimensions)] if len(right) else np.zeros((0, dimensions), np.float32)
            good = np.isfinite(v).all(1) & (v != 0).any(1)
            v, right = v[good], right[good]
            wide = v.astype(np.float64)
            wide /= np.linalg.norm(wide, axis=1, keepdims=True)
            steps = np.rint(wide * (1 << EQUAL_BITS)).astype(np.int64)
            with np.errstate(over="ignore"):
                a, b = (steps * factors[0]).sum(1), (steps * factors[1]).sum(1)
            columns = {"id": pa.array(ids.to_numpy(zero_copy_only=False)[right], pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | ({"code": pack(v)} if codes else {}))

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    return rows.mapInArrow(run, "id long, a long, b long" + (", code binary" if codes else ""))


def split(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """(direction, threshold) of a node: the difference of two centroids grown from two random members, and the median along it."""
    w = rng.normal(size=x.shape[1])
    if len(x) >= 4:
        a, b = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(8):
            near = x @ (a - b) > (a @ a - b @ b) / 2
            if near.all() or not near.any():
                break
            a, b = x[near].mean(0), x[~near].mean(0)
        if np.linalg.norm(a - b) > 1e-6:
            w = a - b
    w = (w / np.linalg.norm(w)).astype(np.float16)
    return w, float(np.median(x @ w.astype(np.float32))) if len(x) else 0.0


def grow(x: np.ndarray, depth: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """The levels of one tree over ``x``: directions and thresholds of the nodes, in order."""
    levels, parts = [], [np.arange(len(x))]
    for _ in range(depth):
        nodes = [split(x[part], rng) for part in parts]
        levels.append((np.array([w for w, _ in nodes], np.float16).reshape(len(nodes), -1), np.array([t for _, t in nodes], np.float32)))
        sides = [x[part] @ w.astype(np.float32) > t for part, (w, t) in zip(parts, nodes)]
        parts = [p for part, side in zip(parts, sides) for p in (part[~side], part[side])]
    return levels


class Forest:
    """All trees, level by level: the nodes of one level of all trees side by side; node i has the children 2i and 2i + 1."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], trees: int):
        self.levels = [(w.astype(np.float32), t) for w, t in levels]
        self.trees, self.depth = trees, len(levels)

    def visits(self, x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(the ``count`` cheapest leaves of all trees, the own leaf in each tree); leaf numbers run over all trees."""
        n = len(x)
        nodes = np.tile(np.arange(self.trees), (n, 1))
        own, cost = nodes.copy(), np.zeros((n, self.trees), np.float32)
        for w, t in self.levels:
            if len(t) <= WHOLE_LEVEL:
                all_ = x @ w.T - t
                m, o = np.take_along_axis(all_, nodes, 1), np.take_along_axis(all_, own, 1)
            else:
                m, o = ((w[c] @ x[:, :, None])[..., 0] - t[c] for c in (nodes, own))
            own = 2 * own + (o > 0)
            wrong = cost + m * m
            right = m > 0
            cost = np.stack([np.where(right, wrong, cost), np.where(right, cost, wrong)], 2).reshape(n, -1)
            nodes = np.stack([2 * nodes, 2 * nodes + 1], 2).reshape(n, -1)
            if nodes.shape[1] > count:
                keep = np.argpartition(cost, count - 1, 1)[:, :count]
                nodes, cost = np.take_along_axis(nodes, keep, 1), np.take_along_axis(cost, keep, 1)
        return nodes, own


def build_forest(sample: DataFrame, count: int, depth: int, trees: int, dimensions: int, each: int = SAMPLE, seed: int = 17) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of all trees from (id, code) rows, about ``each`` for a leaf.

    To the driver go ``each`` vectors for each leaf of the upper half of the levels (the square root
    of the whole) and then the finished nodes: 132 bytes for each leaf and tree at 64 dimensions.
    """
    spark = sample.sparkSession
    upper = math.ceil(depth / 2)
    share = min(1.0, each * 2**upper / max(1, count))
    few = sample.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)) < int(1_000_000 * share) + 1).orderBy("id").toArrow()
    x = unit(unpack(few["code"].combine_chunks(), dimensions))
    rng = np.random.default_rng(seed)
    roots = [grow(x, upper, rng) for _ in range(trees)]
    levels = [tuple(np.concatenate([r[i][j] for r in roots]) for j in (0, 1)) for i in range(upper)]
    if upper == depth:
        return levels
    shared = spark.sparkContext.broadcast((levels, trees))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(*shared.value)
        for batch in batches:
            if batch.num_rows:
                own = forest.visits(unit(unpack(batch.column(1), dimensions)), trees)[1]
                rows = np.repeat(np.arange(len(own)), trees)
                yield pa.RecordBatch.from_pydict({"part": pa.array(own.reshape(-1), pa.int32()), "id": batch.column(0).take(pa.array(rows)), "code": batch.column(1).take(pa.array(rows))})

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(part: int, held: list[np.ndarray]) -> pa.RecordBatch:
            made = grow(np.concatenate(held), depth - upper, np.random.default_rng([seed, part]))
            return pa.RecordBatch.from_pydict(
                {
                    "level": pa.array([upper + i for i, (w, _) in enumerate(made) for _ in w], pa.int32()),
                    "node": pa.array([(part << i) + j for i, (w, _) in enumerate(made) for j in range(len(w))], pa.int64()),
                    "direction": pa.array([d.tobytes() for w, _ in made for d in w], pa.binary()),
                    "threshold": pa.array(np.concatenate([t for _, t in made]), pa.float32()),
                }
            )

        now, held = None, []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now is not None and now != parts[a]:
                    yield close(now, held)
                    held = []
                now = int(parts[a])
                held.append(unit(unpack(batch.column(2).slice(a, b - a), dimensions)))
        if held:
            yield close(now, held)

    parts = trees << upper
    routed = sample.select("id", "code").mapInArrow(route, "part int, id long, code binary")
    placed = routed.repartition(min(parts, 2_000), "part").sortWithinPartitions("part", "id")
    table = placed.mapInArrow(lower, "level int, node long, direction binary, threshold float").toArrow()
    level, node = table["level"].to_numpy(), table["node"].to_numpy()
    directions = np.frombuffer(b"".join(table["direction"].to_pylist()), np.float16).reshape(-1, dimensions)
    thresholds = table["threshold"].to_numpy()
    for i in range(upper, depth):
        w = rng.normal(size=(trees << i, dimensions))  # where no vector of the sample came
        w, t = (w / np.linalg.norm(w, axis=1, keepdims=True)).astype(np.float16), np.zeros(trees << i, np.float32)
        mine = level == i
        w[node[mine]], t[node[mine]] = directions[mine], thresholds[mine]
        levels.append((w, t))
    return levels


def _spread(vectors: DataFrame, forest, visits: int, up: int, dimensions: int) -> DataFrame:
    """(subtree, guest, id, code, own, leaves): a vector at home in one subtree of each tree, a guest in the others it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Forest(*forest.value)
        for batch in batches:
            ids, codes = batch.column(0).to_numpy(), batch.column(1)
            for at in range(0, len(ids), 1024):
                part = codes.slice(at, 1024)
                leaves, own = trees.visits(unit(unpack(part, dimensions)), visits)
                n = len(part)
                leaves = np.concatenate([leaves, own], 1)
                rows = np.repeat(np.arange(n), leaves.shape[1])
                pairs = np.unique(rows * (1 << 32) + leaves.reshape(-1))
                rows, leaf = pairs >> 32, pairs & 0xFFFFFFFF
                tree = leaf >> up
                first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (tree[1:] != tree[:-1])])
                r, s = rows[first], tree[first]
                home = np.full(len(r), -1, np.int64)
                for t in range(own.shape[1]):
                    home = np.where(own[r, t] >> up == s, own[r, t], home)
                yield pa.RecordBatch.from_pydict(
                    {
                        "subtree": pa.array(s, pa.int32()),
                        "guest": pa.array(home < 0),
                        "id": pa.array(ids[at : at + 1024][r], pa.int64()),
                        "code": part.take(pa.array(r)),
                        "own": pa.array(home, pa.int32()),
                        "leaves": pa.ListArray.from_arrays(pa.array(np.r_[first, len(rows)], pa.int32()), pa.array(leaf, pa.int32())),
                    }
                )

    return vectors.mapInArrow(run, "subtree int, guest boolean, id long, code binary, own int, leaves array<int>")


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest entries of each row; exact, by the largest of strided groups of columns first."""
    n, m = sims.shape
    if m <= max(64, 32 * k):
        return np.argpartition(-sims, min(k, m) - 1, 1)[:, :k] if m > k else np.tile(np.arange(m), (n, 1))
    groups = m // 16
    cut = groups * 16
    peak = sims[:, :cut].reshape(n, 16, groups).max(1)
    best = np.argpartition(-peak, k - 1, 1)[:, :k]
    columns = (best[:, :, None] + np.arange(16) * groups).reshape(n, -1)
    if cut < m:
        columns = np.concatenate([columns, np.tile(np.arange(cut, m), (n, 1))], 1)
    chosen = np.argpartition(-np.take_along_axis(sims, columns, 1), k - 1, 1)[:, :k]
    return np.take_along_axis(columns, chosen, 1)


class _Subtree:
    """The vectors of one subtree by leaf, and the search among them."""

    def __init__(self, k: int):
        self.k = k
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.leaves: dict[int, tuple[int, int]] | None = None

    def add(self, ids: np.ndarray, v: np.ndarray, own: np.ndarray, counts: np.ndarray, values: np.ndarray) -> None:
        self.held.append((ids, v, own, counts, values))

    def close(self) -> None:
        self.leaves = {}
        if not self.held:
            return
        ids, v, own = (np.concatenate([h[i] for h in self.held]) for i in range(3))
        order = np.lexsort((ids, own))
        self.ids, self.v, own = ids[order], v[order], own[order]
        self.x, self.norms = unit(self.v), np.linalg.norm(self.v.astype(np.float64), axis=1)
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        self.leaves = {int(own[a]): (int(a), int(b)) for a, b in zip(starts, np.r_[starts[1:], len(own)])}

    def search(self, ids: np.ndarray, v: np.ndarray, counts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(one minus the cosine in units of 1e-12, neighbour) of the k best, nearest first; -1 where there are fewer."""
        k, n, x = self.k + SPARE, len(ids), unit(v)
        best_s, best_i = np.full((n, k), -3.0, np.float32), np.full((n, k), -1, np.int64)
        rows = np.repeat(np.arange(n), counts)
        order = np.argsort(values, kind="stable")
        rows, values = rows[order], values[order]
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else []
        for a, b in zip(starts, np.r_[starts[1:], len(values)] if len(values) else []):
            if int(values[a]) not in self.leaves:
                continue
            low, high = self.leaves[int(values[a])]
            for c in range(a, b, 2048):
                r = rows[c : min(b, c + 2048)]
                sims = x[r] @ self.x[low:high].T
                place = np.minimum(np.searchsorted(self.ids[low:high], ids[r]), high - low - 1)
                mine = self.ids[low + place] == ids[r]
                sims[np.flatnonzero(mine), place[mine]] = -3
                top = _top(sims, k)
                s = np.concatenate([best_s[r], np.take_along_axis(sims, top, 1)], 1)
                i = np.concatenate([best_i[r], low + top], 1)
                keep = np.argpartition(-s, k - 1, 1)[:, :k]
                best_s[r], best_i[r] = np.take_along_axis(s, keep, 1), np.take_along_axis(i, keep, 1)
        d, found = np.full((n, self.k), -1, np.int64), np.full((n, self.k), -1, np.int64)
        for at in range(0, n, 4096):
            at = slice(at, at + 4096)
            near, wide = best_i[at], v[at].astype(np.float64)
            real = best_s[at] > -2
            exact = np.einsum("nd,nkd->nk", wide, self.v[near].astype(np.float64)) / (np.linalg.norm(wide, axis=1)[:, None] * self.norms[near]) if self.leaves else np.zeros(near.shape)
            gap = np.where(real, np.rint((1 - exact) * 1e12).astype(np.int64), 1 << 62)
            names = np.where(real, self.ids[near], -1) if self.leaves else near
            order = np.lexsort((names, gap))[:, : self.k]
            d[at], found[at] = np.take_along_axis(gap, order, 1), np.take_along_axis(names, order, 1)
            found[at][d[at] == 1 << 62] = -1
        return np.maximum(d, 0), found


def _candidates(spread: DataFrame, dimensions: int, k: int, partitions: int) -> DataFrame:
    """(id, found array<struct<other long, d long>>) for each vector and subtree it visits."""
    fields = [pa.field("other", pa.int64()), pa.field("d", pa.int64())]

    def emit(ids: np.ndarray, d: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        ok = found != -1
        values = pa.StructArray.from_arrays([pa.array(found[ok], pa.int64()), pa.array(d[ok], pa.int64())], fields=fields)
        return pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "found": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(ok.sum(1))], pa.int32()), values)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, now = None, None

        def finish(t: _Subtree) -> Iterator[pa.RecordBatch]:
            if t.leaves is None:
                t.close()
                for ids, v, _, counts, values in t.held:
                    yield emit(ids, *t.search(ids, v, counts, values))
                t.held = []

        for batch in batches:
            key = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if now != (subtree := int(key[a]) >> 1):
                    if tree is not None:
                        yield from finish(tree)
                    tree, now = _Subtree(k), subtree
                ids, v, lists = part.column(2).to_numpy(), unpack(part.column(3), dimensions), part.column(5)
                counts, values = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
                if int(key[a]) & 1:
                    yield from finish(tree)
                    yield emit(ids, *tree.search(ids, v, counts, values))
                else:
                    tree.add(ids, v, part.column(4).to_numpy(), counts, values)
        if tree is not None:
            yield from finish(tree)

    placed = spread.repartitionById(partitions, F.col("subtree") % F.lit(partitions)).sortWithinPartitions("subtree", "guest")
    return placed.mapInArrow(run, "id long, found array<struct<other: long, d: long>>")


def nearest(
    df: DataFrame, key: str, vector: str, k: int = 5, dimensions: int = 64, trees: int = TREES, visits: int = VISITS, leaf: int = LEAF, subtree: int = SUBTREE, sample: int = SAMPLE
) -> DataFrame:
    """(id, found array<struct<d, other>>): about the k most similar rows of each usable row, nearest first.

    ``d`` is one minus the cosine in units of 1e-12; equal ones are settled by the smaller key.  Null,
    misshapen, non-finite and zero vectors take no part; equal vectors (in any length) count each;
    keys must be unique and not negative; other columns are ignored; an empty input gives no rows.
    """
    spark = df.sparkSession
    keys = encode(df, key, vector, dimensions, codes=False)
    # of equal vectors the k + 1 smallest keys say everything; the limit works before the shuffle too
    order = Window.partitionBy("a", "b").orderBy("id")
    firsts = materialize(keys.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1), "vectors")
    count = firsts.where("n = 1").count()
    if not count:
        return spark.createDataFrame([], "id long, found array<struct<d: long, other: long>>")
    groups = firsts.groupBy("a", "b").agg(F.array_sort(F.collect_list("id")).alias("ids")).where(F.size("ids") > 1)
    groups = materialize(groups.select(F.element_at("ids", 1).alias("rep"), "a", "b", "ids"), "copies")
    distinct = encode(df, key, vector, dimensions).join(groups.select("rep", "a", "b"), ["a", "b"], "left").where("rep is null or rep = id").select("id", "code")

    depth = max(0, round(math.log2(count / leaf)))
    share = min(1.0, sample * 2**depth / count)
    part = materialize(distinct.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * share) + 1), "sample")
    levels = build_forest(part, round(count * share), depth, trees, dimensions, sample)
    forest = spark.sparkContext.broadcast((levels, trees))
    wanted = max(count / subtree, spark.sparkContext.defaultParallelism / trees, 1)
    up = max(0, depth - math.ceil(math.log2(wanted)))
    found = _candidates(_spread(distinct, forest, visits, up, dimensions), dimensions, k, min(trees << (depth - up), 10_000))
    # at most k for each visited subtree; a pair that met in several trees is listed once
    merged = found.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("all"))
    once = F.filter("all", lambda x, i: (i == 0) | (F.get("all", i - 1)["other"] != x["other"]))
    ranked = F.array_sort(F.transform(once, lambda x: F.struct(x["d"].alias("d"), x["other"].alias("other"))))
    merged = materialize(merged.select("id", F.slice(ranked, 1, k).alias("found")), "nearest")

    pairs = merged.select("id", F.explode("found").alias("f")).select("id", "f.d", F.col("f.other").alias("rep"))
    wide = pairs.join(groups.select("rep", "ids"), "rep", "left").select("id", F.transform(F.coalesce("ids", F.array("rep")), lambda i: F.struct(F.col("d").alias("d"), i.alias("other"))).alias("found"))
    wide = wide.groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    own = groups.select(F.col("rep"), "ids", "a", "b").join(wide.withColumnRenamed("id", "rep"), "rep", "left")
    copied = own.select("a", "b", "ids", F.coalesce("found", F.array().cast("array<struct<d: long, other: long>>")).alias("others"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    rows = keys.select("id", "a", "b", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int").alias("salt"))
    copied = rows.join(copied, ["a", "b", "salt"]).select(
        "id",
        F.slice(
            F.array_sort(F.concat(F.transform(F.filter("ids", lambda i: i != F.col("id")), lambda i: F.struct(F.lit(0).cast("long").alias("d"), i.alias("other"))), "others")), 1, k
        ).alias("found"),
    )
    single = wide.join(groups.select(F.col("rep").alias("id")), "id", "left_anti")
    return single.unionByName(copied)


def neighbour_pairs(found: DataFrame) -> DataFrame:
    """(id_a, id_b), a < b: pairs of which one is among the nearest of the other."""
    pairs = found.select("id", F.explode("found.other").alias("other"))
    return pairs.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
