import heapq

import numpy as np
import pytest

from webloom.llm import neighbours


def clustered(n, seed=2, dims=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, dims))
    return centres[rng.integers(0, 40, n)] + rng.normal(size=(n, dims)) * rng.uniform(0.3, 1.2, (n, 1))


def plain(ids, v, k=5):
    """Brute force on the vectors as they are, in double precision."""
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    np.fill_diagonal(s, -9)
    order = np.lexsort((np.broadcast_to(ids, s.shape), -s))[:, :k]
    return {int(i): [int(ids[j]) for j in row] for i, row in zip(ids, order)}


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "chunk_id long, v array<float>, id int, found string")
    return {r.id: [f.other for f in r.found] for r in neighbours.nearest(df, "chunk_id", "v", **options).collect()}


def test_recall_against_brute_force(spark):
    v = clustered(4000).astype(np.float32)
    found = run(spark, [(i, x.tolist(), 1, "x") for i, x in enumerate(v)], leaf=100, subtree=500, visits=16)
    want = plain(np.arange(4000), v.astype(float))
    hits = sum(len(set(found[i]) & set(want[i])) for i in want)
    assert len(found) == 4000 and all(len(f) == 5 for f in found.values()) and hits / 20_000 > 0.9


def test_exact_when_every_leaf_is_visited(spark):
    v = clustered(600, 4).astype(np.float32)
    found = run(spark, [(i, x.tolist(), 1, "x") for i, x in enumerate(v)], leaf=100, visits=1000)
    want = plain(np.arange(600), v.astype(float))
    assert sum(found[i] == want[i] for i in want) > 590


def test_copies_without_limit_and_bad_rows(spark):
    v = clustered(300, 6).astype(np.float32)
    v[100:200] = v[7]  # a third of all rows
    v[250:253] = v[249] * 4
    v[250:253] = v[249]
    bad = [(1000, None), (1001, [1.0] * 63), (1002, [0.0] * 64), (1003, [float("nan")] + [1.0] * 63), (1004, [float("inf")] + [1.0] * 63), (1005, [])]
    rows = [(i, x.tolist(), 1, "x") for i, x in enumerate(v)] + [(i, x, 1, None) for i, x in bad]
    found = run(spark, rows, leaf=50, visits=1000)
    want = plain(np.arange(300), v.astype(float))
    assert set(found) == set(range(300))
    assert found[150] == [7, 100, 101, 102, 103] and found[7] == [100, 101, 102, 103, 104]
    assert all(found[i] == want[i] for i in range(100, 200))
    assert sum(found[i] == want[i] for i in want) > 295


@pytest.mark.parametrize("n", [0, 1, 2, 6])
def test_few_rows(spark, n):
    v = clustered(8, 1).astype(np.float32)[:n]
    found = run(spark, [(i, x.tolist(), 1, "x") for i, x in enumerate(v)])
    assert {i: sorted(f) for i, f in found.items() if f} == {i: sorted(set(range(n)) - {i})[:5] for i in range(n) if n > 1}


def test_top_of_rows():
    rng = np.random.default_rng(3)
    for m in (3, 20, 64, 65, 500, 1037):
        s = rng.normal(size=(50, m)).astype(np.float32)
        k = min(5, m)
        got = np.take_along_axis(s, neighbours._top(s, 5), 1)
        assert np.allclose(np.sort(got, 1), np.sort(s, 1)[:, -k:])


def test_the_queue_visits_what_a_heap_would():
    """The leaves of a best-first search with a heap over the nodes of all trees, one vector at a time."""
    rng = np.random.default_rng(8)
    x = neighbours.unit(clustered(3000, 9).astype(np.float32))
    roots = [neighbours.grow(x, 6, rng) for _ in range(3)]
    forest = neighbours.Forest([tuple(np.concatenate([r[i][j] for r in roots]) for j in (0, 1)) for i in range(6)], 3)
    chosen, own = forest.visits(x[:200], 20)
    for row, leaves, mine in zip(x[:200], chosen, own):
        heap, popped = [(0.0, 0, t) for t in range(3)], []
        while len(popped) < 20:
            cost, level, node = heapq.heappop(heap)
            if level == 6:
                popped.append((cost, node))
                continue
            w, t = forest.levels[level]
            m = float(w[node] @ row - t[node])
            near = int(m > 0)
            heapq.heappush(heap, (cost, level + 1, 2 * node + near))
            heapq.heappush(heap, (cost + m * m, level + 1, 2 * node + 1 - near))
        assert {n for c, n in popped if c < popped[-1][0] - 1e-5} <= set(leaves.tolist())
        assert set(mine.tolist()) <= {n for c, n in popped if c == 0}


def test_levels_built_in_tasks_are_balanced(spark):
    v = clustered(20_000, 3).astype(np.float32)
    sample = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<float>")
    codes = neighbours.encode(sample, "id", "v", 64).select("id", "code")
    levels = neighbours.build_forest(codes, 20_000, 8, 2, 64)
    own = neighbours.Forest(levels, 2).visits(neighbours.unit(v), 2)[1]
    assert [len(t) for _, t in levels] == [2 << i for i in range(8)]
    for t in range(2):
        sizes = np.bincount(own[:, t] - (t << 8), minlength=256)
        assert sizes.max() < 4 * sizes.mean() and (sizes == 0).mean() < 0.02


def test_packing_loses_nothing():
    v = clustered(50, 5).astype(np.float32)
    v[::2] = v[::2].astype(np.float16)
    v[1] *= np.float32(1e30)
    packed = neighbours.pack(v)
    assert len(packed[0].as_py()) == 128 and len(packed[1].as_py()) == 256
    assert (neighbours.unpack(packed, 64) == v).all()


def test_no_neighbour_twice_and_scaled_copies(spark):
    v = clustered(400, 12).astype(np.float32)
    v[300:] = v[5] * np.linspace(0.1, 900, 100, dtype=np.float32)[:, None]
    found = run(spark, [(i, x.tolist(), 1, "x") for i, x in enumerate(v)], leaf=40, visits=1000)
    assert all(len(set(f)) == len(f) == 5 and i not in f for i, f in found.items())
    assert all(set(found[i]) <= {5, *range(300, 400)} for i in range(300, 400))


def test_pairs(spark):
    df = spark.createDataFrame([(1, [(0, 2), (5, 3)]), (2, [(0, 1)])], "id long, found array<struct<d: int, other: long>>")
    assert sorted(map(tuple, neighbours.neighbour_pairs(df).collect())) == [(1, 2), (1, 3)]
