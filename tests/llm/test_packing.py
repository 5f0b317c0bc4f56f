from itertools import combinations

import numpy as np
import pytest

from webloom.llm import packing, tokens


def padding(bounds, lengths, counts):
    return sum(int(c) * (int(min(b for b in bounds if b >= n)) - int(n)) for n, c in zip(lengths, counts))


def test_bounds_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(15):
        lengths = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
        counts = rng.integers(1, 20, 9)
        for k in (1, 2, 4):
            best = min(padding((*c, lengths[-1]), lengths, counts) for c in combinations(lengths[:-1], k - 1))
            got = packing.bucket_bounds(lengths, counts, k)
            assert len(got) <= k and padding(got, lengths, counts) == best


@pytest.mark.parametrize("top_up", [True, False])
def test_every_container_holds_what_fits(spark, top_up):
    rng = np.random.default_rng(3)
    sizes = [int(x) for x in np.minimum(rng.lognormal(4, 1.2, 3000), 5000)] + [0, None, 100, 200, 500, 100] + [77] * 1500
    df = spark.createDataFrame([(i, s, "clash", 1) for i, s in enumerate(sizes)], "id long, tokens int, kind string, container int")
    capacity = {"small": 100, "large": 512}
    rows = packing.pack(df, "id", "tokens", capacity, buckets=32, top_up=top_up).collect()
    for kind, c in capacity.items():
        own = [r for r in rows if r.container_kind == kind]
        load, pieces = {}, {}
        for r in own:
            load[r.container] = load.get(r.container, 0) + r.tokens
            pieces.setdefault(r.id, []).append(r.tokens)
        assert max(load.values()) <= c and sorted(load) == list(range(len(load)))
        assert {i: sum(p) for i, p in pieces.items()} == {i: s for i, s in enumerate(sizes) if s}
        assert all(len(p) == -(-sizes[i] // c) for i, p in pieces.items())
        if top_up and kind == "large":
            assert sum(load.values()) / (len(load) * c) > 0.95


def test_empty(spark):
    df = spark.createDataFrame([], "id long, tokens int")
    assert packing.pack(df, "id", "tokens", {"x": 10}).count() == 0


def test_token_sizes(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, "<|endoftext|>"), (5, "word " * 50_000)], "id long, text string")
    found = {r.id: r.tokens for r in tokens.token_sizes(df, "id", "text").collect()}
    assert found[1] == 2 and found[2] == found[3] == 0 and found[4] > 1 and found[5] > 49_000
