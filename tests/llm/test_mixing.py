import numpy as np

from webloom.llm import mixing


def test_quotas_are_exact():
    q = np.array([1000, 0, 7, 333])
    for shards in (1, 2, 5, 64):
        table = mixing.split_quotas(q, shards, 3)
        assert (table.sum(0) == q).all() and (table >= 0).all() and np.ptp(table.sum(1)) <= 2 * np.log2(max(2, shards)) + 1
    big = mixing.split_quotas(np.array([3_000_000_000, 5]), 4, 1)
    assert (big.sum(0) == [3_000_000_000, 5]).all() and (big >= 0).all()


def test_permutation():
    for n in (1, 2, 3, 10, 97, 1024):
        assert sorted(mixing._permute(np.arange(n), n, 5).tolist()) == list(range(n))


def frame(spark):
    rng = np.random.default_rng(1)
    rows = [(i, s, int(x), "clash", 0) for i, (s, x) in enumerate(zip(rng.choice(["a", "b", "c", "none"], 6000, p=[0.7, 0.1, 0.1, 0.1]), rng.lognormal(5, 1, 6000)))]
    rows += [(9000, None, 5, None, 0), (9001, "a", None, None, 0), (9002, "a", 0, None, 0)]
    return spark.createDataFrame(rows, "id long, source string, tokens long, place string, shard int")


def test_shares_and_repeats(spark):
    targets = {"a": (0.5, 1), "b": (0.3, 4), "c": (0.2, 2), "absent": (0.0, 1)}
    mixed = mixing.mix(frame(spark), "id", "source", "tokens", targets, block_tokens=2000, shard_tokens=50_000)
    report = {r.source: r for r in mixing.share_report(mixed, targets, "id").collect()}
    for s, (share, most) in targets.items():
        assert abs(report[s].actual_share - share) < 0.002 and report[s].most_uses <= most
    rows = mixed.collect()
    assert len({(r.id, r["pass"]) for r in rows}) == len(rows)
    places: dict = {}
    for r in rows:
        places.setdefault(r.shard, []).append(r.place)
    assert len(places) > 5 and all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())
    again = mixing.mix(frame(spark).repartition(7), "id", "source", "tokens", targets, block_tokens=2000, shard_tokens=50_000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_nothing_to_mix(spark):
    df = frame(spark)
    assert mixing.mix(df, "id", "source", "tokens", {"zzz": (1.0, 1)}).count() == 0
    assert mixing.mix(df.where("false"), "id", "source", "tokens", {"a": (1.0, 1)}).count() == 0
    assert mixing.plan_mixture({"a": 10}, {"a": (None, 1), "b": (0.5, 2)}) == (0, {})


def test_draws_beyond_the_library_bound():
    rng = np.random.default_rng(5)
    colors = np.array([1_200_000_000, 800_000_000, 7])
    draws = np.array([mixing._hypergeometric(colors, 500_000_000, rng) for _ in range(300)])
    assert (draws.sum(1) == 500_000_000).all() and (draws >= 0).all() and (draws <= colors).all()
    total, n = 2_000_000_007, 500_000_000
    share = 1_200_000_000 / total
    spread = np.sqrt(n * share * (1 - share) * (total - n) / (total - 1))
    assert abs(draws[:, 0].mean() - n * share) < 4 * spread / np.sqrt(300) and 0.85 < draws[:, 0].std() / spread < 1.15
    assert 1.0 < draws[:, 2].mean() < 2.5


def test_rejection_draws_like_the_library(monkeypatch):
    rng = np.random.default_rng(6)
    want = rng.hypergeometric(300, 500, 200, 4000)
    monkeypatch.setattr(mixing, "DRAWABLE", 10)
    got = np.array([mixing.draw_one(300, 500, 200, rng) for _ in range(4000)])
    assert abs(got.mean() - want.mean()) < 0.4 and abs(got.std() / want.std() - 1) < 0.06
    assert [mixing.draw_one(0, 90, 5, rng), mixing.draw_one(50, 60, 110, rng), mixing.draw_one(50, 60, 0, rng)] == [0, 50, 0]
