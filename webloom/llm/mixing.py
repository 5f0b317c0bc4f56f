"""Problem 9: mixing sources to target weights.

The size of the mixture is the largest at which every source reaches its share within its
repetitions.  Each source is laid out once for each pass in a permuted order and cut into blocks of
about equal tokens.  A splitting tree halves the output shards again and again, and at each node
draws from the multivariate hypergeometric distribution how many blocks of each source go to the
left half, so quotas hold exactly; the blocks of a shard are a run of a permutation of all blocks
of the source, and rows are shuffled inside their shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.operators.order import running
from webloom.session import materialize

BLOCK_TOKENS, SHARD_TOKENS = 32_768, 2_097_152
#: Rounds in which documents that fit fill what a source still wants; each leaves less than the smallest that was passed over.
FILL_ROUNDS = 3
#: More shards than these make shards grow: the splitting table on the driver has a row for each and a column for each source.
MOST_SHARDS = 65_536
#: The library's bound of one draw.
DRAWABLE = 1_000_000_000


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard: rows sum to nearly equal numbers, columns to ``quotas`` exactly."""
    out = np.zeros((shards, len(quotas)), np.int64)
    rng = np.random.default_rng(seed)
    stack = [(0, shards, quotas.astype(np.int64))]
    while stack:
        first, width, left = stack.pop()
        if width == 1:
            out[first] = left
            continue
        half = width // 2
        draw = int(round(left.sum() * half / width))
        part = _hypergeometric(left, draw, rng)
        stack += [(first, half, part), (first + half, width - half, left - part)]
    return out


def _hypergeometric(colors: np.ndarray, draw: int, rng: np.random.Generator) -> np.ndarray:
    """A multivariate hypergeometric draw from an urn of any size: color after color, each given what is left."""
    part = np.zeros(len(colors), np.int64)
    rest, left = int(colors.sum()), draw
    for i, n in enumerate(map(int, colors)):
        rest -= n
        part[i] = draw_one(n, rest, left, rng)
        left -= int(part[i])
    return part


def draw_one(good: int, bad: int, draw: int, rng: np.random.Generator) -> int:
    """How many of ``draw`` blocks are good: the library's draw up to its bound, beyond it rejection by the ratio of uniforms (Stadlober)."""
    total = good + bad
    if not good or not draw:
        return 0
    if draw >= total:
        return good
    if total < DRAWABLE:
        return int(rng.hypergeometric(good, bad, draw))
    if 2 * draw > total:
        return good - draw_one(good, bad, total - draw, rng)
    if good > bad:
        return draw - draw_one(bad, good, draw, rng)
    share = good / total
    mean = draw * share
    spread = math.sqrt(mean * (1 - share) * (total - draw) / (total - 1) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    log = lambda k: math.lgamma(k + 1) + math.lgamma(good - k + 1) + math.lgamma(draw - k + 1) + math.lgamma(bad - draw + k + 1)
    peak = log((draw + 1) * (good + 1) // (total + 2))
    while True:
        u, v = 1 - rng.random(), rng.random()
        k = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if max(0, draw - bad) <= k <= min(good, draw) and 2 * math.log(u) <= peak - log(k):
            return k


def plan_mixture(tokens: dict[str, int], targets: dict[str, tuple[float, int]]) -> tuple[int, dict[str, int]]:
    """(tokens of the mixture, tokens wanted of each source); shares are taken relative to their sum, sources without tokens get none."""
    shares = {s: share for s, (share, repeats) in targets.items() if share and share > 0 and repeats and repeats > 0 and tokens.get(s, 0) > 0}
    if not shares:
        return 0, {}
    weight = sum(shares.values())
    total = min(tokens[s] * targets[s][1] / (share / weight) for s, share in shares.items())
    return int(total), {s: int(total * share / weight) for s, share in shares.items()}


def _permute(index: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A permutation of 0..n-1 by an affine step coprime to n: no list of blocks is ever held."""
    if n <= 2:
        return index
    rng = np.random.default_rng(seed)
    step = int(rng.integers(n // 3, n)) or 1
    while np.gcd(step, n) != 1:
        step = step % n + 1
    return (index * step + int(rng.integers(0, n))) % n


def _lookup(sources: list[str], values: dict[str, int]):
    """A column with the value of the row's source."""
    return F.create_map(*[x for s in sources for x in (F.lit(s), F.lit(int(values[s])))])[F.col("source")]


def mix(docs: DataFrame, key: str, source: str, size: str, targets: dict[str, tuple[float, int]], block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, most_shards: int = MOST_SHARDS, seed: int = 29) -> DataFrame:
    """(shard, place, key, source, pass, tokens): the mixture, a row for each use of a document.

    ``targets`` maps a source to its share and the most uses of one document.  Documents of other or
    null sources and of null or no size are not used; keys must be unique; an empty input gives no
    rows.  A source stays below its wanted tokens by about the size of its smallest documents.
    """
    spark = docs.sparkSession
    names = sorted(targets)
    rows = docs.where(F.col(source).isin(*names) & (F.col(size) > 0)).select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(size).cast("long").alias("size"))
    have = {r["source"]: int(r["t"]) for r in rows.groupBy("source").agg(F.sum("size").alias("t")).collect()}
    total, wanted = plan_mixture(have, targets)
    schema = f"shard int, place long, {key} {dict(docs.dtypes)[key]}, source string, pass int, tokens long"
    if not total:
        return spark.createDataFrame([], schema)
    used = [s for s in names if s in wanted]
    full = {s: wanted[s] // have[s] for s in used}
    rest = {s: wanted[s] - full[s] * have[s] for s in used}
    passes = {s: full[s] + (rest[s] > 0) for s in used}
    laid = rows.where(F.col("source").isin(*used)).withColumn("passes", _lookup(used, passes).cast("int"))
    laid = laid.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1))).drop("passes")
    laid = laid.withColumn("mark", F.xxhash64("key", "pass", F.lit(seed)))
    ordered = running(laid, ["source", "pass"], [F.col("mark").asc(), F.col("key").asc()], "size")
    # the last pass of a source ends before its wanted tokens do; what is left is filled with later documents that fit
    ordered = materialize(ordered, "laid")
    last = _lookup(used, full)
    kept = ordered.where((F.col("pass") < last) | (F.col("before") + F.col("size") <= _lookup(used, rest))).select(*ordered.columns)
    for _ in range(FILL_ROUNDS):
        have_now = {r["source"]: int(r["t"]) for r in kept.groupBy("source").agg(F.sum("size").alias("t")).collect()}
        gap = {s: wanted[s] - have_now.get(s, 0) for s in used}
        left = ordered.where((F.col("pass") == last) & (F.col("size") <= _lookup(used, gap))).join(kept.select("key", "pass"), ["key", "pass"], "left_anti")
        again = running(left.withColumnRenamed("before", "place_before").drop("position"), ["source"], [F.col("mark").asc(), F.col("key").asc()], "size")
        more = again.where(F.col("before") + F.col("size") <= _lookup(used, gap)).drop("before").withColumnRenamed("place_before", "before")
        kept = materialize(kept.unionByName(more.select(*kept.columns)), "kept")
    blocks = {s: full[s] * -(-have[s] // block_tokens) + -(-rest[s] // block_tokens) for s in used}
    each = {s: -(-have[s] // block_tokens) for s in used}
    shards = int(max(1, min(most_shards, total // shard_tokens)))
    table = split_quotas(np.array([blocks[s] for s in used]), shards, seed)
    ends = np.cumsum(table, 0)
    shared = spark.sparkContext.broadcast((used, each, blocks, ends))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used_, each_, blocks_, ends_ = shared.value
        for batch in batches:
            src = batch.column(1).to_pylist()
            number, before = batch.column(3).to_numpy().astype(np.int64), batch.column(4).to_numpy()
            shard = np.zeros(len(src), np.int32)
            for i, s in enumerate(used_):
                mine = np.flatnonzero(np.array([x == s for x in src], bool))
                block = np.minimum(number[mine] * each_[s] + before[mine] // block_tokens, blocks_[s] - 1)
                shard[mine] = np.searchsorted(ends_[:, i], _permute(block, blocks_[s], seed + i), "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], names=[*batch.schema.names, "shard"])

    shape = f"key {dict(docs.dtypes)[key]}, source string, tokens long, pass int, before long"
    placed = kept.select("key", "source", F.col("size").alias("tokens"), "pass", "before").mapInArrow(place, shape + ", shard int")
    mixed = running(placed, ["shard"], [F.xxhash64("key", "pass", F.lit(seed + 1)).asc(), F.col("key").asc(), F.col("pass").asc()])
    return mixed.select("shard", F.col("position").alias("place"), F.col("key").alias(key), "source", "pass", "tokens")


def share_report(mixed: DataFrame, targets: dict[str, tuple[float, int]], key: str) -> DataFrame:
    """(source, target_share, actual_share, tokens, uses, most_uses) of a mixture, sources without rows included."""
    spark = mixed.sparkSession
    wanted = spark.createDataFrame([(s, float(v[0])) for s, v in targets.items()], "source string, target_share double")
    each = mixed.groupBy("source", key).agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    found = each.groupBy("source").agg(F.sum("t").alias("tokens"), F.sum("n").alias("uses"), F.max("n").alias("most_uses"))
    total = found.agg(F.sum("tokens")).first()[0] or 1
    joined = wanted.join(F.broadcast(found), "source", "left").na.fill(0)  # a row for each source of the targets
    return joined.select("source", "target_share", (F.col("tokens") / F.lit(float(total))).alias("actual_share"), "tokens", "uses", "most_uses")
