"""Label propagation against a plain Python version that goes node by node, with the same hashes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitloom.llm import sharding
from orbitloom.llm.common import stored
from orbitloom.llm.sharding import balanced_shards, propagate, quotas


def plain(spark, links, shards, cap, rounds):
    """Labels after the rounds, and the cut after each."""
    nodes = sorted({n for n, _ in links})
    hubs = sorted({h for _, h in links})
    df = spark.createDataFrame([(n,) for n in nodes], "node long")
    start = {r["node"]: r["s"] for r in df.select("node", F.pmod(F.xxhash64("node", F.lit("start")), F.lit(shards)).alias("s")).collect()}
    luck = {r["node"]: r["l"] for r in df.select("node", F.array(*(F.pmod(F.xxhash64("node", F.lit(k)), F.lit(1 << 30)) / float(1 << 30) for k in range(rounds))).alias("l")).collect()}
    hub_df = spark.createDataFrame([(h,) for h in hubs], "hub long")
    tie = {r["hub"]: r["t"] for r in hub_df.select("hub", F.array(*(F.pmod(F.xxhash64("hub", F.lit(s)), F.lit(1 << 20)) / float(1 << 21) for s in range(shards))).alias("t")).collect()}
    own, label, cuts = {n: [h for m, h in links if m == n] for n in nodes}, dict(start), []
    for k in range(rounds):
        size = np.bincount(list(label.values()), minlength=shards)
        count = {h: np.zeros(shards) for h in hubs}
        for n, h in links:
            count[h][label[n]] += 1
        cuts.append(sum(int(c.sum() ** 2 - (c**2).sum()) for c in count.values()))
        to = {}
        for n in nodes:
            votes = sum(count[h] + np.array(tie[h]) for h in own[n])
            to[n] = max((votes[s] if size[s] < 0.98 * cap or s == label[n] else -1.0, s) for s in range(shards))[1]
        wish = np.zeros((shards, shards))
        for n in nodes:
            wish[label[n], to[n]] += to[n] != label[n]
        if not wish.any():
            break
        share = quotas(wish, size, cap)
        label = {n: to[n] if to[n] != label[n] and share[label[n], to[n]] > luck[n][k] else label[n] for n in nodes}
    return label, cuts


@pytest.mark.parametrize(("shape", "shards"), [("classes", 3), ("hubs", 4), ("hot", 3)])
def test_propagation_is_that_of_plain_python(spark, shape, shards, monkeypatch):
    rng = random.Random(shards)
    if shape == "classes":  # each node in one hub
        links = [(n, n % 17) for n in range(200)]
    elif shape == "hubs":  # nodes in several hubs
        links = sorted({(rng.randrange(120), rng.randrange(25)) for _ in range(300)})
    else:  # one hub holds a third of all
        links = sorted({(n, 0 if n % 3 == 0 else 1 + n % 29) for n in range(240)} | {(n, 500) for n in range(10)})
    monkeypatch.setattr(sharding, "HUB_ROWS", 16)  # large hubs are cut into blocks
    cap = 1.2 * len({n for n, _ in links}) / shards
    want, cuts = plain(spark, links, shards, cap, 4)
    got = propagate(spark.createDataFrame(links, "node long, hub long").repartition(3), shards, cap, 4)
    assert {r["node"]: r["shard"] for r in got.collect()} == want
    assert cuts[-1] < cuts[0]


def test_small_clusters_end_up_whole_and_shards_even(spark):
    """Twelve cliques of eight on four shards: no better cut than none is possible, and the fill keeps sizes even."""
    links = spark.createDataFrame([(n, n // 8) for n in range(96)], "node long, hub long")
    nodes = spark.createDataFrame([(n,) for n in range(100)], "node long")
    found = balanced_shards(stored(nodes, "nodes"), links, 4, 8).collect()
    sizes = np.bincount([r["shard"] for r in found])
    assert sizes.tolist() == [25, 25, 25, 25] and all(sorted(r["slot"] for r in found if r["shard"] == s) == list(range(25)) for s in range(4))
    shard = {r["node"]: r["shard"] for r in found}
    cut = sum(shard[a] != shard[b] for h in range(12) for a in range(8 * h, 8 * h + 8) for b in range(8 * h, a))
    assert cut < 0.5 * 12 * 28 * 3 / 4  # at random, three quarters of all links are cut
