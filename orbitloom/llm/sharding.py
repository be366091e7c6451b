"""Balanced label propagation: linked rows move towards their neighbours' shards under quotas, then all shards get equal numbers of rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.llm.common import numbered, stored, table

SHARDS, ROUNDS = 24, 6
#: Rows that a shard may hold while labels propagate, as a multiple of the equal share: without slack no row could move in a table of linked rows only.
SLACK = 1.1


#: Members of a hub that meet in one block of it, and most large hubs that are broadcast; more are joined by a shuffle.
HUB_ROWS, BROADCAST_HUBS = 256, 250_000


def large_hubs(hubs: DataFrame) -> DataFrame:
    """(hub, blocks) of the hubs (hub, count) with more than HUB_ROWS members."""
    found = stored(hubs.filter(F.col("count") > HUB_ROWS).select("hub", F.ceil(F.col("count") / HUB_ROWS).alias("blocks")), "large")
    return F.broadcast(found) if found.count() <= BROADCAST_HUBS else found


def dealt(members: DataFrame, large: DataFrame) -> DataFrame:
    """members (node, hub) with the block of the hub that each is dealt to."""
    return members.join(large, "hub", "left").withColumn("block", F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).cast("long")).drop("blocks")


def copied(hubs: DataFrame, large: DataFrame) -> DataFrame:
    """hubs (hub, ...) once for each of their blocks."""
    return hubs.join(large, "hub", "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1).cast("long")) - 1))).drop("blocks")


def quotas(wish: np.ndarray, size: np.ndarray, cap: float) -> np.ndarray:
    """The share of the wished moves (from, to) that may happen so that no shard ends above cap: inflow is scaled down to the room there is, until all shards hold. What leaves a shard makes room in it."""
    allowed = wish.astype(float)
    for _ in range(200):
        after = size + allowed.sum(0) - allowed.sum(1)
        over = np.flatnonzero((after > cap + 1e-6) & (allowed.sum(0) > 0))
        if not len(over):
            break
        for j in over:
            inflow = allowed[:, j].sum()
            allowed[:, j] *= max(0.0, inflow - (after[j] - cap)) / inflow
    return np.divide(allowed, wish, out=np.zeros_like(allowed), where=wish > 0)


def propagate(links: DataFrame, shards: int, cap: float, rounds: int = ROUNDS) -> DataFrame:
    """Labels (node, shard) of the nodes in links (node, hub): nodes that share a hub are neighbours.

    A hub stands for all pairs of its members, so no pair is ever made, and a large hub is cut into blocks, so no task holds it whole: a round counts each hub's members by shard
    (at most `shards` counts, combined before the shuffle), gives every node the sum of its hubs' counts, and moves
    nodes with a gain. The driver sees only the moves wished between each two shards and answers with quotas; which of
    the wishing nodes move is decided by a hash. Counts include the node itself and ties go to a shard that
    a hash of hub and shard picks, alike for all members, so two nodes don't swap for ever. Full shards take part in no new moves.
    """
    spark = links.sparkSession
    labels = stored(links.select("node").distinct().withColumn("shard", F.pmod(F.xxhash64("node", F.lit("start")), F.lit(shards)).cast("int")), "labels")
    large = large_hubs(links.groupBy("hub").count())
    links = dealt(links, large)
    one_hub = links.groupBy("node").count().filter("count > 1").isEmpty()
    for k in range(rounds):
        size = np.zeros(shards)
        for r in labels.groupBy("shard").count().collect():
            size[r["shard"]] = r["count"]
        room = (size < 0.98 * cap).tolist()
        member = links.join(labels, "node")
        counts = member.groupBy("hub").agg(*(F.count(F.when(F.col("shard") == s, True)).alias(f"c{s}") for s in range(shards)))
        tie = [F.pmod(F.xxhash64("hub", F.lit(s)), F.lit(1 << 20)) / float(1 << 21) for s in range(shards)]
        votes = counts.select("hub", F.array(*(F.col(f"c{s}") + t for s, t in enumerate(tie))).alias("votes"))
        voted = member.join(copied(votes, large), ["hub", "block"])
        if not one_hub:
            voted = voted.groupBy("node", "shard").agg(F.array(*(F.sum(F.col("votes")[s]) for s in range(shards))).alias("votes"))
        open_ = F.array(*(F.lit(x) for x in room))
        best = F.array_max(F.transform("votes", lambda v, i: F.struct(F.when(F.get(open_, i) | (i == F.col("shard")), v).otherwise(-1.0).alias("v"), i.cast("int").alias("to"))))
        wished = voted.select("node", "shard", best.alias("best")).select("node", "shard", F.col("best.to").alias("to"))
        wished = stored(wished, "wishes")
        wish = np.zeros((shards, shards))
        for r in wished.filter("shard <> to").groupBy("shard", "to").count().collect():
            wish[r["shard"], r["to"]] = r["count"]
        if not wish.any():
            break
        share = F.array(*(F.lit(float(x)) for x in quotas(wish, size, cap).ravel()))
        luck = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(1 << 30)) / float(1 << 30)
        moves = F.get(share, F.col("shard") * shards + F.col("to")) > luck
        labels = wished.select("node", F.when((F.col("shard") != F.col("to")) & moves, F.col("to")).otherwise(F.col("shard")).alias("shard"))
        labels = stored(labels, "labels") if k + 1 < rounds else labels
    return labels


def balanced_shards(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """nodes (node, unique, and other columns) with `shard` and `slot`: counts of the shards are at most one apart, slots gapless from 0.

    Linked nodes are placed by propagate() under a cap of SLACK equal shares. Then each shard has an exact target; linked nodes past it and all nodes
    without links fill what other shards lack, by their number in the pool. A link to a node that nodes lacks, or a hub with one member, changes nothing.
    """
    n = nodes.count()
    target = [n // shards + (s < n % shards) for s in range(shards)]
    labels = propagate(links, shards, max(1, SLACK * n / shards), rounds)
    placed = stored(nodes.join(labels, "node", "left"), "placed")
    linked = placed.filter("shard is not null")
    had = [0] * shards
    for r in linked.groupBy("shard").count().collect():
        had[r["shard"]] = r["count"]
    slots = numbered(linked, F.col("shard"), ["node"], "slot", n)
    if any(h > t for h, t in zip(had, target, strict=True)):
        slots = stored(slots, "slots")
    held = F.col("slot") < F.get(F.array(*map(F.lit, target)), F.col("shard"))
    kept = slots.filter(held)
    pool = placed.filter("shard is null").withColumn("slot", F.lit(None).cast("long"))
    if any(h > t for h, t in zip(had, target, strict=True)):
        pool = stored(pool.unionByName(slots.filter(~held)), "pool")
    lack = [max(0, t - h) for h, t in zip(had, target, strict=True)]
    begin = np.concatenate([[0], np.cumsum(lack)]).tolist()
    filled = numbered(pool.drop("slot", "shard"), F.lit("pool"), ["node"], "at", n)
    to = sum((F.col("at") >= b).cast("int") for b in begin[1:-1])
    filled = filled.withColumn("shard", to if shards > 1 else F.lit(0))
    filled = filled.withColumn("slot", F.col("at") - F.get(F.array(*(F.lit(b) for b in begin)), F.col("shard")) + F.get(F.array(*(F.lit(min(h, t)) for h, t in zip(had, target, strict=True))), F.col("shard"))).drop("at")
    return kept.unionByName(filled)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with equal texts are linked (null and empty texts alike); the hash that stands for a text only guides placement."""
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.xxhash64(data, F.length(data)).alias("hub"))
    nodes = stored(docs.withColumn("node", F.monotonically_increasing_id()), "nodes")
    shared = stored(nodes.groupBy("hub").count().filter("count > 1"), "hubs")
    large = large_hubs(shared)
    links = stored(dealt(nodes.select("node", "hub"), large).join(copied(shared.select("hub"), large), ["hub", "block"]).select("node", "hub"), "links")
    found = balanced_shards(nodes, links)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
