"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orbitloom.llm.common import stored, table

#: Hash tables, width of a bucket along a function, and the numbers of functions of a table that are tried.
TABLES, WIDTH, FUNCTIONS = 2, 1.5, (8, 12, 16, 24)
#: Vectors, and queries of one neighbourhood, that meet in one cell; larger neighbourhoods are split into blocks.
BLOCK, QUERY_BLOCK = 4_000, 20_000
#: The share of the k nearest of SAMPLE queries, known from a scan, that probes must reach, and the number of vectors that tell how much of a table they visit.
RECALL, SAMPLE, SIGHT = 0.96, 200, 2_000
#: Vectors that meet in one group of a scan, and queries scored at once.
SCAN_ROWS, SCORED = 25_000, 256


@dataclass
class Hashes:
    """h(v) = floor((a.v + b) / WIDTH) of unit vectors, `functions` of them a table. A bucket is named by all of its table's values, a neighbourhood of buckets by the first `near` of them.

    A bucket's cost for a query is the sum, over the functions, of the squared distance from the query's projection to the bucket's interval: 0 for the home bucket, and the less the likelier a near vector lies in it.
    """

    a: np.ndarray  # tables, dimensions, functions
    b: np.ndarray
    odd: np.ndarray  # tables, functions
    near: int = 1
    most: float = 0.0  # a query visits the buckets of this cost at most

    @classmethod
    def drawn(cls, dimensions: int, functions: int, seed: int = 7) -> Hashes:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(size=(TABLES, dimensions, functions)), rng.uniform(0, WIDTH, (TABLES, functions)), rng.integers(1, 1 << 62, (TABLES, functions)) * 2 + 1)

    def places(self, unit: np.ndarray, t: int) -> np.ndarray:
        return (unit @ self.a[t] + self.b[t]) / WIDTH

    def buckets(self, unit: np.ndarray, t: int) -> np.ndarray:
        return np.clip(np.floor(self.places(unit, t)), -128, 127).astype(np.int8)

    def hoods(self, buckets: np.ndarray, t: int) -> np.ndarray:
        return (buckets[:, : self.near].astype(np.int64) * self.odd[t, : self.near]).sum(1)

    def costs(self, unit: np.ndarray, buckets: np.ndarray, t: int) -> np.ndarray:
        """(query, bucket): the costs of the buckets for the queries."""
        return self.cost_table(unit, *(held := intervals(buckets))[:2], t) @ held[2]

    def cost_table(self, unit: np.ndarray, low: int, high: int, t: int) -> np.ndarray:
        """Of each query, the costs of the intervals low to high along each function."""
        place, interval = self.places(unit, t)[..., None], np.arange(low, high + 1)
        return ((np.maximum(0, np.maximum(interval - place, place - interval - 1)) * WIDTH) ** 2).reshape(len(unit), -1).astype(np.float32)

    def probes(self, unit: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Names and costs of the neighbourhoods that one query visits by falling estimated success: its own first, then those whose first values are perturbed, by rising cost, up to `most`."""
        place = self.places(unit[None], t)[0, : self.near]
        home, names, costs = np.floor(place).astype(np.int64), np.zeros(1, np.int64), np.zeros(1)
        reach = int(np.sqrt(self.most) / WIDTH) + 1
        for j in range(self.near):
            shift = np.arange(-reach, reach + 1)
            interval = np.clip(home[j] + shift, -128, 127)
            own = np.maximum(0, np.maximum(home[j] + shift - place[j], place[j] - home[j] - shift - 1)) ** 2 * WIDTH**2
            costs = (costs[:, None] + own).ravel()
            names = (names[:, None] + interval * self.odd[t, j]).ravel()
            kept = costs <= self.most
            names, costs = names[kept], costs[kept]
        order = np.argsort(costs, kind="stable")
        return names[order], costs[order]


def intervals(buckets: np.ndarray) -> tuple[int, int, np.ndarray]:
    """The least and largest value in buckets, and for each interval between them along each function a row that marks the buckets in it: a cost table times these are the buckets' costs."""
    low, high = int(buckets.min()), int(buckets.max())
    return low, high, (buckets[..., None] == np.arange(low, high + 1)).reshape(len(buckets), -1).T.astype(np.float32)


def units(column: pa.Array) -> np.ndarray:
    return unit_rows(column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def with_buckets(vectors: DataFrame, hashes: Hashes) -> DataFrame:
    """One row for each vector and table, with its neighbourhood and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                unit = units(part.column(1))
                for t in range(TABLES):
                    own = hashes.buckets(unit, t)
                    columns = [part.column(0), part.column(1), pa.array(np.full(len(unit), t, np.int32)), pa.array(hashes.hoods(own, t)), pa.array([x.tobytes() for x in own], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "embedding", "t", "hood", "bucket"])

    return vectors.mapInArrow(run, f"vec_id long, embedding {dict(vectors.dtypes)['embedding']}, t int, hood long, bucket binary")


def with_probes(queries: DataFrame, hashes: Hashes) -> DataFrame:
    """(query_id, t, hood) of every neighbourhood that a query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = units(batch.column(1)) if batch.num_rows else []
            for id_, u in zip(batch.column(0).to_pylist(), unit, strict=True):
                for t in range(TABLES):
                    names, _ = hashes.probes(u, t)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), id_, np.int64)), pa.array(np.full(len(names), t, np.int32)), pa.array(names)], names=["query_id", "t", "hood"])

    return queries.mapInArrow(run, "query_id long, t int, hood long")


def foremost(ids: np.ndarray, score: np.ndarray, k: int, slack: float = 0.0) -> np.ndarray:
    """Places of all scores that may be among the k largest of distinct ids, when each is right to within slack / 2."""
    m = k
    while m < len(score):
        least = np.partition(score, -m)[-m]
        if len(np.unique(ids[score >= least])) >= k:
            return np.flatnonzero(score >= least - slack)
        m *= 4
    return np.arange(len(score))


class Group:
    """Vectors of one group, scored in double precision."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.norms = np.sqrt((rows * rows).sum(1))

    def best(self, query_id: int, q: np.ndarray, at: np.ndarray, k: int) -> list[tuple]:
        """(query_id, vec_id, score) of the k largest cosines among the rows at these places, ties to the smaller id; an id of several rows counts once."""
        at = at[self.ids[at] != query_id]
        score = (self.rows[at] * q).sum(1) / (self.norms[at] * np.sqrt((q * q).sum()))
        near = foremost(self.ids[at], score, k)
        at, score = at[near], score[near]
        out: dict[int, tuple] = {}
        for j in np.lexsort((self.ids[at], -score)):
            if len(out) == k:
                break
            i = int(self.ids[at[j]])
            out.setdefault(i, (query_id, i, float(score[j])))
        return list(out.values())

    def answers(self, query_ids: np.ndarray, q: np.ndarray, at: np.ndarray, seen: np.ndarray | None, k: int) -> list[tuple]:
        """best() of each query among the rows at these places, or those of them that it has seen. A product of matrices leaves the rows that may be, exact cosines order them."""
        out: list[tuple] = []
        if len(at):
            rough = unit_rows(q) @ (self.rows[at] / self.norms[at, None]).T
            for j, query_id in enumerate(query_ids):
                own = np.flatnonzero(self.ids[at] != query_id) if seen is None else np.flatnonzero(seen[j] & (self.ids[at] != query_id))
                near = foremost(self.ids[at[own]], rough[j, own], k, 1e-9)
                out += self.best(int(query_id), q[j], at[own[near]], k)
        return out


FOUND = "query_id long, vec_id long, score double"


def answers(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def nearest(hashes: Hashes, k: int):
    """The k nearest of a group's vectors for each of its queries, among the buckets that the query visits in the group's cells."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if not len(vectors) or not len(queries):
            return answers(out)
        vectors = vectors.sort_values("cell", kind="stable")
        group = Group(vectors["vec_id"].to_numpy(), np.stack(vectors["embedding"].to_numpy()).astype(float))
        cells, first = np.unique(vectors["cell"].to_numpy(), return_index=True)
        bounds = [*first.tolist(), len(vectors)]
        held = []  # of each cell: its table, its buckets as intervals, and which of them each vector is in
        for lo, hi in zip(bounds, bounds[1:]):
            names, at = np.unique(vectors["bucket"].to_numpy()[lo:hi], return_inverse=True)
            held.append((int(vectors["t"].iloc[lo]), intervals(np.frombuffer(b"".join(names), np.int8).reshape(len(names), -1)), at))
        for lo in range(0, len(queries), SCORED):
            some = queries.iloc[lo : lo + SCORED]
            q = np.stack(some["embedding"].to_numpy()).astype(float)
            unit, seen = unit_rows(q), np.zeros((len(q), len(vectors)), bool)
            goes = np.array([np.isin(cells, np.asarray(v)) for v in some["visited"]])
            for c, (t, (low, high, has), at) in enumerate(held):
                if len(own := np.flatnonzero(goes[:, c])):
                    seen[own, bounds[c] : bounds[c + 1]] = (hashes.cost_table(unit[own], low, high, t) @ has <= hashes.most)[:, at]
            any_ = np.flatnonzero(seen.any(0))
            out += group.answers(some["query_id"].to_numpy(), q, any_, seen[:, any_], k)
        return answers(out)

    return run


def scan(k: int):
    """The k nearest of all a group's vectors for each of its queries."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(vectors) and len(queries):
            group = Group(vectors["vec_id"].to_numpy(), np.stack(vectors["embedding"].to_numpy()).astype(float))
            for lo in range(0, len(queries), SCORED):
                some = queries.iloc[lo : lo + SCORED]
                out += group.answers(some["query_id"].to_numpy(), np.stack(some["embedding"].to_numpy()).astype(float), np.arange(len(group.ids)), None, k)
        return answers(out)

    return run


def scanned(vectors: DataFrame, queries: DataFrame, n: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k nearest of each group of vectors for all queries (query_id, embedding); groups and blocks of queries don't grow with the table."""
    groups = max(min(24, -(-n // BLOCK)), -(-n // SCAN_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    left = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "embedding")
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), "query_id", "embedding")
    find = scan(k)
    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInPandas(lambda v, q: find(v, q), FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def fitted(vectors: DataFrame, asked: DataFrame, n: int, k: int) -> Hashes:
    """Hash functions and the cost up to which buckets are visited: that at which the probes of sampled queries reach RECALL of their true k nearest. Of the numbers of functions tried, the one whose probes visit the smallest part of the table."""
    few = stored(asked.orderBy(F.xxhash64("query_id", F.lit("sample"))).limit(SAMPLE), "sample")
    true = stored(ranked(scanned(vectors, few, n, k), k), "true")
    at = vectors.join(F.broadcast(true.select("vec_id").distinct()), "vec_id").dropDuplicates(["vec_id"])
    near = true.join(at, "vec_id").select("query_id", "embedding").toPandas().groupby("query_id")["embedding"]
    unit = lambda rows: unit_rows(np.stack(list(rows)).astype(float))
    seen = unit(vectors.orderBy(F.xxhash64("vec_id", F.lit("sight"))).limit(SIGHT).toPandas()["embedding"])
    sample = few.toPandas()
    sample = [(u[None], unit(near.get_group(i))) for i, u in zip(sample["query_id"], unit(sample["embedding"]), strict=True) if i in near.groups] if len(sample) else []
    best, least = Hashes.drawn(seen.shape[1], FUNCTIONS[0]), 2.0
    for functions in FUNCTIONS if sample else ():
        hashes = Hashes.drawn(seen.shape[1], functions)
        own = [hashes.buckets(seen, t) for t in range(TABLES)]
        costs = np.concatenate([np.min([hashes.costs(u, hashes.buckets(rows, t), t) for t in range(TABLES)], axis=0).ravel() for u, rows in sample])
        hashes.most = float(np.quantile(costs, RECALL, method="higher")) + 1e-3  # costs are sums in single precision
        visited = np.mean([(np.min([hashes.costs(u, own[t], t) for t in range(TABLES)], axis=0) <= hashes.most).mean() for u, _ in sample])
        if visited < least - 0.005:
            best, least = hashes, visited
    # neighbourhoods small enough for a cell, by the chance that two vectors share one
    for near_ in range(1, best.a.shape[2] + 1):
        best.near = near_
        _, counts = np.unique(best.hoods(best.buckets(seen, 0), 0), return_counts=True)
        if (counts.astype(float) ** 2).sum() / len(seen) ** 2 * n <= BLOCK or near_ >= np.log2(max(2, n)):
            break
    return best


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: not null, not zero, all components finite, and as long as most vectors are. Components keep their precision; vectors of extreme size (beyond 2^300 or under 2^-300) are scaled by a power of two."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    kind = "array<float>" if dict(df.dtypes)["embedding"] == "array<float>" else "array<double>"
    df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")).filter("vec_id is not null and size(embedding) > 0").filter(whole)
    if kind == "array<double>":
        # squares of the smallest and largest doubles vanish or overflow; a power of two changes no cosine. It is multiplied in two steps, as it may be too large itself
        power = -F.floor(F.log2(F.array_max(F.transform("embedding", lambda x: F.abs(x))))).cast("int")
        half = F.floor(power / 2).cast("int")
        scaled = F.transform("embedding", lambda x: x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half))
        df = df.withColumn("embedding", F.when(F.abs(power) > 300, scaled).otherwise(F.col("embedding")))
    common = df.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return df.filter(F.size("embedding") == (common["n"] if common else 0))


def probed(vectors: DataFrame, asked: DataFrame, hashes: Hashes, n: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k nearest of each group of cells among the buckets visited.

    Every vector is in one bucket of each table. Neighbourhoods of buckets are cells of about BLOCK vectors, a larger one several cells by a hash of the id; one that more than QUERY_BLOCK queries visit is copied
    for blocks of queries, so no group grows with the table. A query goes to the neighbourhoods whose first values cost no more than `most`, and there to the buckets whose whole cost is within it.
    """
    held = stored(with_buckets(vectors, hashes), "buckets")
    probes = stored(with_probes(asked.repartition(max(1, min(10_000, asked.count() // 100)), "query_id"), hashes), "probes")
    groups = max(1, n * TABLES // BLOCK)
    many = held.groupBy("t", "hood").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.lit(1).cast("long").alias("copies"))
    often = probes.groupBy("t", "hood").agg(F.lit(1).cast("long").alias("blocks"), F.ceil(F.count("*") / QUERY_BLOCK).alias("copies"))
    large = stored(many.union(often).filter("blocks > 1 or copies > 1").groupBy("t", "hood").agg(F.max("blocks").alias("blocks"), F.max("copies").alias("copies")), "large")

    def dealt(df: DataFrame, id_: str, own: str, other: str) -> DataFrame:
        df = df.join(large, ["t", "hood"], "left").withColumns({own: F.pmod(F.xxhash64(id_), F.coalesce(own, F.lit(1))), "other_": F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))})
        cell = F.xxhash64("t", "hood", *(F.col(c).cast("long") for c in ((own, "other_") if own == "blocks" else ("other_", own))))
        return df.withColumn("cell", cell).withColumn("part", F.pmod("cell", F.lit(groups)).cast("int"))

    left = dealt(held, "vec_id", "blocks", "copies").select("part", "vec_id", "embedding", "t", "bucket", "cell")
    right = dealt(probes, "query_id", "copies", "blocks").groupBy("part", "query_id").agg(F.collect_list("cell").alias("visited"))
    find = nearest(hashes, k)
    return left.groupBy("part").cogroup(right.join(asked, "query_id").select("part", "query_id", "embedding", "visited").groupBy("part")).applyInPandas(lambda v, q: find(v, q), FOUND)


def short_of(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The queries for which fewer than k were found."""
    return asked.join(found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).filter(F.col("n") >= k), "query_id", "left_anti")


def search(vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each of the vectors (vec_id, embedding) that `queries` picks, the k of largest cosine among all others found, ties to the smaller id.

    fitted() draws the hash functions and sets, by queries whose answers are known, how far from home a query probes; probed() visits those buckets of all tables and ranks what they hold by exact cosines.
    A query for which fewer than k are found, or fewer than there are, is put to all vectors. Vectors that can't be compared take no part. Rows that repeat an id are one candidate, under its best score; an empty table gives no rows.
    """
    vectors = stored(usable(vectors), "vectors")
    n = vectors.count()
    if not n:
        return vectors.selectExpr("vec_id query_id", "1 rank", "vec_id", "1D score").limit(0)
    asked = stored(vectors.filter(queries).select(F.col("vec_id").alias("query_id"), "embedding").dropDuplicates(["query_id"]), "asked")
    found = stored(probed(vectors, asked, fitted(vectors, asked, n, k), n, k), "found")
    short = short_of(asked, found, k)
    found = found.unionByName(scanned(vectors, short, n, k)) if not short.isEmpty() else found
    return ranked(found, k)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
