"""Mixing to target weights: iterative proportional fitting of token weights, then sampling by calibrated probabilities."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.llm.common import by_bytes, marked, release, stored, table

#: What the cells are made of.
DIMENSIONS = ("source", "lang", "topic")
#: Cells that are raked on the driver and broadcast back; a longer table of cells is raked by grouped sums and joins instead, and its CELLS heaviest alone are broadcast.
CELLS = 100_000
#: Topics, rounds of fitting them, and bins of the hashed words that tell them apart.
TOPICS, ROUNDS, BINS = 12, 6, 256
#: Tasks that add up what others have summed.
FEW = 8
#: Targets: shares by category (None: of the null source or language), or a power that tempers the shares found.
TARGETS = {"source": 0.5, "lang": 0.7, "topic": 0.7}
#: Tokens to keep, as a share of all.
BUDGET = 0.7

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: A number for each byte, and the base of the polynomial that hashes a word, with its inverse modulo 2^64.
_LETTERS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def powers(name: str, number: int) -> np.ndarray:
    """The first powers, kept for texts to come up to a bound."""
    held = _POWERS[name]
    if len(held) < number:
        factors = np.full(number, _BASE if name == "base" else pow(_BASE, -1, 1 << 64), np.uint64)
        factors[0] = 1
        held = np.cumprod(factors)
        if number <= 1 << 20:
            _POWERS[name] = held
    return held[:number]


def profile(text: str) -> tuple[int, bytes]:
    """The number of words of a whole text between white space of ASCII, and how many of them fall into each of BINS by a hash of the whole word with A-Z in lower case: BINS unsigned 32-bit numbers."""
    data = np.frombuffer(text.encode(), np.uint8)
    blank = np.concatenate([[True], _BLANK[data], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[data] * powers("base", len(data)))]) if len(data) else np.zeros(1, np.uint64)
    h = (sums[end] - sums[start]) * powers("inverse", len(data) + 1)[start] if len(start) else sums[:0]  # as if each word began the text
    bins = ((h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(56)).astype(np.int64)
    return len(start), np.bincount(bins, minlength=BINS).astype("<u4").tobytes()


@dataclass
class Topics:
    """Clusters of documents by the words in them: a document belongs to the centre of largest cosine with its logarithmic counts, scaled by how rare a bin is among all documents."""

    rarity: np.ndarray
    centres: np.ndarray  # topics, bins; unit rows

    def vectors(self, profiles: list[bytes]) -> np.ndarray:
        x = np.log1p(np.frombuffer(b"".join(profiles), "<u4").reshape(-1, BINS).astype(float)) * self.rarity
        return x / np.maximum(np.sqrt((x * x).sum(1)), 1e-300)[:, None]

    def of(self, profiles: list[bytes]) -> np.ndarray:
        return (self.vectors(profiles) @ self.centres.T).argmax(1)

    def names(self, profiles: list[bytes]) -> list[str]:
        """Of documents with words; the others are empty."""
        if not profiles or not len(self.centres):
            return ["empty"] * len(profiles)
        some = np.frombuffer(b"".join(profiles), "<u4").reshape(-1, BINS).any(1)
        return [f"topic {k}" if x else "empty" for k, x in zip(self.of(profiles).tolist(), some.tolist(), strict=True)]


def summed(profiles: DataFrame, add: Callable[[list[bytes]], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of add() over all profiles: each task adds up its own, a few tasks the sums of many, the driver those of the few."""
    kind = [pa.field("total", pa.binary())]

    def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for own in batch.column(0).to_pylist():
                total += np.frombuffer(own).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], schema=pa.schema(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                total += add(batch.column(0).slice(at, 1024).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])
        release()

    parts = profiles.select("profile").mapInArrow(run, "total binary").repartition(FEW).mapInArrow(more, "total binary").collect()
    return sum((np.frombuffer(r["total"]).reshape(shape) for r in parts), np.zeros(shape))


def fitted_topics(profiles: DataFrame, topics: int = TOPICS, rounds: int = ROUNDS) -> Topics:
    """Topics of all documents with words, by rounds of assigning each to its nearest centre and moving the centres to the means; the first centres are different documents that a hash picks."""
    some = profiles.filter("tokens > 0").select("profile")
    seeds = [bytes(r["profile"]) for r in some.distinct().orderBy(F.xxhash64("profile"), "profile").limit(topics).collect()]
    if not seeds:
        return Topics(np.ones(BINS), np.zeros((0, BINS)))
    counts = summed(some, lambda own: np.r_[(np.frombuffer(b"".join(own), "<u4").reshape(-1, BINS) > 0).sum(0), len(own)], (BINS + 1,))
    found = Topics(np.log((2 + counts[-1]) / (1 + counts[:-1])), np.zeros((0, BINS)))
    found.centres = found.vectors(seeds)

    def moved(own: list[bytes]) -> np.ndarray:
        x = found.vectors(own)
        return np.eye(len(seeds))[:, (x @ found.centres.T).argmax(1)] @ x

    for _ in range(rounds):
        total = summed(some, moved, (len(seeds), BINS))
        norms = np.sqrt((total * total).sum(1))[:, None]
        new = np.where(norms > 0, total / np.maximum(norms, 1e-300), found.centres)
        done, found.centres = np.abs(new - found.centres).max() < 1e-6, new
        if done:
            break
    return found


def category(name: str) -> Column:
    """A category's name that tells null from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def named(target: float | dict) -> float | dict[str, float]:
    return {"" if k is None else f"={k}": float(v) for k, v in target.items()} if isinstance(target, dict) else float(target)


def rake_cells(at: list[np.ndarray], mass: np.ndarray, targets: list[np.ndarray], rounds: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """Weights of cells, given by their place along each axis, such that mass * weight has the target shares along each axis, as near as absent cells let it. Targets of categories without mass are dealt out to the others."""
    weight, total = np.ones_like(mass), mass.sum()
    for _ in range(rounds):
        worst = 0.0
        for own, target in zip(at, targets, strict=True):
            now = np.bincount(own, mass * weight, len(target)).astype(float)
            wanted = np.where(now > 0, target, 0)
            wanted = wanted / max(wanted.sum(), 1e-300) * total
            factor = np.divide(wanted, now, out=np.zeros_like(now), where=now > 0)
            worst = max(worst, float(np.abs(factor[now > 0] - 1).max(initial=0)))
            weight = weight * factor[own]
        if worst < tolerance:
            break
    return weight


def rake(mass: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """rake_cells of a dense array."""
    return rake_cells([x.ravel() for x in np.indices(mass.shape)], mass.ravel(), targets).reshape(mass.shape)


def probabilities(mass: np.ndarray, weight: np.ndarray, budget: float) -> np.ndarray:
    """min(1, factor * weight), with the factor at which the tokens expected are `budget` of all; what cells at 1 can't give the others do."""
    m, w = mass.ravel(), weight.ravel()
    some = (m > 0) & (w > 0)
    if not some.any():
        return np.ones_like(mass)
    order = np.argsort(-w[some], kind="stable")
    m, w = m[some][order], w[some][order]
    goal = min(budget * mass.sum(), m.sum())
    sure = np.concatenate([[0.0], np.cumsum(m)[:-1]])  # tokens of the cells before, all at probability 1
    rest = np.cumsum((m * w)[::-1])[::-1]
    factor = (goal - sure) / rest
    fits = np.flatnonzero(factor * w <= 1 + 1e-12)
    return np.where(weight > 0, np.minimum(1.0, weight * factor[fits[0]]), 0.0) if len(fits) else (weight > 0).astype(float)


def share_targets(found: np.ndarray, names: list[str], target: float | dict[str, float]) -> np.ndarray:
    if isinstance(target, dict):
        out = np.array([target.get(n, 0.0) for n in names])
    else:
        out = np.where(found > 0, np.power(found / max(found.sum(), 1), target), 0)
    return out / max(out.sum(), 1e-300)


def planned(cells: DataFrame, targets: dict, budget: float) -> DataFrame:
    """cells (source, lang, topic, tokens) with weight and probability, on the driver."""
    found = cells.collect()
    mass = np.array([r["tokens"] for r in found], float)
    at, wanted = [], []
    for d in DIMENSIONS:
        names = sorted({r[d] for r in found})
        place = {x: k for k, x in enumerate(names)}
        at.append(np.array([place[r[d]] for r in found], int))
        wanted.append(share_targets(np.bincount(at[-1], mass, len(names)).astype(float), names, targets[d]))
    weight = rake_cells(at, mass, wanted)
    plan = [(*r, w, p) for r, w, p in zip(found, weight.tolist(), probabilities(mass, weight, budget).tolist(), strict=True)]
    return cells.sparkSession.createDataFrame(plan, "source string, lang string, topic string, tokens long, weight double, probability double")


def planned_at_large(cells: DataFrame, targets: dict, budget: float, rounds: int = 200, tolerance: float = 1e-9) -> DataFrame:
    """The rows of planned() by a grouped sum and a join per axis and round; only sums come to the driver."""
    spark = cells.sparkSession
    total = float(cells.agg(F.sum("tokens")).first()[0])
    wanted = []
    for d in DIMENSIONS:
        own = cells.groupBy(d).agg(F.sum("tokens").cast("double").alias("found"))
        if isinstance(targets[d], dict):
            shares = spark.createDataFrame(list(targets[d].items()), f"{d} string, target double")
            own = own.join(shares, d, "left").select(d, F.coalesce("target", F.lit(0.0)).alias("target"))
        else:
            own = own.select(d, F.pow(F.col("found") / total, F.lit(targets[d])).alias("target"))
        wanted.append(stored(own, "wanted"))
    now = cells.withColumn("weight", F.lit(1.0))
    for _ in range(rounds):
        worst = 0.0
        for d, target in zip(DIMENSIONS, wanted, strict=True):
            sums = stored(now.groupBy(d).agg(F.sum(F.col("tokens") * F.col("weight")).alias("now")).join(target, d).filter("now > 0"), "sums")
            share = sums.agg(F.sum("target")).first()[0] or 0.0
            factors = sums.select(d, (F.col("target") / max(share, 1e-300) * total / F.col("now")).alias("factor"))
            worst = max(worst, factors.agg(F.max(F.abs(F.col("factor") - 1))).first()[0] or 0.0)
            now = now.join(factors, d, "left").withColumn("weight", F.col("weight") * F.coalesce("factor", F.lit(0.0))).select(*cells.columns, "weight")
        now = stored(now, "raked")
        if worst < tolerance:
            break
    some = now.filter("tokens > 0 and weight > 0")
    goal = min(budget * total, float(some.agg(F.sum("tokens")).first()[0] or 0))
    factor = 0.0
    while True:  # cells that reach 1 leave the rest to the others, until no more do
        sure = F.col("weight") * factor > 1
        r = some.agg(F.sum(F.when(sure, F.col("tokens"))).alias("sure"), F.sum(F.when(~sure, F.col("tokens") * F.col("weight"))).alias("rest")).first()
        new = (goal - (r["sure"] or 0)) / r["rest"] if r["rest"] else factor
        if new <= factor * (1 + 1e-14):
            break
        factor = new
    chance = F.least(F.lit(1.0), F.col("weight") * factor) if goal else F.lit(1.0)
    return now.withColumn("probability", chance)


def mixed(df: DataFrame, text: str, keep: list[str], targets: dict | None = None, budget: float = BUDGET, seed: int = 1, order: str = "doc_id", prefix: str = "") -> DataFrame:
    """The columns in keep, which hold `source`, `lang` and the column named in order, with tokens, topic, weight, probability and kept, these with the prefix before their names.

    Topics are fitted to all documents. Tokens are summed by cell (source, language, topic), whatever number of them there is, and the cells are raked on the driver and broadcast back, or past CELLS of them as a stored table.
    A row is kept if a hash of its `order` value, uniform in 0 to 1, is under its probability, so equal ids share a fate. A null source or language is a category of its
    own, a null text is empty, a very long one is read whole; rows without tokens count nothing in the marginals and get their cell's probability, or 1 if the cell has no tokens. An empty table stays empty. Columns of any other names pass through.
    """
    spark, m = df.sparkSession, marked([*keep, text])
    targets = {d: named((targets or TARGETS)[d]) for d in DIMENSIONS}
    by_bytes(spark)

    @F.arrow_udf("struct<tokens: long, profile: binary>")
    def profiled(texts: pa.Array) -> pa.Array:
        found = [profile(t or "") for at in range(0, len(texts), 64) for t in texts.slice(at, 64).to_pylist()]
        return pa.StructArray.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())], ["tokens", "profile"])

    # texts go to Python once, and only their profiles come back
    rows = df.select(*keep, profiled(text).alias(f"{m}own")).select(*keep, F.col(f"{m}own.tokens").alias(f"{m}tokens"), F.col(f"{m}own.profile").alias(f"{m}profile"))
    rows = stored(rows, "profiles")
    topics = spark.sparkContext.broadcast(fitted_topics(rows.select(F.col(f"{m}tokens").alias("tokens"), F.col(f"{m}profile").alias("profile"))))

    @F.arrow_udf("string")
    def topic(profiles: pa.Array) -> pa.Array:
        return pa.array([x for at in range(0, len(profiles), 1024) for x in topics.value.names(profiles.slice(at, 1024).to_pylist())], pa.string())

    rows = rows.withColumns({f"{m}source": category("source"), f"{m}lang": category("lang"), f"{m}topic": topic(f"{m}profile")}).drop(f"{m}profile")
    cells = rows.filter(F.col(f"{m}tokens") > 0).groupBy(*(F.col(m + d).alias(d) for d in DIMENSIONS)).agg(F.sum(f"{m}tokens").alias("tokens"))
    cells = stored(cells, "cells")
    dims, sent = [m + d for d in DIMENSIONS], {c: m + c for c in (*DIMENSIONS, "weight", "probability")}
    if cells.count() <= CELLS:
        joined = rows.join(F.broadcast(planned(cells, targets, budget).drop("tokens").withColumnsRenamed(sent)), dims, "left")
    else:
        plan = stored(planned_at_large(cells, targets, budget).withColumnsRenamed(sent), "plan")
        top = stored(plan.orderBy(F.desc("tokens"), *dims).limit(CELLS).drop("tokens"), "heavy")
        light = plan.drop("tokens").join(top.select(*dims), dims, "left_anti").withColumnsRenamed({f"{m}weight": f"{m}w", f"{m}probability": f"{m}p"})
        # rows of heavy cells are dealt at random, as a light cell has few rows and a heavy one may have most
        joined = rows.join(F.broadcast(top), dims, "left").withColumn(f"{m}deal", F.when(F.col(f"{m}weight").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(order)))
        joined = joined.join(light.withColumn(f"{m}deal", F.lit(0).cast("long")), [*dims, f"{m}deal"], "left").withColumns({f"{m}weight": F.coalesce(f"{m}weight", f"{m}w"), f"{m}probability": F.coalesce(f"{m}probability", f"{m}p")})
    luck = F.pmod(F.xxhash64(F.coalesce(F.col(order).cast("string"), F.lit("(null)")), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    joined = joined.withColumns({f"{m}weight": F.coalesce(f"{m}weight", F.lit(1.0)), f"{m}probability": F.coalesce(f"{m}probability", F.lit(1.0))}).withColumn(f"{m}kept", luck < F.col(f"{m}probability"))
    return joined.select(*keep, *(F.col(m + c).alias(prefix + c) for c in ("tokens", "topic", "weight", "probability", "kept")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), "text", ["doc_id", "source", "lang"])
