"""Toxicity: a linear classifier of character n-grams whose features are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.llm.common import map_rows, stored, table

#: Lengths of the n-grams in bytes of lower-cased UTF-8, and bits of the hash that stands for one.
LENGTHS, BITS = (4, 5, 6), 20
#: About so many labelled rows are fitted, drawn by a hash of their id; all, if there are no more.
SAMPLE = 20_000
#: Features kept, by the strength of their difference between the classes.
FEATURES = 5_000
SMOOTHING, PENALTY, STEPS, RATE = 1.0, 1e-4, 300, 0.05
THRESHOLD = 0.7
#: Bytes of a long text that are hashed at once.
SEGMENT = 1 << 20

_LOWER = np.full(256, 32, np.uint8)  # what isn't a letter, digit or apostrophe is blank
_LOWER[97:123] = np.arange(97, 123)
_LOWER[65:91] = np.arange(97, 123)
_LOWER[48:58] = np.arange(48, 58)
_LOWER[128:] = np.arange(128, 256)
_LOWER[39] = 39


def hashes(text: str) -> Iterator[np.ndarray]:
    """The hashed n-grams of a whole text with a blank before and after it and single blanks inside, with repeats."""
    data = _LOWER[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    blank = data == 32
    data = data[~np.r_[False, blank[1:] & blank[:-1]]]
    for at in range(0, len(data), SEGMENT):
        b = data[at : at + SEGMENT + LENGTHS[-1] - 1].astype(np.uint32)
        h = np.zeros(len(b), np.uint32)
        for n in range(1, LENGTHS[-1] + 1):
            if len(b) < n:
                break
            h = h[: len(b) - n + 1] * np.uint32(0x01000193) + b[n - 1 :] + np.uint32(1)
            if n in LENGTHS:
                yield ((h ^ h >> np.uint32(15)) * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BITS)


@dataclass
class Model:
    """slot: by hash, the feature's place or -1; weight: its log-count ratio times its coefficient."""

    slot: np.ndarray
    weight: np.ndarray
    bias: float

    def features(self, text: str) -> np.ndarray:
        found = [s[s >= 0] for s in (self.slot[h] for h in hashes(text))]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int16)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weight[self.features(text)].sum() + self.bias, -40, 40))))


def training_part(doc_id: str = "doc_id"):
    """True for the rows whose labels may be learnt."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 != 1


def counted(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class, and those with each hash: eight tasks count the bounded sample into arrays of fixed size, the driver adds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, having = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.zeros(1 << BITS, bool)
                for h in hashes(text or ""):
                    own[h] = True
                rows[toxic] += 1
                having[toxic] += own
        yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary()), pa.array([zlib.compress(having.tobytes(), 1)], pa.binary())], names=["n", "having"])

    n, having = np.zeros(2), np.zeros((2, 1 << BITS))
    for r in sample.repartition(8).select("text", "toxic").mapInArrow(run, "n binary, having binary").collect():  # of eight tasks
        n += np.frombuffer(r["n"], np.int64)
        having += np.frombuffer(zlib.decompress(r["having"]), np.int32).reshape(2, -1)
    return n, having


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits the bounded sample of the labelled rows of the training part. A row labelled more than once counts as toxic if one label says so; null labels don't count. Without rows of both classes every score is the share of toxic rows, or a half."""
    own = labels.filter("doc_id is not null and toxic in (0, 1)").filter(training_part()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = SAMPLE / max(1, own.count())
    own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("text", "toxic"), "labelled")
    n, having = counted(sample)
    slot = np.full(1 << BITS, -1, np.int16)
    if not n.all():
        share = float(n[1] / n.sum()) if n.sum() else 0.5
        return Model(slot, np.zeros(1), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    spread = np.sqrt((having.sum(0) + 1) / n.sum() * (1 / n[0] + 1 / n[1]))
    strength = np.abs(having[1] / n[1] - having[0] / n[0]) / spread
    kept = np.sort(np.argsort(-strength, kind="stable")[:FEATURES])
    slot[kept] = np.arange(len(kept))
    ratio = np.log((having[1, kept] + SMOOTHING) / (n[1] + 2 * SMOOTHING)) - np.log((having[0, kept] + SMOOTHING) / (n[0] + 2 * SMOOTHING))
    model = Model(slot, ratio, 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[tuple], Iterable[tuple]]:
        return lambda row: [(shared.value.features(row[0] or "").astype("<i2").tobytes(), row[1])]

    rows = map_rows(sample.select("text", "toxic"), make, "features binary, toxic int").collect()  # at most the sample
    rows.sort()
    label = np.array([r["toxic"] for r in rows], float)
    each = [np.frombuffer(r["features"], "<i2") for r in rows]
    model.weight, model.bias = regression(each, label, ratio)
    shared.destroy()
    return model


def regression(each: list[np.ndarray], label: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression over present features scaled by their ratio, by Adam's steps over the whole sample; returns the weights with the scale in them."""
    at, doc, n = np.concatenate(each).astype(np.int64), np.repeat(np.arange(len(each)), [len(x) for x in each]), len(each)
    theta, first, second = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for step in range(1, STEPS + 1):
        margin = np.bincount(doc, (theta[:-1] * ratio)[at], n) + theta[-1]
        error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - label
        slope = np.append(np.bincount(at, error[doc], len(ratio)) * ratio / n + PENALTY * theta[:-1], error.mean())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-1] * ratio, float(theta[-1])


def scored(df: DataFrame, text: str, model: Model, name: str = "score") -> DataFrame:
    """All rows and columns with a score, 0 to 1, of the whole text (null: empty) in the column named."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)

    def make() -> Callable[[tuple], Iterable[tuple]]:
        score = shared.value.score
        return lambda row: [(*row, score(row[at] or ""))]

    return map_rows(df, make, ", ".join([*(f"`{c}` {kind}" for c, kind in df.dtypes), f"`{name}` double"]))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, "text", fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (~training_part()).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
