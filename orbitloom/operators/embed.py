"""Embeddings: batch scoring, averaging over passes, quantisation, comparison of runs, dense grids."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from orbitloom.functions.constants import BANDS, LATENT, S1_MEAN, S1_STD, S2_MEAN, S2_STD, SAMPLES
from orbitloom.functions.scalars import dequantise, quantise, quantise_scale

#: model(s2 [B, slots, 11], s1 [B, slots, 3]) -> [B, dimensions]
Model = Callable[[np.ndarray, np.ndarray], np.ndarray]
BATCH = 256


def linear_model(dimensions: int = LATENT) -> Model:
    """A fixed stand-in for an encoder: the mean over the slots times a literal matrix, weight of input f for output d: ((7 f + 3 d) mod 11 - 5) / 10."""
    f, d = np.arange(14)[:, None], np.arange(dimensions)[None]
    w = ((7 * f + 3 * d) % 11 - 5) / 10.0
    return lambda s2, s1: np.concatenate([s2.mean(1), s1.mean(1)], axis=1) @ w


def onnx_model(path: str) -> Callable[[], Model]:
    """Loads a model file once a worker process, one thread a task."""

    def load() -> Model:
        import onnxruntime

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = options.inter_op_num_threads = 1
        session = onnxruntime.InferenceSession(path, options)
        names = [i.name for i in session.get_inputs()]
        return lambda s2, s1: session.run(None, dict(zip(names, (s2.astype(np.float32), s1.astype(np.float32)), strict=True)))[0]

    return load


def embed_pixels(samples: DataFrame, load: Callable[[], Model] = linear_model, slots: int = SAMPLES) -> DataFrame:
    """(tile_id, y, x, emb): each pixel's matrices scored in batches and averaged over its passes; the model is loaded once a task."""
    kinds = dict(samples.dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            for at in range(0, len(frame), BATCH):
                part = frame.iloc[at : at + BATCH]
                s2 = np.array([np.stack(p) for p in part["s2_passes"]]).reshape(len(part), -1, slots, 11)
                s1 = np.array([np.stack(p) for p in part["s1_passes"]]).reshape(len(part), -1, slots, 3)
                total = sum(model(s2[:, r], s1[:, r]) for r in range(s2.shape[1])) / s2.shape[1]
                yield part[["tile_id", "y", "x"]].assign(emb=list(total))

    return samples.mapInPandas(run, f"tile_id {kinds['tile_id']}, y {kinds['y']}, x {kinds['x']}, emb array<double>")


def packed_series(series: DataFrame, days: DataFrame) -> DataFrame:
    """(tile_id, y, x, doy2, v2, doy1, v1) from pixels.pixel_series() and a tile's days (tile_id, days2, days1): what a pixel's samples are drawn from, as flat lists of integers, however many passes and slots there will be.

    These are its valid observations in order, or, without any, all of its tile's times, with zeros at times it has no row for.
    """
    rows = series.join(days, "tile_id")
    rows = rows.withColumn("s1", F.coalesce("s1", F.array().cast(dict(series.dtypes)["s1"])))
    rows = rows.withColumns({"ok2": F.filter("s2", lambda e: e["mask"] == 1), "ok1": F.filter("s1", lambda e: (e["vv"] != 0) | (e["vh"] != 0))})
    zeros = F.array(*(F.lit(0) for _ in BANDS))

    def dense() -> Column:
        seen = F.map_from_entries(F.transform("s2", lambda e: F.struct(e["t"].cast("int"), e["bands"])))
        return F.transform(F.sequence(F.lit(0), F.size("days2") - 1), lambda t: F.coalesce(seen[t.cast("int")], zeros))

    some2, some1 = F.size("ok2") > 0, F.size("ok1") > 0
    both = F.flatten(F.transform("ok1", lambda e: F.array(e["vv"].cast("int"), e["vh"].cast("int"))))
    return rows.select(
        "tile_id", "y", "x",
        F.when(some2, F.transform("ok2", lambda e: e["doy"].cast("int"))).otherwise(F.transform("days2", lambda d: d.cast("int"))).alias("doy2"), F.flatten(F.when(some2, F.transform("ok2", lambda e: e["bands"])).otherwise(dense())).alias("v2"),
        F.when(some1, F.transform("ok1", lambda e: e["doy"].cast("int"))).otherwise(F.transform("days1", lambda d: d.cast("int"))).alias("doy1"), F.when(some1, both).otherwise(F.array_repeat(F.lit(0), F.size("days1") * 2)).alias("v1"),
    )


def strata(n: np.ndarray, slots: int, offset: int) -> np.ndarray:
    """Positions 0..n-1 that fill the slots of each series, a row a series: bin i is [n*i div slots, n*(i+1) div slots) and the offset, modulo its size, picks in it; series of no more than `slots` repeat what they have, the first ones once more."""
    n, i = n.astype(np.int64)[:, None], np.arange(slots)[None]
    first, after = n * i // slots, n * (i + 1) // slots
    many = np.minimum(first + offset % np.maximum(after - first, 1), n - 1)
    each, more = slots // n, slots % n
    few = np.where(i < (each + 1) * more, i // (each + 1), more + (i - (each + 1) * more) // np.maximum(each, 1))
    return np.where(n <= slots, few, many)


def drawn(doys: pa.ListArray, values: pa.ListArray, width: int, mean: tuple, std: tuple, slots: int, passes: int) -> Iterator[np.ndarray]:
    """[series, slots, width + 1] for each pass, normalised, the day of year last; straight from Arrow's buffers."""
    at, n = doys.offsets.to_numpy().astype(np.int64), doys.value_lengths().to_numpy().astype(np.int64)
    day = doys.values.to_numpy()
    v = (values.values.to_numpy()[values.offsets[0].as_py() : values.offsets[-1].as_py()].reshape(-1, width) - np.array(mean)) / (np.array(std) + 1e-9)
    for r in range(passes):
        pick = at[:-1, None] + strata(n, slots, r)
        yield np.concatenate([v[pick - at[0]], day[pick][..., None].astype(float)], axis=2)


def score_series(packed: DataFrame, load: Callable[[], Model] = linear_model, slots: int = SAMPLES, passes: int = 1, batch: int = BATCH) -> DataFrame:
    """(tile_id, y, x, emb) from packed_series(): samples of all passes are drawn where the model is, a batch of pixels at a time, scored and averaged. The model is loaded once a task, and only integers of the series go to Python."""
    kinds = dict(packed.dtypes)
    schema = f"tile_id {kinds['tile_id']}, y {kinds['y']}, x {kinds['x']}, emb array<double>"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for whole in batches:
            for a in range(0, whole.num_rows, batch):
                part = whole.slice(a, batch)
                both = zip(drawn(part["doy2"], part["v2"], len(BANDS), S2_MEAN, S2_STD, slots, passes), drawn(part["doy1"], part["v1"], 2, S1_MEAN, S1_STD, slots, passes), strict=True)
                emb = np.asarray(sum(model(s2, s1) for s2, s1 in both), float) / passes
                out = pa.ListArray.from_arrays(pa.array(np.arange(0, emb.size + 1, emb.shape[1]), pa.int32()), pa.array(emb.ravel()))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in ("tile_id", "y", "x")), out.cast(arrow.field("emb").type)], schema=arrow)

    return packed.select("tile_id", "y", "x", "doy2", "v2", "doy1", "v1").mapInArrow(run, schema)


def pass_average(rows: DataFrame, keys: list[str], vector: str = "emb") -> DataFrame:
    """The mean vector of the rows of a key, component by component."""
    parts = rows.select(*keys, F.posexplode(vector).alias("i", "v")).groupBy(*keys, "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return parts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda e: e["v"]).alias(vector))


def quantised(rows: DataFrame, vector: str = "emb") -> DataFrame:
    """Replaces the vector by q (signed bytes) and scale (float)."""
    return rows.withColumns({"q": quantise(F.col(vector)), "scale": quantise_scale(F.col(vector)).cast("float")}).drop(vector)


def compare_runs(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row: pixels of both runs, per cent of equal bytes, mean and least cosine of the dequantised vectors where a's scale is over 0."""
    both = a.select(*keys, F.col("q").alias("qa"), F.col("scale").alias("sa")).join(b.select(*keys, F.col("q").alias("qb"), F.col("scale").alias("sb")), keys).filter("sa > 0")
    va, vb = dequantise(F.col("qa"), F.col("sa").cast("double")), dequantise(F.col("qb"), F.col("sb").cast("double"))

    def total(x):
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    same = F.aggregate(F.zip_with("qa", "qb", lambda p, q: (p == q).cast("long")), F.lit(0).cast("long"), lambda s, v: s + v)
    both = both.select(same.alias("same"), F.size("qa").alias("n"), va.alias("va"), vb.alias("vb"))
    dot = total(F.zip_with("va", "vb", lambda p, q: p * q))
    norms = F.sqrt(total(F.transform("va", lambda v: v * v))) * F.sqrt(total(F.transform("vb", lambda v: v * v)))
    both = both.select("same", "n", (dot / (norms + 1e-10)).alias("cos"))
    return both.agg(F.count("*").alias("pixels"), (100.0 * F.sum("same") / F.sum("n")).alias("match_pct"), F.avg("cos").alias("mean_cos"), F.min("cos").alias("min_cos"))


def densify_grid(rows: DataFrame, dimensions: int, tiles: DataFrame) -> DataFrame:
    """(tile_id, y, x, q, scale) for every cell of the tiles (tile_id, height, width); cells without a row are zero vectors with scale 0. Cells are made from the ranges alone and joined by key."""
    cells = tiles.select("tile_id", "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y")).select("tile_id", "y", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"))
    full = cells.join(rows, ["tile_id", "y", "x"], "left")
    return full.select("tile_id", "y", "x", F.coalesce("q", F.array_repeat(F.lit(0).cast("tinyint"), dimensions)).alias("q"), F.coalesce("scale", F.lit(0.0).cast("float")).alias("scale"))
