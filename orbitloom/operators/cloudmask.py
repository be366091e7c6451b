"""Cloud mask refinement: channel statistics, overlapping patches, scores of two models, blending."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from orbitloom.functions.constants import CLOUD_CHANNELS

CLASSES = 4
IMAGE = ["tile_id", "obs_date"]
LEAST_PATCH, MOST_PATCH = 32, 1000
#: Patches a call of the models.
PATCHES = 8


def auto_patch(height: int, width: int, overlap: int = 300) -> tuple[int, int]:
    """Patch size and overlap for an image."""
    size = max(LEAST_PATCH, min(MOST_PATCH, height, width))
    return size, min(overlap, size // 2)


def starts(length: Column, size: int, overlap: int) -> Column:
    """The starts of windows along an axis: every stride, the last ones drawn back to the last full window, none below 0, each once."""
    return F.array_distinct(F.transform(F.sequence(F.lit(0), length - 1, F.lit(size - overlap)), lambda s: F.greatest(F.least(s, length - size), F.lit(0)).cast("int")))


def patch_grid(images: DataFrame, size: int, overlap: int) -> DataFrame:
    """images (height, width and other columns) with patch, top, left: one row a window, row by row."""
    rows = images.withColumn("top", F.explode(starts(F.col("height"), size, overlap))).withColumn("left", F.explode(starts(F.col("width"), size, overlap)))
    return rows.withColumn("patch", F.col("top") * F.col("width") + F.col("left"))


def ramp(i: Column, size: int, overlap: int) -> Column:
    if not overlap:
        return F.lit(1.0)
    return F.when(i < overlap, (i + 1) / float(overlap)).when(i >= size - overlap, (F.lit(size) - i) / float(overlap)).otherwise(1.0)


def gradient(i: Column, j: Column, size: int, overlap: int) -> Column:
    """The weight of row i and column j of a patch."""
    overlap = size // 2 if overlap * 2 > size else overlap
    return ramp(i, size, overlap) * ramp(j, size, overlap)


def channels(s2: DataFrame) -> DataFrame:
    """(tile_id, obs_date, y, x, c, v): the three channels of the mask, one row each."""
    return s2.select(*IMAGE, "y", "x", F.posexplode(F.array(*(F.get("bands", F.lit(k)) for k in CLOUD_CHANNELS))).alias("c", "v"))


def channel_norm(rows: DataFrame) -> DataFrame:
    """norm: (v - mean) / std over an image's channel without its zeros (population std, 0 counts as 1); zeros stay 0."""
    keys = [*IMAGE, "c"]
    v = F.when(F.col("v") != 0, F.col("v").cast("double"))
    stats = rows.groupBy(*keys).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))  # one row an image and channel
    std = F.when(F.col("std") == 0, 1.0).otherwise(F.col("std"))
    return rows.join(stats, keys).withColumn("norm", F.when(F.col("v") != 0, (F.col("v") - F.col("mean")) / std).otherwise(0.0)).drop("mean", "std")


def normalised(s2: DataFrame) -> DataFrame:
    """(tile_id, obs_date, y, x, n0, n1, n2): the values of channel_norm() side by side, with one grouping for the statistics."""
    rows = s2.select(*IMAGE, "y", "x", *(F.get("bands", F.lit(k)).cast("double").alias(f"v{c}") for c, k in enumerate(CLOUD_CHANNELS)))
    own = [F.when(F.col(f"v{c}") != 0, F.col(f"v{c}")) for c in range(3)]
    stats = rows.groupBy(*IMAGE).agg(*(f(v).alias(f"{name}{c}") for c, v in enumerate(own) for name, f in (("mean", F.avg), ("std", F.stddev_pop))))  # one row an image

    def norm(c: int) -> Column:
        std = F.when(F.col(f"std{c}") == 0, 1.0).otherwise(F.col(f"std{c}"))
        return F.when(F.col(f"v{c}") != 0, (F.col(f"v{c}") - F.col(f"mean{c}")) / std).otherwise(0.0)

    return rows.join(stats, IMAGE).select(*IMAGE, "y", "x", *(norm(c).alias(f"n{c}") for c in range(3)))


def holding(at: str, length: int, size: int, overlap: int) -> Column:
    """The starts of the windows along an axis that hold a place: those of whole strides by arithmetic, and the last one."""
    stride, last = size - overlap, max(length - size, 0)
    low, high = F.greatest(F.ceil((F.col(at) - size + 1) / stride), F.lit(0)), F.floor(F.col(at) / stride)
    whole = F.transform(F.sequence(low.cast("int"), high.cast("int")), lambda k: F.least(k * stride, F.lit(last)))
    return F.filter(F.array_distinct(F.concat(F.when(low <= high, whole).otherwise(F.array().cast("array<int>")), F.array(F.lit(last)))), lambda s: (s <= F.col(at)) & (F.col(at) < s + size))


def patch_pixels(pixels: DataFrame, height: int, width: int, size: int, overlap: int) -> DataFrame:
    """Each pixel in every patch that holds it, with its place i, j there."""
    rows = pixels.withColumn("top", F.explode(holding("y", height, size, overlap))).withColumn("left", F.explode(holding("x", width, size, overlap)))
    return rows.withColumns({"patch": F.col("top") * width + F.col("left"), "i": F.col("y") - F.col("top"), "j": F.col("x") - F.col("left")})


Model = Callable[[np.ndarray], np.ndarray]


def linear_model(scale: float) -> Model:
    """A fixed stand-in, not a trained network: four linear scores of a pixel's three channels."""
    w = np.array([[0.5, 0.25, -0.25], [1.0, -0.5, 0.25], [-0.75, 1.0, 0.5], [0.25, 0.5, -1.0]]) * scale
    return lambda batch: np.einsum("kc,bchw->bkhw", w, batch)


def onnx_models(first: str, second: str) -> Callable[[], tuple[Model, Model]]:
    """Loads two model files once a task, one thread each."""

    def load() -> tuple[Model, Model]:
        import onnxruntime

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = options.inter_op_num_threads = 1

        def model(path: str) -> Model:
            session = onnxruntime.InferenceSession(path, options)
            name = session.get_inputs()[0].name
            return lambda batch: session.run(None, {name: batch.astype(np.float32)})[0]

        return model(first), model(second)

    return load


def whole_patches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one patch after another, from rows ordered by patch, wherever batches are cut."""
    keys, held = [*IMAGE, "patch"], []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for c in keys:
            v = batch.column(c)
            change |= pc.not_equal(v[1:], v[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and any(held[0].column(c)[0] != part.column(c)[0] for c in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def cloud_scores(rows: DataFrame, size: int, load: Callable[[], tuple[Model, Model]], batch: int = PATCHES) -> DataFrame:
    """(tile_id, obs_date, y, x, i, j, cls, score) from patch_pixels(): the mean of two models' scores for each pixel of each patch, model(patches x 3 x size x size) -> patches x 4 x size x size.

    Patches are dealt to tasks and stream through them in order of rows; each call of the models gets `batch` patches, and no more than these are held. load() makes the models, once a task. Patches of zeros only are left out.
    """
    kinds = dict(rows.dtypes)
    schema = f"tile_id {kinds['tile_id']}, obs_date {kinds['obs_date']}, y int, x int, i int, j int, s0 double, s1 double, s2 double, s3 double"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, patches = load(), whole_patches(batches)

        def planes(table: pa.Table) -> np.ndarray:
            image = np.zeros((3, size, size))
            for c in range(3):
                image[c, table["i"].to_numpy(), table["j"].to_numpy()] = table[f"n{c}"].to_numpy()
            return image

        def scored(some: list[tuple[pa.Table, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            images = np.stack([image for _, image in some])
            scores = (np.asarray(models[0](images)) + np.asarray(models[1](images))) * 0.5
            for k, (table, _) in enumerate(some):
                at = scores[k][:, table["i"].to_numpy(), table["j"].to_numpy()]
                columns = [table[c].combine_chunks() for c in (*IMAGE, "y", "x", "i", "j")] + [pa.array(v.astype(float)) for v in at]
                yield from pa.Table.from_arrays(columns, schema=arrow).to_batches()

        some = []
        for table in patches:
            image = planes(table)
            if image.any():
                some.append((table, image))
            if len(some) == batch:
                yield from scored(some)
                some = []
        if some:
            yield from scored(some)

    own = rows.select(*IMAGE, "patch", "y", "x", "i", "j", "n0", "n1", "n2").repartition(*IMAGE, "patch").sortWithinPartitions(*IMAGE, "patch")
    return own.mapInArrow(run, schema).select(*IMAGE, "y", "x", "i", "j", F.posexplode(F.array(*(F.col(f"s{k}") for k in range(CLASSES)))).alias("cls", "score"))


def patch_blend(scores: DataFrame, size: int, overlap: int) -> DataFrame:
    """Per pixel and class the weighted mean over the patches that hold it."""
    w = gradient(F.col("i"), F.col("j"), size, overlap)
    return scores.groupBy(*IMAGE, "y", "x", "cls").agg(F.sum(F.col("score") * w).alias("num"), F.sum(w).alias("den")).select(*IMAGE, "y", "x", "cls", (F.col("num") / F.col("den")).alias("score"))


def patch_argmax(blended: DataFrame) -> DataFrame:
    """The class of the largest score, of equal ones the lowest. A pixel in no scored patch has no row: class 0."""
    return blended.groupBy(*IMAGE, "y", "x").agg(F.max_by("cls", F.struct("score", -F.col("cls"))).alias("cls"))


def mask_optimised(s2: DataFrame, classes: DataFrame) -> DataFrame:
    """s2 with mask_opt: 1 where a scene was valid, the class is clear and one of the three channels isn't 0."""
    rows = s2.join(classes, [*IMAGE, "y", "x"], "left")
    some = F.greatest(*(F.get("bands", F.lit(k)) != 0 for k in CLOUD_CHANNELS))
    return rows.withColumn("mask_opt", ((F.col("mask") == 1) & (F.coalesce("cls", F.lit(0)) == 0) & some).cast("tinyint")).drop("cls")
