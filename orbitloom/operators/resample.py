"""Resampling from one affine grid to another within a coordinate system, tile by tile, by published convolution kernels: rows first, then columns; weights are renormalised at the edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A grid: origin x, origin y, pixel size, height, width; rows count away from the origin.
Grid = tuple[float, float, float, int, int]
#: Columns of both grids of a tile: of the source, and of the target with the prefix to_.
GRID = ("x0", "y0", "step", "height", "width")
CUBIC_A = -0.5
#: Weight that a target pixel needs of the source pixels that have a row; with less it has none.
LEAST_WEIGHT = 0.2


def grids(tiles: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """tiles with the same two grids for each."""
    return tiles.withColumns({p + c: F.lit(v) for p, grid in (("", source), ("to_", target)) for c, v in zip(GRID, grid, strict=True)})


def cubic(d: Column) -> Column:
    a, d = CUBIC_A, F.abs(d)
    near = (a + 2) * d * d * d - (a + 3) * d * d + 1
    far = a * d * d * d - 5 * a * d * d + 8 * a * d - 4 * a
    return F.when(d <= 1, near).when(d < 2, far).otherwise(0.0)


def weights(tiles: DataFrame, axis: str, kind: str) -> DataFrame:
    """(tile_id, place, from, w): the source rows, or columns, that each row, or column, of a tile's target grid reads. Made from the grids alone: as many rows as a tile has along one axis, times the kernel's width."""
    origin, length = ("x0", "width") if axis == "x" else ("y0", "height")
    own = tiles.select("tile_id", origin, "step", length, f"to_{origin}", "to_step", F.explode(F.sequence(F.lit(0), F.col(f"to_{length}") - 1)).alias("place"))
    # where the centre lies, in source pixels whose centres are whole numbers; a centre outside reads nothing
    own = own.withColumn("at", (F.col(f"to_{origin}") + (F.col("place") + 0.5) * F.col("to_step") - F.col(origin)) / F.col("step") - 0.5).filter((F.col("at") >= -0.5) & (F.col("at") <= F.col(length) - 0.5))
    if kind == "nearest":
        own = own.withColumns({"from": F.floor(F.col("at") + 0.5).cast("int"), "w": F.lit(1.0)})
    else:
        low, high = (0, 1) if kind == "bilinear" else (-1, 2)
        one = cubic if kind == "cubic" else lambda d: F.greatest(1 - F.abs(d), F.lit(0.0))
        own = own.withColumn("from", F.explode(F.sequence(F.floor("at").cast("int") + low, F.floor("at").cast("int") + high))).withColumn("w", one(F.col("at") - F.col("from")))
    return own.filter((F.col("from") >= 0) & (F.col("from") < F.col(length)) & (F.col("w") != 0)).select("tile_id", "place", "from", "w")


def resample(pixels: DataFrame, keys: list[str], values: str | list[str], tiles: DataFrame, kind: str = "nearest") -> DataFrame:
    """(keys, y, x, values) on each tile's target grid; keys hold tile_id, and tiles (tile_id and both grids, see GRID) has one row a tile. A target pixel that reads no source pixel has no row, and a tile without grids has none. Values of a row
    are all there or all null; null counts as no row.

    Rows are weighted first: that makes a value for each target row and source column, of which the columns' weights then make the result. So a source pixel is sent to the few target rows that read it, and what these have summed to the few target
    columns, in place of once for each pair of both. Both sums are made where the target rows are: rows are moved once. The weight that has a row is summed along with the values.
    """
    values = [values] if isinstance(values, str) else values
    y, x = (weights(tiles, a, kind).withColumnRenamed("place", f"_{a}") for a in "yx")
    rows = pixels.filter(F.col(values[0]).isNotNull()).join(y.withColumnRenamed("from", "y"), ["tile_id", "y"])
    if kind == "nearest":
        return rows.join(x.withColumnRenamed("from", "x").drop("w"), ["tile_id", "x"]).select(*keys, F.col("_y").alias("y"), F.col("_x").alias("x"), *values)
    rows = rows.repartition(*keys, "_y").groupBy(*keys, "_y", "x").agg(*(F.sum(F.col("w") * F.col(v)).alias(v) for v in values), F.sum("w").alias("_s"))
    sums = rows.join(x.withColumnRenamed("from", "x"), ["tile_id", "x"]).groupBy(*keys, "_y", "_x").agg(*(F.sum(F.col("w") * F.col(v)).alias(v) for v in values), F.sum(F.col("w") * F.col("_s")).alias("_s"))
    return sums.filter(F.col("_s") >= LEAST_WEIGHT).select(*keys, F.col("_y").alias("y"), F.col("_x").alias("x"), *((F.col(v) / F.col("_s")).alias(v) for v in values))
