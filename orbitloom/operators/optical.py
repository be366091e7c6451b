"""Optical composites: first clear scene of each pixel and date, coverage, mosaic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitloom.functions.constants import BANDS, LEAST_COVERAGE, SCL_WATER, WATER_SHARE
from orbitloom.functions.scalars import day_of_year, harmonise_bands, scl_valid


def inside(pixels: DataFrame, roi: DataFrame | None, y: str = "y", x: str = "x") -> DataFrame:
    """Only pixels of the region; no region means all."""
    if roi is None:
        return pixels
    own = roi.filter("in_roi > 0").select("tile_id", F.col("y").alias(y), F.col("x").alias(x))
    return pixels.join(own, ["tile_id", y, x], "left_semi")


def valid_observations(scl_obs: DataFrame) -> DataFrame:
    return scl_obs.filter(scl_valid(F.col("scl")))


def tile_selection(scl_obs: DataFrame, roi: DataFrame | None = None) -> DataFrame:
    """(tile_id, obs_date, y20, x20, item_ord): the first valid scene of each cell and date; a cell without one has no row."""
    return valid_observations(inside(scl_obs, roi, "y20", "x20")).groupBy("tile_id", "obs_date", "y20", "x20").agg(F.min("item_ord").alias("item_ord"))


def date_coverage(selection: DataFrame, totals: DataFrame, least: float = LEAST_COVERAGE) -> DataFrame:
    """(tile_id, obs_date, coverage, kept): per cent of a tile's cells (totals: tile_id, total) with a scene; 0 for a tile without cells; kept from `least` on."""
    counts = selection.groupBy("tile_id", "obs_date").agg(F.count("*").alias("selected")).join(totals, "tile_id", "left")
    share = F.when(F.coalesce("total", F.lit(0)) > 0, 100.0 * F.col("selected") / F.col("total")).otherwise(0.0)
    return counts.select("tile_id", "obs_date", "selected", share.alias("coverage")).withColumn("kept", F.col("coverage") >= least)


def on_valid_dates(df: DataFrame, coverage: DataFrame) -> DataFrame:
    return df.join(coverage.filter("kept").select("tile_id", "obs_date"), ["tile_id", "obs_date"], "left_semi")


def no_bands() -> Column:
    return F.array(*(F.lit(0) for _ in BANDS))


def mosaic(obs: DataFrame) -> DataFrame:
    """s2 rows from observations (tile_id, obs_date, item_ord, y, x, scl, bands) in one grouping: the first valid scene's bands, else those of scene 0, else zeros; mask 1 if a scene was valid."""
    valid = scl_valid(F.col("scl"))
    rows = obs.groupBy("tile_id", "obs_date", "y", "x").agg(
        F.min_by("bands", F.when(valid, F.col("item_ord"))).alias("first"), F.max(F.when(F.col("item_ord") == 0, F.col("bands"))).alias("zero"), F.max(valid.cast("int")).alias("mask")
    )
    bands = F.coalesce(F.when(F.col("mask") == 1, F.col("first")), F.col("zero"), no_bands())
    return rows.select("tile_id", "obs_date", day_of_year(F.col("obs_date")).alias("doy"), "y", "x", harmonise_bands(bands, F.col("obs_date")).alias("bands"), F.col("mask").cast("tinyint").alias("mask"))


def with_classes(band_obs: DataFrame, scl_obs: DataFrame, ratio: int = 2) -> DataFrame:
    """Bands with the class of the cell that holds the pixel (ratio 2: 10 m in 20 m). A scene without classes counts as class 0, one without bands reads as zeros, so both keep their place in the order."""
    cells = scl_obs.withColumnsRenamed({"y20": "cy", "x20": "cx"})
    b = band_obs.withColumns({"cy": F.floor(F.col("y") / ratio).cast("int"), "cx": F.floor(F.col("x") / ratio).cast("int")})
    keys = ["tile_id", "obs_date", "item_ord", "cy", "cx"]
    if ratio > 1:
        return b.join(cells, keys, "left").drop("cy", "cx")
    whole = b.join(cells, keys, "full").withColumns({"y": F.coalesce("y", "cy"), "x": F.coalesce("x", "cx"), "bands": F.coalesce("bands", no_bands())})
    return whole.drop("cy", "cx")


def used_scenes(selection: DataFrame, block: int) -> DataFrame:
    """Scenes that are selected somewhere in a block: all that has to be read for it."""
    return selection.select("tile_id", "obs_date", "item_ord", F.floor(F.col("y20") / block).cast("int").alias("block_y"), F.floor(F.col("x20") / block).cast("int").alias("block_x")).distinct()


def water_frequency(scl_obs: DataFrame, share: float = WATER_SHARE) -> DataFrame:
    """(tile_id, y20, x20, water, valid, is_water) over all scenes; water is strictly more than the share of the valid ones."""
    valid = scl_valid(F.col("scl"))
    counts = scl_obs.groupBy("tile_id", "y20", "x20").agg(F.count_if(F.col("scl") == SCL_WATER).alias("water"), F.count_if(valid).alias("valid"))
    return counts.withColumn("is_water", (F.col("valid") > 0) & (F.col("water") / F.greatest("valid", F.lit(1)) > share))


def without_water(pixels: DataFrame, water: DataFrame, ratio: int = 2) -> DataFrame:
    cells = water.filter("is_water").select("tile_id", F.col("y20").alias("_wy"), F.col("x20").alias("_wx"))
    own = pixels.withColumns({"_wy": F.floor(F.col("y") / ratio).cast("int"), "_wx": F.floor(F.col("x") / ratio).cast("int")})
    return own.join(cells, ["tile_id", "_wy", "_wx"], "left_anti").drop("_wy", "_wx")


def upscale(cells: DataFrame, height: int, width: int) -> DataFrame:
    """Each 20 m cell as its 2 x 2 pixels of 10 m, clipped to the tile."""
    two = F.sequence(F.lit(0), F.lit(1))
    rows = cells.withColumn("_dy", F.explode(two)).withColumn("_dx", F.explode(two))
    return rows.withColumns({"y": F.expr("y20 * 2 + _dy"), "x": F.expr("x20 * 2 + _dx")}).filter((F.col("y") < height) & (F.col("x") < width)).drop("_dy", "_dx")
