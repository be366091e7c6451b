"""Whole workloads from the operators: optical composite, radar composite, pixel embeddings, cloud mask refinement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.functions.constants import BANDS, LEAST_COVERAGE, LEAST_VALID, SAMPLES
from orbitloom.operators import cloudmask, embed, optical, pixels, radar, resample, scenes
from orbitloom.plans.tiles import Choices, embed_observations
from orbitloom.sources.catalogues import read_granule_feed
from orbitloom.sources.observations import Observations
from orbitloom.sources.storage import bucketed, stored


def optical_composite(obs: DataFrame, totals: DataFrame, roi: DataFrame | None = None, least: float = LEAST_COVERAGE) -> DataFrame:
    """s2 cube from observations with class and bands: selection and mosaic are one grouping, stored once; coverage is a small grouping over its masks."""
    s2 = stored(optical.mosaic(optical.inside(obs, roi)), "mosaic")
    selected = s2.filter("mask = 1").select("tile_id", "obs_date")
    return optical.on_valid_dates(s2, optical.date_coverage(selected, totals, least))


def radar_composite(sar_obs: DataFrame, roi: DataFrame | None = None, last: bool = False) -> DataFrame:
    """s1 cube; empty groups are told by a light grouping before the mosaic, which is made once."""
    db = radar.decibels(sar_obs, roi)
    some = db.join(radar.seen_groups(db), ["tile_id", "obs_date", "orbit"], "left_semi")
    return radar.s1_cube(radar.mosaic_last(some) if last else radar.mosaic_mean(some))


def warped_observations(band_obs: DataFrame, scl_obs: DataFrame, band_grids: DataFrame, class_grids: DataFrame) -> DataFrame:
    """Observations (tile_id, obs_date, item_ord, y, x, scl, bands) on each tile's own grid, from scenes on theirs: bands (band_obs with y, x and an array) by cubic kernels, rounded to 16 bits, classes (scl_obs with y20, x20) by the nearest cell.
    The grids are tables of tiles (see resample.GRID) that end on the same target. A scene of which a pixel has only one of both counts as with_classes() says."""
    scene, names = ["tile_id", "obs_date", "item_ord"], [f"_b{i}" for i in range(len(BANDS))]
    flat = band_obs.select(*scene, "y", "x", *(F.get("bands", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)))
    warped = resample.resample(flat, scene, names, band_grids, "cubic")
    whole = (F.greatest(F.least(F.floor(F.col(n) + 0.5), F.lit(65535)), F.lit(0)).cast("int") for n in names)
    classes = resample.resample(scl_obs.withColumnsRenamed({"y20": "y", "x20": "x"}), scene, "scl", class_grids).withColumnsRenamed({"y": "y20", "x": "x20"})
    return optical.with_classes(warped.select(*scene, "y", "x", F.array(*whole).alias("bands")), classes, ratio=1)


def warped_radar(sar_obs: DataFrame, grids: DataFrame, kind: str = "bilinear") -> DataFrame:
    """Amplitudes (tile_id, orbit, obs_date, item_ord, y, x, vv, vh) on each tile's own grid: nearest in the first source, bilinear in the second."""
    return resample.resample(sar_obs, ["tile_id", "orbit", "obs_date", "item_ord"], ["vv", "vh"], grids, kind)


def granule_composite(spark: SparkSession, feed: str, base: str, pixels_: DataFrame, read: Callable[[SparkSession, str], DataFrame] = read_granule_feed) -> DataFrame:
    """s1 cube of the second radar source, from a folder of feed pages in files of their own (or of many, with read_feed_pages): granules get addresses and a place in the reversed order of the feed, their pixels (item_id, tile_id, orbit, y, x, vv, vh) are joined by the name of the file, and of a date and orbit
    the last scene with a value wins. Granules without pixels and pixels without a granule have no row. The joined pixels are stored, as the composite reads them twice."""
    granules = scenes.granule_urls(read(spark, feed), base).select("item_id", "obs_date", "item_ord")
    return radar_composite(stored(pixels_.join(granules, "item_id"), "granules"), last=True)


def valid_series(s2: DataFrame, s1: DataFrame, tiles: DataFrame, water: DataFrame | None = None, water_ratio: int = 2, least_s2: int = LEAST_VALID, least_s1: int = LEAST_VALID) -> tuple[DataFrame, DataFrame]:
    """Series of the valid pixels of both cubes, and the days of their tiles. The cubes are stored in buckets by pixel, so that neither series nor their join moves a row. A tile without any radar needs none."""
    s2, s1 = bucketed(s2 if water is None else optical.without_water(s2, water, water_ratio), "s2", pixels.PIXEL), bucketed(s1, "s1", pixels.PIXEL)
    times, line = stored(pixels.time_index(s2), "times"), stored(radar.timeline(s1, tiles), "line")
    series = pixels.pixel_series(pixels.s2_series(s2, times), pixels.s1_series(s1, line))
    kept = series.filter(F.exists("s2", lambda e: F.exists(e["bands"], lambda v: v != 0))).filter(F.size(F.filter("s2", lambda e: e["mask"] == 1)) >= least_s2)
    if least_s1 > 0:
        seen = F.size(F.filter("s1", lambda e: (e["vv"] != 0) | (e["vh"] != 0)))
        kept = pixels.enough_radar(kept, line.filter("obs_date is not null"), F.coalesce(seen, F.lit(0)), least_s1)
    return kept, stored(pixels.days_of(times, "days2").join(pixels.days_of(line, "days1"), "tile_id"), "days")


def sampled_pixels(s2: DataFrame, s1: DataFrame, tiles: DataFrame, slots: int = SAMPLES, passes: int = 1, **limits) -> DataFrame:
    """Sample matrices of the valid pixels of both cubes; limits: those of valid_series()."""
    return pixels.sample_matrices(*valid_series(s2, s1, tiles, **limits), slots, passes)


def pixel_vectors(s2: DataFrame, s1: DataFrame, tiles: DataFrame, load: Callable[[], embed.Model] = embed.linear_model, slots: int = SAMPLES, passes: int = 1, **limits) -> DataFrame:
    """(tile_id, y, x, emb) of the valid pixels of both cubes; samples are drawn where the model is."""
    return embed.score_series(embed.packed_series(*valid_series(s2, s1, tiles, **limits)), load, slots, passes)


def pixel_embeddings(samples: DataFrame, load: Callable[[], embed.Model] = embed.linear_model, slots: int = SAMPLES) -> DataFrame:
    return embed.quantised(embed.embed_pixels(samples, load, slots))


def refined_mask(s2: DataFrame, height: int, width: int, load: Callable[[], tuple[cloudmask.Model, cloudmask.Model]], size: int | None = None, overlap: int = 300, batch: int = cloudmask.PATCHES) -> DataFrame:
    """s2 with mask_opt from blended patches. The cube is stored, as it is read for its statistics, its patches and its masks."""
    if size is None:
        size, overlap = cloudmask.auto_patch(height, width, overlap)
    s2 = stored(s2, "s2")
    scores = cloudmask.cloud_scores(cloudmask.patch_pixels(cloudmask.normalised(s2), height, width, size, overlap), size, load, batch)
    return cloudmask.mask_optimised(s2, cloudmask.patch_argmax(cloudmask.patch_blend(scores, size, overlap)))


def embed_tiles(obs: DataFrame, sar_obs: DataFrame, tiles: DataFrame, path: str, manifest: str, block: int = 1024, load: Callable[[], embed.Model] = embed.linear_model, roi: DataFrame | None = None, **choices) -> DataFrame:
    """plans.tiles.embed_observations() of observations that aren't in a store."""
    return embed_observations(Observations.of(obs, sar_obs, block), tiles, path, manifest, load, Choices(**choices), roi)


def tile_report(scenes: DataFrame, coverage: DataFrame, water: DataFrame, counts: DataFrame, kept: DataFrame, radar_rows: DataFrame) -> DataFrame:
    """One row a tile: scenes, dates and those kept, per cent of water cells, pixels and valid ones, radar passes by direction."""
    parts = [
        scenes.groupBy("tile_id").agg(F.count("*").alias("scenes")),
        coverage.groupBy("tile_id").agg(F.count("*").alias("dates"), F.count_if("kept").alias("dates_kept")),
        water.groupBy("tile_id").agg((100.0 * F.count_if("is_water") / F.count("*")).alias("water_pct")),
        counts.groupBy("tile_id").agg(F.count("*").alias("pixels")),
        kept.groupBy("tile_id").agg(F.count("*").alias("valid_pixels")),
        radar_rows.select("tile_id", "orbit_dir", "orbit", "obs_date").distinct().groupBy("tile_id").agg(*(F.count_if(F.col("orbit_dir") == d).alias(n) for d, n in (("ascending", "asc_passes"), ("descending", "desc_passes")))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "tile_id", "left")
    return out.na.fill(0)
