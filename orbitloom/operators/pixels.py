"""Pixel series: valid pixels, blocks, resumption, time order, deterministic strata, sample matrices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orbitloom.functions.constants import BANDS, LEAST_VALID, S1_MEAN, S1_STD, S2_MEAN, S2_STD, SAMPLES
from orbitloom.functions.scalars import block_of, normalise, select_strata

PIXEL = ["tile_id", "y", "x"]


def blocks(tiles: DataFrame, size: int) -> DataFrame:
    """(tile_id, block_y, block_x, y0, x0, height, width): blocks row by row, clipped at the tile's edge."""
    rows = tiles.select("tile_id", F.col("height").alias("_h"), F.col("width").alias("_w"))
    for a, n in (("y", "_h"), ("x", "_w")):
        rows = rows.withColumn(f"block_{a}", F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / size).cast("int"))))
    cut = {"y0": F.col("block_y") * size, "x0": F.col("block_x") * size}
    return rows.withColumns(cut).select("tile_id", "block_y", "block_x", "y0", "x0", F.least(F.lit(size), F.col("_h") - F.col("y0")).alias("height"), F.least(F.lit(size), F.col("_w") - F.col("x0")).alias("width"))


def pending_blocks(all_blocks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Blocks without a row in the manifest; a block without valid pixels has a row too once it is done."""
    keys = ["tile_id", "block_y", "block_x"]
    return all_blocks.join(manifest.select(*keys), keys, "left_anti")


def block_keys(df: DataFrame, size: int) -> DataFrame:
    """df with block_y and block_x of its pixels."""
    by, bx = block_of(F.col("y"), F.col("x"), size)
    return df.withColumns({"block_y": by, "block_x": bx})


def time_index(cube: DataFrame) -> DataFrame:
    """(tile_id, obs_date, doy, t): the kept dates of a tile from 0; as many as dates, so one row list a tile."""
    dates = cube.select("tile_id", "obs_date", "doy").distinct()
    return dates.withColumn("t", F.row_number().over(W.partitionBy("tile_id").orderBy("obs_date")) - 1)


def pixel_counts(s2: DataFrame, s1: DataFrame) -> DataFrame:
    """Per pixel: valid optical dates, whether any band was ever not 0, and valid radar times by direction."""
    optical = s2.groupBy(*PIXEL).agg(F.count_if(F.col("mask") == 1).alias("s2_valid"), F.max(F.exists("bands", lambda v: v != 0)).alias("s2_any"))
    seen = (F.col("vv") != 0) | (F.col("vh") != 0)
    radar = s1.groupBy(*PIXEL).agg(*(F.count_if(seen & (F.col("orbit_dir") == d)).alias(n) for d, n in (("ascending", "s1_asc"), ("descending", "s1_desc"))))
    return optical.join(radar, PIXEL, "left").na.fill(0, ["s1_asc", "s1_desc"])


def enough_radar(rows: DataFrame, s1: DataFrame, seen: Column, least: int) -> DataFrame:
    """rows (tile_id, ...) with at least so many valid radar times; the test is left out for the tiles that have no radar at all."""
    tiles = s1.select("tile_id").distinct().withColumn("_radar", F.lit(True))
    return rows.join(tiles, "tile_id", "left").filter(F.col("_radar").isNull() | (seen >= least)).drop("_radar")


def valid_pixels(counts: DataFrame, s1: DataFrame, least_s2: int = LEAST_VALID, least_s1: int = LEAST_VALID) -> DataFrame:
    """Pixels with a value in some band, enough valid optical dates and, in tiles of which s1 has rows, enough valid radar times."""
    kept = counts.filter("s2_any").filter(F.col("s2_valid") >= least_s2)
    return enough_radar(kept, s1, F.col("s1_asc") + F.col("s1_desc"), least_s1)


def valid_rank(s2: DataFrame) -> DataFrame:
    """rank of each valid observation within its pixel by date, from 0, and n, their count."""
    rows = s2.filter("mask = 1")
    pixel = W.partitionBy(*PIXEL)
    return rows.withColumns({"rank": F.row_number().over(pixel.orderBy("obs_date")) - 1, "n": F.count("*").over(pixel)})


def s2_series(s2: DataFrame, times: DataFrame) -> DataFrame:
    """Per pixel its observations as an array ordered by t; bounded by a tile's dates."""
    rows = s2.join(times.select("tile_id", "obs_date", "t"), ["tile_id", "obs_date"])
    return rows.groupBy(*PIXEL).agg(F.array_sort(F.collect_list(F.struct("t", "doy", "mask", "bands"))).alias("s2"))


def s1_series(s1: DataFrame, timeline: DataFrame) -> DataFrame:
    own = timeline.select("tile_id", "orbit_dir", "orbit", "obs_date", "t").filter("obs_date is not null")
    rows = s1.join(own, ["tile_id", "orbit_dir", "orbit", "obs_date"])
    return rows.groupBy(*PIXEL).agg(F.array_sort(F.collect_list(F.struct("t", "doy", "vv", "vh"))).alias("s1"))


def pixel_series(s2: DataFrame, s1: DataFrame) -> DataFrame:
    """Both series of a pixel side by side; s1 is null where radar never saw it."""
    return s2.join(s1, PIXEL, "left")


def days_of(times: DataFrame, name: str) -> DataFrame:
    """(tile_id, name): a tile's days of the year by t."""
    return times.groupBy("tile_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "doy"))), lambda e: e["doy"]).alias(name))


def slot_values(series: str, valid: str, days: str, slots: int, offset: int, value: Callable[[Column], Column], zeros: Column) -> Column:
    """(t, doy, v) for each of the slots: of the observations in `valid`, or of all of the tile's times where it is empty; a time without observation has zeros."""

    def seen(i: Column) -> Column:
        e = F.get(F.col(valid), i.cast("int"))
        return F.struct(e["t"].cast("int").alias("t"), e["doy"].cast("int").alias("doy"), value(e).alias("v"))

    def any_(i: Column) -> Column:
        t = i.cast("int")
        own = F.get(F.filter(series, lambda e: e["t"] == t), F.lit(0))
        return F.struct(t.alias("t"), F.get(F.col(days), t).cast("int").alias("doy"), F.coalesce(value(own), zeros).alias("v"))

    n = F.size(valid)
    return F.when(n > 0, F.transform(select_strata(n, slots, offset), seen)).otherwise(F.transform(select_strata(F.greatest(F.size(days), F.lit(1)), slots, offset), any_))


def sample_matrices(series: DataFrame, days: DataFrame, slots: int = SAMPLES, passes: int = 1) -> DataFrame:
    """(tile_id, y, x, s2_passes, s1_passes) from pixel_series() and a tile's days (tile_id, days2, days1): for each pass the flat matrices of slots x 11 and slots x 3.

    A pixel without any valid observation samples all of its tile's times; times that it has no row for are zeros
    with the time's day of year.
    """
    rows = series.join(days, "tile_id")
    rows = rows.withColumn("s1", F.coalesce("s1", F.array().cast(dict(series.dtypes)["s1"])))
    rows = rows.withColumns({"valid2": F.filter("s2", lambda e: e["mask"] == 1), "valid1": F.filter("s1", lambda e: (e["vv"] != 0) | (e["vh"] != 0))})

    def matrix(name: str, value: Callable[[Column], Column], width: int, mean: tuple, std: tuple, offset: int) -> Column:
        found = slot_values(f"s{name}", f"valid{name}", f"days{name}", slots, offset, value, F.array(*(F.lit(0) for _ in range(width))))
        return F.flatten(F.transform(found, lambda e: normalise(e["v"], mean, std, e["doy"])))

    both = lambda e: F.when(e.isNotNull(), F.array(e["vv"].cast("int"), e["vh"].cast("int")))
    s2 = F.array(*(matrix("2", lambda e: e["bands"], len(BANDS), S2_MEAN, S2_STD, r) for r in range(passes)))
    s1 = F.array(*(matrix("1", both, 2, S1_MEAN, S1_STD, r) for r in range(passes)))
    return rows.select(*PIXEL, s2.alias("s2_passes"), s1.alias("s1_passes"))


def stratified_sample(series: DataFrame, times: DataFrame, choices: list[tuple[int, int]]) -> DataFrame:
    """(tile_id, y, x, slots, offset, slot, obs_date): the dates that fill each pixel's slots, for each choice of (slots, offset), from s2_series()."""
    dates = times.groupBy("tile_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "obs_date"))), lambda e: e["obs_date"]).alias("dates"), F.array_agg("doy").alias("days"))
    rows = series.join(dates, "tile_id").withColumn("valid", F.filter("s2", lambda e: e["mask"] == 1))
    own = [F.struct(F.lit(k).alias("slots"), F.lit(r).alias("offset"), F.transform(slot_values("s2", "valid", "days", k, r, lambda e: e["mask"], F.lit(0)), lambda e: e["t"]).alias("picked")) for k, r in choices]
    rows = rows.select(*PIXEL, "dates", F.inline(F.array(*own)))
    rows = rows.select(*PIXEL, "dates", "slots", "offset", F.posexplode("picked").alias("slot", "t"))
    return rows.select(*PIXEL, "slots", "offset", "slot", F.get("dates", F.col("t")).alias("obs_date"))
