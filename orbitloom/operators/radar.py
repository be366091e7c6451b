"""Radar composites: decibels, mosaics by orbit, empty groups, directions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitloom.functions.constants import DUMMY_DOY
from orbitloom.functions.scalars import amplitude_to_db, day_of_year, orbit_direction
from orbitloom.operators.optical import inside

KEYS = ["tile_id", "obs_date", "orbit", "y", "x"]


def decibels(sar_obs: DataFrame, roi: DataFrame | None = None) -> DataFrame:
    return inside(sar_obs, roi).withColumns({p: amplitude_to_db(F.col(p)) for p in ("vv", "vh")})


def mosaic_mean(db: DataFrame) -> DataFrame:
    """The mean of the values over 0 of a group's scenes, truncated; 0 without any."""
    return db.groupBy(*KEYS).agg(*(F.coalesce(F.avg(F.when(F.col(p) > 0, F.col(p))).cast("int"), F.lit(0)).alias(p) for p in ("vv", "vh")))


def mosaic_last(db: DataFrame) -> DataFrame:
    """The last scene in a group's order whose value is over 0."""
    return db.groupBy(*KEYS).agg(*(F.coalesce(F.max_by(p, F.when(F.col(p) > 0, F.col("item_ord"))), F.lit(0)).alias(p) for p in ("vv", "vh")))


def drop_empty(rows: DataFrame) -> DataFrame:
    """Rows of the groups (tile, date, orbit) in which either polarisation has a value somewhere."""
    some = rows.groupBy("tile_id", "obs_date", "orbit").agg(F.max(F.greatest("vv", "vh")).alias("most")).filter("most > 0")
    return rows.join(some.select("tile_id", "obs_date", "orbit"), ["tile_id", "obs_date", "orbit"], "left_semi")


def seen_groups(db: DataFrame) -> DataFrame:
    """(tile_id, obs_date, orbit) of the groups with a value somewhere: those that drop_empty() keeps of either mosaic, as a mosaic has a value where one of its scenes has."""
    return db.groupBy("tile_id", "obs_date", "orbit").agg(F.max(F.greatest("vv", "vh")).alias("most")).filter("most > 0").select("tile_id", "obs_date", "orbit")


def s1_cube(mosaics: DataFrame) -> DataFrame:
    """(tile_id, orbit_dir, orbit, obs_date, doy, y, x, vv, vh)."""
    return mosaics.select("tile_id", orbit_direction(F.col("orbit")).alias("orbit_dir"), "orbit", "obs_date", day_of_year(F.col("obs_date")).alias("doy"), "y", "x", F.col("vv").cast("smallint").alias("vv"), F.col("vh").cast("smallint").alias("vh"))


def timeline(cube: DataFrame, tiles: DataFrame) -> DataFrame:
    """(tile_id, t, orbit_dir, orbit, obs_date, doy): a tile's radar times, ascending by date and then descending by date; a direction without any has one dummy time without date."""
    times = cube.select("tile_id", "orbit_dir", "orbit", "obs_date", "doy").distinct()
    both = tiles.select("tile_id", F.explode(F.array(F.lit("ascending"), F.lit("descending"))).alias("orbit_dir"))
    dummy = both.join(times.select("tile_id", "orbit_dir").distinct(), ["tile_id", "orbit_dir"], "left_anti")
    dummy = dummy.select("tile_id", "orbit_dir", F.lit(None).cast("string").alias("orbit"), F.lit(None).cast("date").alias("obs_date"), F.lit(DUMMY_DOY).alias("doy"))
    rows = times.unionByName(dummy)
    lists = rows.groupBy("tile_id").agg(F.array_sort(F.collect_list(F.struct("orbit_dir", "obs_date", "orbit", "doy"))).alias("times"))  # as many as a tile has dates
    return lists.select("tile_id", F.posexplode("times").alias("t", "e")).select("tile_id", "t", "e.*")
