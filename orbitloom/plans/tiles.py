"""From observations to stored vectors of whole tiles, in batches of blocks that are each committed when they are done."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orbitloom.functions.constants import LEAST_COVERAGE, LEAST_VALID, SAMPLES, SCL_WATER, WATER_SHARE
from orbitloom.functions.scalars import day_of_year, orbit_direction, scl_valid
from orbitloom.operators import embed, optical, pixels, radar
from orbitloom.sources.arrays import write_embeddings
from orbitloom.sources.observations import BLOCK_KEYS, Observations
from orbitloom.sources.storage import exists, stored

KEYS = list(BLOCK_KEYS)


@dataclass(frozen=True)
class Choices:
    """What is kept and how it is scored: least per cent of a tile that a date covers, least valid optical and radar times of a pixel, whether water pixels go, slots and passes of the samples, the form of the vectors, radar mosaics by the last scene
    in place of the mean, how many blocks are done and committed together, and how many tiles have their facts stored at a time."""

    least: float = LEAST_COVERAGE
    least_s2: int = LEAST_VALID
    least_s1: int = LEAST_VALID
    water: bool = False
    slots: int = SAMPLES
    passes: int = 1
    mode: str = "int8"
    last: bool = False
    batch: int = 64
    wave: int = 64


def class_cells(obs: DataFrame) -> DataFrame:
    """(tile_id, block_y, block_x, y, x, is_water, picked) in one grouping that reads classes alone: whether most valid scenes of a pixel show water, and (obs_date, item_ord) of its first valid scene on each date. A pixel's list is bounded by its tile's scenes."""
    valid = scl_valid(F.col("scl"))
    rows = obs.groupBy(*KEYS, "y", "x").agg(
        F.count_if(F.col("scl") == SCL_WATER).alias("water"), F.count_if(valid).alias("valid"), F.array_sort(F.collect_list(F.when(valid, F.struct("obs_date", "item_ord")))).alias("seen")
    )
    first = F.filter("seen", lambda e, i: (i == 0) | (F.get(F.col("seen"), i - 1)["obs_date"] != e["obs_date"]))
    return rows.select(*KEYS, "y", "x", ((F.col("valid") > 0) & (F.col("water") / F.greatest("valid", F.lit(1)) > WATER_SHARE)).alias("is_water"), first.alias("picked"))


@dataclass
class Facts:
    """What blocks need to know of their whole tile: kept dates in order, radar times in order, days of both, the scenes that a block uses, and water."""

    times: DataFrame
    line: DataFrame
    days: DataFrame
    scenes: DataFrame
    water: DataFrame | None
    counts: dict[str, int]  # p0, w0, p1, ...: pixels seen, and those of them that are water, by the place of the tile in `ids`
    ids: list


def counted(name: str, conditions: list[Column]) -> tuple[Observation, list[Column]]:
    """An observation of how many rows meet each condition, by place; for the last step before a write, whose tasks count once however often an earlier one is repeated."""
    return Observation(), [F.count_if(c).alias(f"{name}{i}") for i, c in enumerate(conditions)]


def tile_facts(obs: Observations, tiles: DataFrame, pending: DataFrame, roi: DataFrame | None, choices: Choices) -> Facts:
    """From one pass over the classes and one over the amplitudes of the tiles. Coverage counts the pixels of the region, or of the tile without one; a radar time counts if it has a value somewhere in its tile."""
    ids = sorted(r["tile_id"] for r in tiles.select("tile_id").collect())  # of one wave
    own = [F.col("tile_id") == F.lit(t) for t in ids]
    watch, counts = counted("p", own)
    counts += counted("w", [c & F.col("is_water") for c in own])[1]
    cells = stored(class_cells(optical.inside(obs.optical, roi)).observe(watch, *counts), "cells")
    picked = cells.select(*KEYS, F.inline("picked"))
    selected = picked.groupBy("tile_id", "obs_date").agg(F.count("*").alias("selected"))
    totals = tiles.select("tile_id", (F.col("height") * F.col("width")).alias("total")) if roi is None else roi.filter("in_roi > 0").groupBy("tile_id").agg(F.count("*").alias("total"))
    share = F.when(F.coalesce("total", F.lit(0)) > 0, 100.0 * F.col("selected") / F.col("total")).otherwise(0.0)
    kept = selected.join(totals, "tile_id", "left").filter(share >= choices.least)
    times = stored(pixels.time_index(kept.select("tile_id", "obs_date", day_of_year(F.col("obs_date")).alias("doy"))), "times")
    # pixels without a valid scene show scene 0, on all dates
    zero = pending.select(*KEYS).join(times.select("tile_id", "obs_date"), "tile_id").withColumn("item_ord", F.lit(0))
    scenes = picked.join(pending.select(*KEYS), KEYS, "left_semi").select(*KEYS, "obs_date", "item_ord").unionByName(zero).distinct()
    groups = radar.seen_groups(radar.decibels(obs.radar, roi)).select("tile_id", orbit_direction(F.col("orbit")).alias("orbit_dir"), "orbit", "obs_date", day_of_year(F.col("obs_date")).alias("doy"))
    line = stored(radar.timeline(groups, tiles), "line")
    days = stored(pixels.days_of(times, "days2").join(pixels.days_of(line, "days1"), "tile_id"), "days")
    return Facts(times, line, days, stored(scenes, "scenes"), cells.filter("is_water").select("tile_id", "y", "x") if choices.water else None, watch.get, ids)


def block_series(obs: Observations, own: DataFrame, facts: Facts, roi: DataFrame | None, choices: Choices) -> DataFrame:
    """(tile_id, y, x, s2, s1) of the valid pixels of the blocks in own (a few rows). Each sensor's rows are dealt to tasks by pixel once; mosaics, series and their join keep that dealing."""
    few = F.broadcast(own)
    seen = obs.optical.join(few, KEYS, "left_semi").join(facts.scenes, [*KEYS, "obs_date", "item_ord"], "left_semi").drop("block_y", "block_x")
    seen = optical.inside(seen, roi)
    if facts.water is not None:
        seen = seen.join(facts.water, pixels.PIXEL, "left_anti")
    s2 = pixels.s2_series(optical.mosaic(seen.join(facts.times.select("tile_id", "obs_date"), ["tile_id", "obs_date"], "left_semi").repartition(*pixels.PIXEL)), facts.times)
    db = radar.decibels(obs.radar.join(few, KEYS, "left_semi").drop("block_y", "block_x"), roi).repartition(*pixels.PIXEL)
    s1 = pixels.s1_series(radar.s1_cube(radar.mosaic_last(db) if choices.last else radar.mosaic_mean(db)), facts.line)
    kept = pixels.pixel_series(s2, s1).filter(F.exists("s2", lambda e: F.exists(e["bands"], lambda v: v != 0))).filter(F.size(F.filter("s2", lambda e: e["mask"] == 1)) >= choices.least_s2)
    if choices.least_s1 > 0:
        found = F.coalesce(F.size(F.filter("s1", lambda e: (e["vv"] != 0) | (e["vh"] != 0))), F.lit(0))
        kept = pixels.enough_radar(kept, facts.line.filter("obs_date is not null"), found, choices.least_s1)
    return kept


def in_batches(pending: DataFrame, size: int, wave: int = 64) -> DataFrame:
    """pending with columns wave and batch: `wave` tiles together, and in each wave its blocks tile by tile, row by row, `size` together. Places within a tile are numbered by tile; only a row a tile meets in one task."""
    counts = pending.groupBy("tile_id").agg(F.count("*").alias("n")).withColumn("wave", F.floor((F.row_number().over(W.orderBy("tile_id")) - 1) / wave).cast("int"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("wave").orderBy("tile_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rank = F.row_number().over(W.partitionBy("tile_id").orderBy("block_y", "block_x")) - 1
    own = pending.withColumn("rank", rank).join(counts.select("tile_id", "wave", before.alias("before")), "tile_id")
    return own.select(*pending.columns, "wave", F.floor((F.col("before") + F.col("rank")) / size).cast("int").alias("batch"))


def tile_rows(facts: Facts, done: DataFrame) -> DataFrame:
    """One row a tile of a wave: dates with a clear pixel and those kept, pixels seen and per cent of water among them, radar passes by direction, pixels with a vector; from what the passes of the run have counted, the short tables of times, and the manifest."""
    spark = done.sparkSession
    seen = [(t, facts.counts[f"p{i}"], 100.0 * facts.counts[f"w{i}"] / max(1, facts.counts[f"p{i}"])) for i, t in enumerate(facts.ids)]
    out = spark.createDataFrame(seen, f"tile_id {dict(done.dtypes)['tile_id']}, pixels long, water_pct double")
    passes = facts.line.filter("obs_date is not null").groupBy("tile_id").agg(*(F.count_if(F.col("orbit_dir") == d).alias(n) for d, n in (("ascending", "asc_passes"), ("descending", "desc_passes"))))
    for part in (facts.times.groupBy("tile_id").agg(F.count("*").alias("dates_kept")), passes, done.groupBy("tile_id").agg(F.sum("pixels").alias("valid_pixels"))):
        out = out.join(part, "tile_id", "left")
    return out.na.fill(0)


def embed_observations(
    obs: Observations, tiles: DataFrame, path: str, manifest: str, load: Callable[[], embed.Model] = embed.linear_model, choices: Choices | None = None, roi: DataFrame | None = None, committed: Callable[[int], None] | None = None, report: str | None = None
) -> DataFrame:
    """Stores the vectors of the valid pixels of the tiles (tile_id, height, width) at path, by tile and block; returns the blocks that this run did.

    Blocks that the manifest names are left out. The others are done in batches: first a batch's vectors are written, then its blocks are added to the manifest with the number of their vectors, those without any too, then `committed` is called with the
    number of batches before. A run that breaks off keeps all batches before; what it wrote of the broken one is replaced by the next run. Dates are kept and times numbered by the whole tile, for a wave of tiles with pending blocks at a time; bands and
    amplitudes are read for the blocks of the batch. From a store (read_observations) only the folders of those tiles and blocks are read. If `report` is a path, tile_rows() of each wave are added there when it is done.
    Tiles and region are stored first, as every step reads them and they may be made from large tables.
    """
    spark, choices = obs.optical.sparkSession, choices or Choices()
    tiles = stored(tiles.select("tile_id", "height", "width"), "tiles")
    roi = None if roi is None else stored(roi.filter("in_roi > 0").select("tile_id", "y", "x", "in_roi"), "roi")
    kind = f"tile_id {dict(tiles.dtypes)['tile_id']}, block_y int, block_x int, pixels long"
    named = lambda: spark.read.schema(kind).option("recursiveFileLookup", "true").parquet(manifest) if exists(spark, manifest) else spark.createDataFrame([], kind)
    pending = stored(in_batches(pixels.pending_blocks(pixels.blocks(tiles, obs.block), named()), choices.batch, choices.wave), "pending")
    number = 0
    for wave, last in sorted(map(tuple, pending.groupBy("wave").agg(F.max("batch")).collect())):
        here = pending.filter(F.col("wave") == wave)
        own = tiles.join(here.select("tile_id").distinct(), "tile_id", "left_semi")
        limited = Observations(*(df.join(here.select("tile_id").distinct(), "tile_id", "left_semi") for df in (obs.optical, obs.radar)), obs.block)
        facts = tile_facts(limited, own, here, roi, choices)
        for k in range(last + 1):
            batch = here.filter(F.col("batch") == k).select(*KEYS)
            blocks = batch.collect()
            watch, counts = counted("b", [(F.col("tile_id") == F.lit(t)) & (F.col("block_y") == y) & (F.col("block_x") == x) for t, y, x in blocks])
            packed = embed.packed_series(block_series(obs, batch, facts, roi, choices), facts.days)
            write_embeddings(embed.score_series(packed, load, choices.slots, choices.passes), path, choices.mode, obs.block, lambda df, watch=watch, counts=counts: df.observe(watch, *counts))
            found = watch.get
            spark.createDataFrame([(*b, found[f"b{i}"]) for i, b in enumerate(blocks)], kind).coalesce(1).write.mode("append").parquet(manifest)
            if committed:
                committed(number)
            number += 1
        if report:
            tile_rows(facts, named().join(own, "tile_id", "left_semi")).coalesce(1).write.mode("append").parquet(report)
    return pending.select(*KEYS)
