"""Whole tiles: commits by batch, pruned reads, water and region, samples drawn by the scorer, bucketed cubes."""

import datetime
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orbitloom import catalogue
from orbitloom.operators import embed, pixels
from orbitloom.plans import tiles as plan
from orbitloom.plans import workloads
from orbitloom.plans.tiles import Choices, embed_observations, in_batches
from orbitloom.sources.observations import Observations, read_observations, write_observations
from orbitloom.sources.views import view

SF = "/root/testdata/sf0.001"
DAYS = [datetime.date(2023, 1, 25), datetime.date(2023, 2, 25), datetime.date(2023, 7, 25)]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Two tiles of 4 x 4 pixels in blocks of 2; tile 2 has no radar, and class 6 covers one pixel of tile 1 nearly always."""
    rng = random.Random(3)
    seen = [
        (t, d, k, y, x, 6 if (t, y, x) == (1, 0, 0) else rng.choice([4, 5, 9, 6, 0]), [rng.randint(1, 9000) for _ in range(10)]) for t in (1, 2) for d in DAYS for k in (0, 1) for y in range(4) for x in range(4)
    ]
    amp = [(1, o, d, 0, y, x, rng.random() if o == "ascending" or x else 0.0, rng.random()) for o in ("ascending", "descending") for d in DAYS[:2] for y in range(4) for x in range(4)]
    optical = spark.createDataFrame(seen, "tile_id int, obs_date date, item_ord int, y int, x int, scl int, bands array<int>")
    radar = spark.createDataFrame(amp, "tile_id int, orbit string, obs_date date, item_ord int, y int, x int, vv double, vh double")
    path = str(tmp_path_factory.mktemp("store"))
    write_observations(Observations.of(optical, radar, 2), path)
    tiles = spark.createDataFrame([(1, 4, 4), (2, 4, 4)], "tile_id int, height int, width int")
    return read_observations(spark, path, 2), Observations.of(optical, radar, 2), tiles


model = lambda: embed.linear_model(8)  # noqa: E731  sent to tasks by value


def read(spark, path):
    return sorted((r["tile_id"], r["y"], r["x"], list(r["q"]), r["scale"]) for r in spark.read.parquet(path).collect())


def test_a_broken_run_keeps_the_batches_before(spark, store, tmp_path):
    obs, _, tiles = store
    choices = Choices(slots=4, batch=3)
    embed_observations(obs, tiles, f"{tmp_path}/whole", f"{tmp_path}/whole-done", model, choices)

    def breaks(k):
        if k == 1:
            raise RuntimeError("broken")

    def bad_model():  # a run that breaks off while the second batch is scored
        return lambda s2, s1: 1 / 0

    done = lambda: sorted(tuple(r)[:3] for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/part-done").collect())
    with pytest.raises(RuntimeError, match="broken"):
        embed_observations(obs, tiles, f"{tmp_path}/part", f"{tmp_path}/part-done", model, choices, committed=breaks)
    assert done() == [(1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1), (2, 0, 0), (2, 0, 1)]
    kept = read(spark, f"{tmp_path}/part")
    with pytest.raises(Exception, match="division by zero"):
        embed_observations(obs, tiles, f"{tmp_path}/part", f"{tmp_path}/part-done", bad_model, choices)
    assert len(done()) == 6 and read(spark, f"{tmp_path}/part") == kept
    rest = embed_observations(obs, tiles, f"{tmp_path}/part", f"{tmp_path}/part-done", model, choices)
    assert sorted(tuple(r) for r in rest.collect()) == [(2, 1, 0), (2, 1, 1)]
    assert read(spark, f"{tmp_path}/part") == read(spark, f"{tmp_path}/whole")
    assert embed_observations(obs, tiles, f"{tmp_path}/part", f"{tmp_path}/part-done", model, choices).isEmpty()


def test_a_store_gives_what_tables_give(spark, store, tmp_path):
    stored_, plain, tiles = store
    for name, obs in (("a", stored_), ("b", plain)):
        embed_observations(obs, tiles, f"{tmp_path}/{name}", f"{tmp_path}/{name}-done", model, Choices(slots=4))
    assert read(spark, f"{tmp_path}/a") == read(spark, f"{tmp_path}/b") and len(read(spark, f"{tmp_path}/a")) == 32


def test_blocks_of_a_batch_are_all_that_is_read(spark, store, tmp_path):
    """All other blocks' files are broken once the facts of the tiles are known: nothing may open them."""
    obs, plain, tiles = store
    write_observations(plain, f"{tmp_path}/store")
    obs = read_observations(spark, f"{tmp_path}/store", 2)
    pending = plan.stored(in_batches(pixels.blocks(tiles, 2), 1), "pending")
    facts = plan.tile_facts(obs, tiles, pending, None, Choices())
    for file in (tmp_path / "store").rglob("*.parquet"):
        if "tile_id=1/block_y=1/block_x=0" not in str(file):
            file.write_bytes(b"broken" * 100)
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    series = plan.block_series(obs, pending.filter("batch = 2").select("tile_id", "block_y", "block_x"), facts, None, Choices())
    assert sorted((r["tile_id"], r["y"], r["x"]) for r in series.collect()) == [(1, y, x) for y in (2, 3) for x in (0, 1)]
    text = series._jdf.queryExecution().executedPlan().executedPlan().toString()
    assert "dynamicpruning" in text
    # both sensors' rows move once; mosaics, series and their join add nothing
    assert len(re.findall(r"Exchange hashpartitioning\([^\n]*REPARTITION_BY_COL", text)) == 2 and not re.search(r"Exchange hashpartitioning[^\n]*ENSURE_REQUIREMENTS", text)


def test_batches_are_of_the_size_said(spark):
    tiles = spark.createDataFrame([(3, 5, 5), (1, 4, 2), (2, 1, 1)], "tile_id int, height int, width int")
    found = in_batches(pixels.blocks(tiles, 2), 4).orderBy("tile_id", "block_y", "block_x").collect()
    assert [r["batch"] for r in found] == [k // 4 for k in range(len(found))] and len(found) == 2 + 1 + 9
    assert in_batches(pixels.blocks(tiles.limit(0), 2), 4).isEmpty()
    waves = in_batches(pixels.blocks(tiles, 2), 2, 2).orderBy("tile_id", "block_y", "block_x").collect()
    assert [(r["wave"], r["batch"]) for r in waves] == [(0, 0), (0, 0), (0, 1)] + [(1, k // 2) for k in range(9)]


def test_waves_change_nothing_and_the_report_tells_what_was_done(spark, store, tmp_path):
    obs, _, tiles = store
    choices = Choices(slots=4, batch=3, wave=1, water=True)
    embed_observations(obs, tiles, f"{tmp_path}/a", f"{tmp_path}/a-done", model, choices, report=f"{tmp_path}/report")
    embed_observations(obs, tiles, f"{tmp_path}/b", f"{tmp_path}/b-done", model, Choices(slots=4, water=True))
    rows = read(spark, f"{tmp_path}/a")
    assert rows == read(spark, f"{tmp_path}/b")
    got = {r["tile_id"]: r.asDict() for r in spark.read.parquet(f"{tmp_path}/report").collect()}
    valid = {t: sum(r[0] == t for r in rows) for t in (1, 2)}
    assert {t: r["valid_pixels"] for t, r in got.items()} == valid and {t: r["pixels"] for t, r in got.items()} == {1: 16, 2: 16}
    assert {t: round(r["water_pct"] * 16 / 100) for t, r in got.items()} == {t: 16 - n for t, n in valid.items()}
    assert (got[1]["dates_kept"], got[1]["asc_passes"], got[1]["desc_passes"]) == (3, 2, 2) and (got[2]["asc_passes"], got[2]["desc_passes"]) == (0, 0)
    done = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/a-done")
    assert sum(r["pixels"] for r in done.collect()) == len(rows) and done.count() == 8


def test_water_and_least_counts_leave_pixels_out(spark, store, tmp_path):
    obs, _, tiles = store
    classes = {}
    for r in obs.optical.collect():
        classes.setdefault((r["tile_id"], r["y"], r["x"]), []).append(r["scl"])
    valid = {p: [c for c in own if c not in (0, 1, 2, 3, 8, 9)] for p, own in classes.items()}
    water = {p for p, own in valid.items() if own and own.count(6) / len(own) > 0.8}
    assert (1, 0, 0) in water
    embed_observations(obs, tiles, f"{tmp_path}/dry", f"{tmp_path}/done", model, Choices(slots=4, water=True))
    assert {r[:3] for r in read(spark, f"{tmp_path}/dry")} == set(classes) - water
    # with a least number of radar times, the tile without radar needs none and the other one all four
    embed_observations(obs, tiles, f"{tmp_path}/both", f"{tmp_path}/both-done", model, Choices(slots=4, least_s1=5))
    assert {r[0] for r in read(spark, f"{tmp_path}/both")} == {2}


def test_region_coverage_counts_the_region(spark, store, tmp_path):
    obs, _, tiles = store
    roi = spark.createDataFrame([(1, 3, 3, 1), (1, 0, 1, 0), (2, 0, 0, 1), (2, 0, 1, 1)], "tile_id int, y int, x int, in_roi int")
    embed_observations(obs, tiles, f"{tmp_path}/roi", f"{tmp_path}/done", model, Choices(slots=4, least=0.0), roi)
    assert {r[:3] for r in read(spark, f"{tmp_path}/roi")} <= {(1, 3, 3), (2, 0, 0), (2, 0, 1)}
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/done").count() == 8


@pytest.mark.parametrize("slots", [1, 4, 40])
def test_strata_agree_with_the_expressions(spark, slots):
    from orbitloom.functions.scalars import select_strata

    for offset in (0, 1, 5):
        rows = spark.range(1, 170).select("id", select_strata(F.col("id"), slots, offset).alias("p")).collect()
        got = embed.strata(np.array([r["id"] for r in rows]), slots, offset)
        assert got.tolist() == [list(r["p"]) for r in rows]


def test_samples_drawn_by_the_scorer_are_the_sample_matrices(spark):
    s2, s1, tiles = catalogue.s2_cube(spark, SF), catalogue.s1_cube(spark, SF), view(spark, SF, "tiles")
    if s2.isEmpty():
        s2 = workloads.optical_composite(catalogue.observations(spark, SF), catalogue.totals(spark, SF))
    s2, s1 = catalogue.stored(s2, "s2"), catalogue.stored(s1.filter("tile_id <> 1"), "s1")
    series, days = workloads.valid_series(s2, s1, tiles)
    want = {tuple(r[:3]): r["emb"] for r in embed.embed_pixels(pixels.sample_matrices(series, days, 7, 3), model, 7).collect()}
    got = {tuple(r[:3]): r["emb"] for r in embed.score_series(embed.packed_series(series, days), model, 7, 3, batch=5).collect()}
    assert got.keys() == want.keys() and len(got) > 100
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-9)


def test_packed_slices_keep_their_rows():
    doys = pa.array([[1, 2], [3], [4, 5, 6]], pa.list_(pa.int32()))
    values = pa.array([[10, 11, 20, 21], [30, 31], [40, 41, 50, 51, 60, 61]], pa.list_(pa.int32()))
    whole = next(embed.drawn(doys, values, 2, (0.0, 0.0), (1.0, 1.0), 3, 1))
    part = next(embed.drawn(doys.slice(1), values.slice(1), 2, (0.0, 0.0), (1.0, 1.0), 3, 1))
    assert part.tolist() == whole[1:].tolist() and whole[2, :, 2].tolist() == [4.0, 5.0, 6.0]


def test_no_exchange_between_cubes_and_scorer(spark):
    s2 = workloads.optical_composite(catalogue.observations(spark, SF), catalogue.totals(spark, SF))
    found = workloads.pixel_vectors(s2, catalogue.s1_cube(spark, SF), view(spark, SF, "tiles"), model, 4)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "Bucketed: true" in text and "Exchange hashpartitioning" not in text


def seen_rows(df):
    """df with an accumulator that tells how many of its rows were made."""
    total = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            total.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), total


def test_tiles_are_made_once(spark, store, tmp_path):
    obs, _, tiles = store
    once, made = seen_rows(tiles)
    embed_observations(obs, once, f"{tmp_path}/a", f"{tmp_path}/a-done", model, Choices(slots=4, batch=3, wave=1), report=f"{tmp_path}/report")
    assert len(read(spark, f"{tmp_path}/a")) == 32 and made.value == 2


def test_a_region_is_made_once(spark, store, tmp_path):
    obs, _, tiles = store
    roi = spark.createDataFrame([(t, y, x, int(y > 0)) for t in (1, 2) for y in range(4) for x in range(4)], "tile_id int, y int, x int, in_roi int")
    once, made = seen_rows(roi)
    embed_observations(obs, tiles, f"{tmp_path}/a", f"{tmp_path}/a-done", model, Choices(slots=4, batch=4, wave=1), once)
    assert {r[:3] for r in read(spark, f"{tmp_path}/a")} == {(t, y, x) for t in (1, 2) for y in (1, 2, 3) for x in range(4)} and made.value == 32
