import datetime
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitloom.functions import scalars
from orbitloom.operators import cloudmask, embed, optical, pixels, radar, resample, scenes
from orbitloom.plans import workloads
from orbitloom.sources import arrays, catalogues

DAY = datetime.date(2020, 5, 1)


def band(v):
    return [v] * 10


def obs(spark, rows):
    return spark.createDataFrame(rows, "tile_id int, obs_date date, item_ord int, y int, x int, scl int, bands array<int>")


def test_first_valid_scene_wins_and_scene_zero_is_the_fallback(spark):
    rows = [
        (1, DAY, 0, 0, 0, 9, band(10)), (1, DAY, 1, 0, 0, 4, band(20)), (1, DAY, 2, 0, 0, 4, band(30)),
        (1, DAY, 0, 0, 1, 3, band(11)), (1, DAY, 1, 0, 1, None, band(21)), (1, DAY, 2, 0, 2, 8, band(31)),
    ]
    for _ in range(3):
        random.shuffle(rows)
        found = {r["x"]: (r["bands"][0], r["mask"]) for r in optical.mosaic(obs(spark, rows)).collect()}
        assert found == {0: (20, 1), 1: (11, 0), 2: (0, 0)}


def test_mosaic_needs_one_exchange_and_no_python(spark):
    plan = optical.mosaic(obs(spark, [(1, DAY, 0, 0, 0, 4, band(1))]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Cartesian" not in plan


def test_scene_without_classes_or_bands_keeps_its_place(spark):
    b = spark.createDataFrame([(1, DAY, 0, 0, 0, band(5))], "tile_id int, obs_date date, item_ord int, y int, x int, bands array<int>")
    s = spark.createDataFrame([(1, DAY, 1, 0, 0, 4)], "tile_id int, obs_date date, item_ord int, y20 int, x20 int, scl int")
    rows = {r["item_ord"]: (r["scl"], r["bands"][0]) for r in optical.with_classes(b, s, 1).collect()}
    assert rows == {0: (None, 5), 1: (4, 0)}
    assert [r["scl"] for r in optical.with_classes(b, s, 2).collect()] == [None]


def test_coverage_threshold_is_inclusive(spark):
    sel = spark.createDataFrame([(1, DAY)], "tile_id int, obs_date date")
    for total, kept in ((10_000, True), (10_001, False)):
        assert optical.date_coverage(sel, spark.createDataFrame([(1, total)], "tile_id int, total int")).first()["kept"] is kept
    assert optical.date_coverage(sel, spark.createDataFrame([(1, 0)], "tile_id int, total int")).first()["coverage"] == 0


def test_water_needs_strictly_more(spark):
    rows = [(1, 0, 0, 6)] * 8 + [(1, 0, 0, 4)] * 2 + [(1, 0, 0, 9)] + [(1, 0, 1, 6)] * 9 + [(1, 0, 1, 4)] * 2 + [(1, 0, 2, 9)]
    found = {r["x20"]: r["is_water"] for r in optical.water_frequency(spark.createDataFrame(rows, "tile_id int, y20 int, x20 int, scl int")).collect()}
    assert found == {0: False, 1: True, 2: False}


def test_search_limits(spark):
    s = spark.createDataFrame([(i, "c", datetime.datetime(2020, 5, 1), DAY, 7, float(c), 0.0, 0.0, 1.0, 1.0) for i, c in enumerate((99, 100, 100.5))], "item_id int, collection string, ts timestamp, obs_date date, tile_id int, cloud_cover double, xmin double, ymin double, xmax double, ymax double")
    assert [r["item_id"] for r in scenes.scene_search(s, "c", (1.0, 1.0, 2.0, 2.0), "2020-05-01", "2020-05-01", 100.0, 7).collect()] == [0]
    assert scenes.scene_search(s, "c", (1.1, 1.0, 2.0, 2.0), "2020-05-01", "2020-05-01").isEmpty()


def test_both_ways_of_the_overlap_join_agree(spark):
    rng = random.Random(3)
    box = lambda: (lambda x, y: (x, y, x + rng.random() * 3, y + rng.random() * 3))(rng.random() * 20 - 10, rng.random() * 20 - 10)
    when = datetime.datetime(2020, 5, 1)
    s = spark.createDataFrame([(i, when, *box()) for i in range(60)], "item_id int, ts timestamp, xmin double, ymin double, xmax double, ymax double")
    t = spark.createDataFrame([(i, when, when + datetime.timedelta(1), *box()) for i in range(30)], "tile_id int, start timestamp, end timestamp, xmin double, ymin double, xmax double, ymax double")
    a, b = (sorted(map(tuple, scenes.scene_tile_overlap(s, t, 1.0, n).collect())) for n in (30, 10**9))
    assert a == b and a


def sar(spark, rows):
    return spark.createDataFrame(rows, "tile_id int, orbit string, obs_date date, item_ord int, y int, x int, vv int, vh int")


def test_radar_mosaics(spark):
    rows = sar(spark, [(1, "ascending", DAY, 0, 0, 0, 3, 0), (1, "ascending", DAY, 1, 0, 0, 4, 0), (1, "ascending", DAY, 2, 0, 0, 0, 0), (1, "unknown", DAY, 0, 0, 0, 0, 0)])
    mean = {r["orbit"]: (r["vv"], r["vh"]) for r in radar.mosaic_mean(rows).collect()}
    last = {r["orbit"]: (r["vv"], r["vh"]) for r in radar.mosaic_last(rows).collect()}
    assert mean == {"ascending": (3, 0), "unknown": (0, 0)} and last == {"ascending": (4, 0), "unknown": (0, 0)}
    assert [r["orbit"] for r in radar.drop_empty(radar.mosaic_mean(rows)).collect()] == ["ascending"]


def test_missing_direction_has_a_dummy_time(spark):
    cube = radar.s1_cube(radar.mosaic_mean(sar(spark, [(1, "ascending", DAY, 0, 0, 0, 3, 5)])))
    rows = radar.timeline(cube, spark.createDataFrame([(1,), (2,)], "tile_id int")).orderBy("tile_id", "t").collect()
    assert [(r["tile_id"], r["t"], r["orbit_dir"], r["doy"]) for r in rows] == [(1, 0, "ascending", 122), (1, 1, "descending", 180), (2, 0, "ascending", 180), (2, 1, "descending", 180)]


def test_pixels_without_valid_dates_sample_all_dates_of_the_tile(spark):
    days = [DAY + datetime.timedelta(k) for k in range(3)]
    s2 = spark.createDataFrame([(1, d, 122 + k, 0, 0, band(k + 1), 1) for k, d in enumerate(days)] + [(1, days[1], 123, 0, 1, band(7), 0)], "tile_id int, obs_date date, doy int, y int, x int, bands array<int>, mask int")
    times = pixels.time_index(s2)
    got = pixels.stratified_sample(pixels.s2_series(s2, times), times, [(4, 0)]).orderBy("x", "slot").collect()
    assert [r["obs_date"] for r in got if r["x"] == 1] == [days[0], days[0], days[1], days[2]]
    tiles = spark.createDataFrame([(1,)], "tile_id int")
    s1 = radar.s1_cube(radar.mosaic_mean(sar(spark, [(2, "ascending", DAY, 0, 0, 0, 3, 5)]))).filter("tile_id = 1")
    m = workloads.sampled_pixels(s2, s1, tiles, slots=4).orderBy("x").collect()
    assert len(m) == 2 and all(len(r["s2_passes"][0]) == 44 and len(r["s1_passes"][0]) == 12 for r in m)
    assert [m[1]["s2_passes"][0][11 * k + 10] for k in range(4)] == [122, 122, 123, 124]
    assert m[0]["s1_passes"][0][2::3] == [180] * 4
    assert m[1]["s2_passes"][0][22] == pytest.approx((7 - 1711.0938) / (1926.1026 + 1e-9)) and m[1]["s2_passes"][0][0] == pytest.approx(-1711.0938 / (1926.1026 + 1e-9))


def test_blocks_resume_and_densify(spark):
    tiles = spark.createDataFrame([(1, 5, 4)], "tile_id int, height int, width int")
    every = pixels.blocks(tiles, 3)
    assert sorted((r["block_y"], r["block_x"], r["height"], r["width"]) for r in every.collect()) == [(0, 0, 3, 3), (0, 1, 3, 1), (1, 0, 2, 3), (1, 1, 2, 1)]
    assert pixels.pending_blocks(every, every).isEmpty()
    rows = spark.createDataFrame([(1, 0, 0, [1, 2], 0.5)], "tile_id int, y int, x int, q array<tinyint>, scale float")
    full = embed.densify_grid(rows, 2, tiles)
    assert full.count() == 20 and full.filter("scale = 0").count() == 19


def test_patches(spark):
    images = spark.createDataFrame([(100, 100), (8, 8)], "height int, width int")
    got = sorted((r["top"], r["left"]) for r in cloudmask.patch_grid(images.filter("height = 100"), 64, 20).collect())
    assert got == [(a, b) for a in (0, 36) for b in (0, 36)]
    assert [(r["top"], r["left"]) for r in cloudmask.patch_grid(images.filter("height = 8"), 32, 10).collect()] == [(0, 0)]
    ramp = spark.range(4).select(cloudmask.gradient(F.col("id"), F.lit(2), 4, 2).alias("w")).collect()
    assert [r["w"] for r in ramp] == [0.5, 1.0, 1.0, 0.5]


@pytest.mark.parametrize(("n", "size", "overlap"), [(100, 64, 20), (8, 5, 2), (7, 32, 10), (50, 10, 0), (33, 32, 16), (97, 13, 6)])
def test_each_pixel_is_in_all_windows_that_hold_it(spark, n, size, overlap):
    pixels_ = spark.range(n * 3).selectExpr("cast(id div 3 as int) y", "cast(id % 3 as int) x")
    got = sorted((r["y"], r["x"], r["top"], r["left"]) for r in cloudmask.patch_pixels(pixels_, n, 3, size, overlap).collect())
    tops = sorted({max(0, min(a, n - size)) for a in range(0, n, size - overlap)})
    assert got == sorted((y, x, t, 0) for y in range(n) for x in range(3) for t in tops if t <= y < t + size)


def test_a_patch_of_usual_size(spark):
    """One image of 1,100 x 1,000 pixels in patches of 1,000: plain numbers all the way, and the blend equals numpy's."""
    h, w, size, overlap = 1100, 1000, 1000, 300
    rows = spark.range(h * w).selectExpr("1 tile_id", "date'2020-05-01' obs_date", f"cast(id div {w} as int) y", f"cast(id % {w} as int) x", "cast(id % 97 as double) - 40 n0", "cast(id % 13 as double) n1", "cast(id % 7 as double) n2")
    models = (cloudmask.linear_model(1.0), cloudmask.linear_model(2.0))
    scores = cloudmask.cloud_scores(cloudmask.patch_pixels(rows, h, w, size, overlap), size, lambda: models, 2)
    blended = cloudmask.patch_blend(scores, size, overlap)
    assert blended.count() == h * w * 4
    r = {x["cls"]: x["score"] for x in blended.filter("y = 550 and x = 20").collect()}
    k = 550 * w + 20
    want = models[0](np.array([k % 97 - 40, k % 13, k % 7], float).reshape(1, 3, 1, 1))[0, :, 0, 0] * 1.5
    assert [r[c] for c in range(4)] == pytest.approx(want.tolist())


def test_half_precision_equals_numpy(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-9, 6, 500), [0.0, -0.0, 65504, 65519.99, 65520, -1e9, 2.0**-14, 2.0**-24, 2.0**-25, 3 * 2.0**-25, 2049, 2051, 4097.5, np.inf, -np.inf, np.nan]]).astype(np.float32)
    got = spark.createDataFrame([(v.tolist(),)], "z array<float>").select(scalars.float16_round(F.col("z")).alias("z")).first()["z"]
    with np.errstate(over="ignore"):
        np.testing.assert_array_equal(np.array(got, np.float32), v.astype(np.float16).astype(np.float32))


def test_tiles_without_radar_need_none(spark):
    days = [DAY + datetime.timedelta(k) for k in range(3)]
    s2 = spark.createDataFrame([(tile, d, 122 + k, 0, x, band(k + 1), 1) for k, d in enumerate(days) for tile in (1, 2) for x in (0, 1)], "tile_id int, obs_date date, doy int, y int, x int, bands array<int>, mask int")
    s1 = radar.s1_cube(radar.mosaic_mean(sar(spark, [(2, "ascending", DAY, 0, 0, 0, 3, 5)])))
    kept = pixels.valid_pixels(pixels.pixel_counts(s2, s1), s1, 1, 1)
    assert sorted((r["tile_id"], r["x"]) for r in kept.collect()) == [(1, 0), (1, 1), (2, 0)]
    tiles = spark.createDataFrame([(1,), (2,)], "tile_id int")
    got = workloads.sampled_pixels(s2, s1, tiles, slots=4, least_s1=1)
    assert sorted((r["tile_id"], r["x"]) for r in got.collect()) == [(1, 0), (1, 1), (2, 0)]


def test_stored_vectors_are_resumed(spark, tmp_path):
    rng = random.Random(8)
    days = [DAY + datetime.timedelta(20 * k) for k in range(4)]
    rows = [(t, d, i, y, x, rng.choice((4, 4, 9)), [rng.randint(1, 5000) for _ in range(10)]) for t in (1, 2) for d in days for i in (0, 1) for y in range(4) for x in range(4) if (t, y // 2, x // 2) != (2, 1, 1)]
    radar_rows = [(t, "ascending", d, 0, y, x, rng.random(), rng.random()) for t in (1, 2) for d in days for y in range(4) for x in range(4)]
    seen, amp = obs(spark, rows), spark.createDataFrame(radar_rows, "tile_id int, orbit string, obs_date date, item_ord int, y int, x int, vv double, vh double")
    tiles = spark.createDataFrame([(1, 4, 4), (2, 4, 4)], "tile_id int, height int, width int")
    run = lambda t, at: workloads.embed_tiles(seen, amp, t, f"{tmp_path}/{at}", f"{tmp_path}/{at}-done", 2, lambda: embed.linear_model(8), slots=4)
    read = lambda at: sorted((r["tile_id"], r["y"], r["x"], list(r["q"]), r["scale"]) for r in spark.read.parquet(f"{tmp_path}/{at}").collect())
    assert run(tiles, "whole").count() == 8
    assert run(tiles.filter("tile_id = 1"), "parts").count() == 4
    # a run that broke off: some blocks are named as done, others were written but not named
    spark.createDataFrame([(2, 0, 0)], "tile_id int, block_y int, block_x int").write.mode("append").parquet(f"{tmp_path}/parts-done")
    assert sorted((r["tile_id"], r["block_y"], r["block_x"]) for r in run(tiles, "parts").collect()) == [(2, 0, 1), (2, 1, 0), (2, 1, 1)]
    assert read("parts") == [r for r in read("whole") if not (r[0] == 2 and r[1] < 2 and r[2] < 2)] and len(read("whole")) == 28
    assert run(tiles, "parts").isEmpty() and run(tiles, "whole").isEmpty()


def test_resampling_keeps_a_plane(spark):
    grid, to = (0.0, 0.0, 1.0, 8, 8), (2.0, 2.0, 0.7, 5, 5)
    tiles = resample.grids(spark.createDataFrame([(1,)], "tile_id int"), grid, to)
    p = spark.range(64).selectExpr("1 tile_id", "cast(floor(id / 8) as int) y", "cast(id % 8 as int) x").withColumn("v", F.col("y") * 2.0 + F.col("x"))
    for kind in ("bilinear", "cubic"):
        for r in resample.resample(p, ["tile_id"], "v", tiles, kind).collect():
            assert r["v"] == pytest.approx(2 * (2 + (r["y"] + 0.5) * 0.7 - 0.5) + 2 + (r["x"] + 0.5) * 0.7 - 0.5)
    near = {(r["y"], r["x"]): r["v"] for r in resample.resample(p, ["tile_id"], "v", tiles).collect()}
    assert near[0, 0] == 6.0 and len(near) == 25


def test_array_files_round_trip_in_both_layouts(spark, tmp_path):
    rng = np.random.default_rng(1)
    files = {"bands": rng.integers(0, 65536, (3, 4, 5, 10)).astype("<u2"), "masks": rng.integers(0, 2, (3, 4, 5)).astype("u1"), "doys": np.array([10, 200, 366], "<u2")}
    for d in ("ascending", "descending"):
        files |= {f"sar_{d}": rng.integers(-5, 32767, (2, 4, 5, 2)).astype("<i2"), f"sar_{d}_doy": np.array([5, 9], "<i2")}
    for tile, sub in (("flat", False), ("deep", True)):
        for name, a in files.items():
            at = tmp_path / "in" / tile / (("s1" if "sar" in name else "s2") if sub else "")
            at.mkdir(parents=True, exist_ok=True)
            np.save(at / f"{name}.npy", a)
    s2, s1 = arrays.read_cube_npy(spark, str(tmp_path / "in"))
    assert s2.count() == 2 * 60 and s1.count() == 2 * 80
    out = tmp_path / "out"
    written = arrays.write_cube_npy(s2, s1, f"file://{out}", 4, 5).collect()
    assert len(written) == 14
    for tile in ("flat", "deep"):
        for name, a in files.items():
            b = np.load(out / tile / f"{name}.npy")
            assert b.dtype == a.dtype and (b == a).all()
    assert np.load(io.BytesIO(arrays.npy_header((0, 2), "<u2"))).shape == (0, 2)


def test_catalogue_defaults(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x", "collection": "c", "bbox": [1, 2, 3, 4], "properties": {"datetime": "2020-05-01T10:00:00Z", "cloud_cover": 3.5}, "assets": {"SCL": {"href": "u"}}}\n')
    r = catalogues.read_scene_catalog(spark, str(tmp_path)).first()
    assert (r["item_id"], r["orbit_state"], r["obs_date"], r["ymax"], r["assets"]) == ("x", "unknown", DAY, 4.0, {"SCL": "u"})


def test_earliest_entry_of_the_feed_is_the_last_in_order(spark, tmp_path):
    (tmp_path / "page-1.json").write_text('{"feed": {"entry": [{"time_start": "2020-05-01T01:00:00", "title": "A"}, {"time_start": "", "title": "B"}, {"time_start": "2020-05-01T02:00:00", "title": "C"}, {"title": "", "time_start": "2020-05-01"}]}}')
    rows = scenes.granule_urls(catalogues.read_granule_feed(spark, str(tmp_path)), "https://h/r/").orderBy("item_ord").collect()
    assert [(r["title"], r["item_ord"]) for r in rows] == [("C", 0), ("A", 1)]
    assert rows[1]["vv_url"] == "https://h/r/A/A_VV.tif"


def test_scorer_matches_numpy(spark):
    rng = np.random.default_rng(2)
    s2, s1 = rng.normal(size=(2, 4 * 11)), rng.normal(size=(2, 4 * 3))
    rows = spark.createDataFrame([(1, 0, 0, s2.tolist(), s1.tolist())], "tile_id int, y int, x int, s2_passes array<array<double>>, s1_passes array<array<double>>")
    got = embed.embed_pixels(rows, lambda: embed.linear_model(16), 4).first()["emb"]
    want = np.mean([embed.linear_model(16)(s2[k].reshape(1, 4, 11), s1[k].reshape(1, 4, 3))[0] for k in range(2)], axis=0)
    assert got == pytest.approx(want.tolist())


def onnx_of_means(path):
    """A model file by hand: the means over the slots of both inputs, side by side."""

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    def field(k, value):
        if isinstance(value, int):
            return varint(k << 3) + varint(value)
        value = value.encode() if isinstance(value, str) else value
        return varint(k << 3 | 2) + varint(len(value)) + value

    def tensor(name, *dims):
        shape = b"".join(field(1, field(1, d) if isinstance(d, int) else field(2, d)) for d in dims)
        return field(1, name) + field(2, field(1, field(1, 1) + field(2, shape)))

    def node(kind, inputs, output, *attributes):
        return field(1, b"".join(field(1, i) for i in inputs) + field(2, output) + field(4, kind) + b"".join(field(5, a) for a in attributes))

    ints = lambda name, v: field(1, name) + field(8, v) + field(20, 7)
    one = lambda name, v: field(1, name) + field(3, v) + field(20, 2)
    graph = node("ReduceMean", ["s2"], "a", ints("axes", 1), one("keepdims", 0)) + node("ReduceMean", ["s1"], "b", ints("axes", 1), one("keepdims", 0)) + node("Concat", ["a", "b"], "z", one("axis", 1))
    graph += field(2, "means") + field(11, tensor("s2", "n", "k", 11)) + field(11, tensor("s1", "n", "k", 3)) + field(12, tensor("z", "n", 14))
    path.write_bytes(field(1, 8) + field(7, graph) + field(8, field(1, "") + field(2, 13)))


def test_scorer_loads_a_model_file(spark, tmp_path):
    onnx_of_means(tmp_path / "means.onnx")
    rng = np.random.default_rng(3)
    data = [(1, 0, x, rng.normal(size=(2, 44)), rng.normal(size=(2, 12))) for x in range(5)]
    rows = spark.createDataFrame([(t, y, x, a.tolist(), b.tolist()) for t, y, x, a, b in data], "tile_id int, y int, x int, s2_passes array<array<double>>, s1_passes array<array<double>>")
    got = {r["x"]: r["emb"] for r in embed.embed_pixels(rows, embed.onnx_model(str(tmp_path / "means.onnx")), 4).collect()}
    for _, _, x, a, b in data:
        assert got[x] == pytest.approx(np.concatenate([a.reshape(8, 11).mean(0), b.reshape(8, 3).mean(0)]).tolist(), rel=1e-5, abs=1e-6)


@pytest.mark.parametrize("mode", ["int8", "float16", "float32"])
def test_embeddings_are_written_by_block(spark, tmp_path, mode):
    rows = spark.createDataFrame([(1, y, x, [0.5, -1.0]) for y in range(3) for x in range(3)], "tile_id int, y int, x int, emb array<float>")
    arrays.write_embeddings(rows, str(tmp_path / mode), mode, block=2)
    back = spark.read.parquet(str(tmp_path / mode))
    assert back.count() == 9 and back.select("block_y", "block_x").distinct().count() == 4
    assert back.filter("y = 2 and x = 1 and block_y = 1 and block_x = 0").count() == 1


def test_same_run_compares_equal(spark):
    rows = embed.quantised(spark.createDataFrame([(k, [float(k), 1.0, -2.0]) for k in range(5)], "k int, emb array<double>"))
    r = embed.compare_runs(rows, rows, ["k"]).first()
    assert r["pixels"] == 5 and r["match_pct"] == 100.0 and r["min_cos"] == pytest.approx(1.0)


def test_array_files_in_pieces_and_strips(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "ROWS", 7)
    monkeypatch.setattr(arrays, "STRIP", 3)
    rng = np.random.default_rng(6)
    cube = {"bands": rng.integers(1, 65536, (2, 8, 5, 10)).astype("<u2"), "masks": np.ones((2, 8, 5), "u1"), "doys": np.array([3, 4], "<u2")}
    for d in ("ascending", "descending"):
        cube |= {f"sar_{d}": rng.integers(1, 32767, (1, 8, 5, 2)).astype("<i2"), f"sar_{d}_doy": np.array([9], "<i2")}
    (tmp_path / "in" / "a").mkdir(parents=True)
    for name, a in cube.items():
        np.save(tmp_path / "in" / "a" / f"{name}.npy", a)
    s2, s1 = arrays.read_cube_npy(spark, str(tmp_path / "in"))
    assert s2.count() == 80 and s1.count() == 80
    holes = s2.filter("not (t = 1 and y between 3 and 6)")  # one strip of an image without pixels, half of another
    arrays.write_cube_npy(holes, s1, f"file://{tmp_path}/out", 8, 5).collect()
    for name, a in cube.items():
        want = a.copy()
        if name in ("bands", "masks"):
            want[1, 3:7] = 0
        assert (np.load(tmp_path / "out" / "a" / f"{name}.npy") == want).all()


def test_cloud_models_are_loaded_from_files_and_get_batches(spark, tmp_path):
    """Two tiny model files: one-pixel convolutions from three channels to four classes."""

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    def field(k, value):
        if isinstance(value, int):
            return varint(k << 3) + varint(value)
        value = value.encode() if isinstance(value, str) else value
        return varint(k << 3 | 2) + varint(len(value)) + value

    def tensor(name, *dims):
        shape = b"".join(field(1, field(1, d) if isinstance(d, int) else field(2, d)) for d in dims)
        return field(1, name) + field(2, field(1, field(1, 1) + field(2, shape)))

    weights = [np.random.default_rng(k).normal(size=(4, 3)).astype("<f4") for k in (1, 2)]
    for k, w in enumerate(weights):
        held = b"".join(field(1, d) for d in (4, 3, 1, 1)) + field(2, 1) + field(8, "w") + field(9, w.tobytes())
        graph = field(1, field(1, "input") + field(1, "w") + field(2, "output") + field(4, "Conv")) + field(2, "tiny") + field(5, held)
        graph += field(11, tensor("input", "n", 3, "h", "v")) + field(12, tensor("output", "n", 4, "h", "v"))
        (tmp_path / f"{k}.onnx").write_bytes(field(1, 8) + field(7, graph) + field(8, field(1, "") + field(2, 13)))
    load = cloudmask.onnx_models(str(tmp_path / "0.onnx"), str(tmp_path / "1.onnx"))
    sizes = spark.sparkContext.accumulator(0)
    calls = spark.sparkContext.accumulator(0)

    def counted():
        first, second = load()

        def call(batch):
            sizes.add(len(batch))
            calls.add(1)
            return first(batch)

        return call, second

    rng = np.random.default_rng(5)
    images = rng.normal(size=(3, 11, 9, 3))
    images[2] = 0  # left out
    rows = [(t, datetime.date(2024, 1, 1), y, x, *map(float, images[t, y, x])) for t in range(3) for y in range(11) for x in range(9)]
    df = spark.createDataFrame(rows, "tile_id int, obs_date date, y int, x int, n0 double, n1 double, n2 double")
    patches = cloudmask.patch_pixels(df, 11, 9, 5, 2).repartition(7)
    got = cloudmask.cloud_scores(patches.coalesce(1), 5, counted, 8).collect()
    number = patches.filter("tile_id < 2").select("tile_id", "patch").distinct().count()
    assert sizes.value == number and calls.value < number and len(got) == 4 * patches.filter("tile_id < 2").count()
    for r in got:
        want = sum(float(w[r["cls"]] @ images[r["tile_id"], r["y"], r["x"]].astype("f4")) for w in weights) / 2
        assert r["score"] == pytest.approx(want, abs=1e-5)


def test_boxes_of_all_sizes_meet_without_exploding(spark):
    """One box is the whole world, over a million cells wide; some are points, some lie on edges of cells."""
    rng = random.Random(8)
    stamp = datetime.datetime(2024, 1, 10)

    def box(k):
        if k == 0:
            return -180.0, -90.0, 180.0, 90.0
        w = rng.choice([0.0, 1e-4, 3e-4, 0.01, 2.0, 50.0])
        h = rng.choice([0.0, 1e-4, 0.02, 7.0])
        x, y = (rng.randint(-3, 3) * 3e-4, rng.randint(-3, 3) * 3e-4) if k % 3 else (rng.uniform(-180, 180), rng.uniform(-90, 90))
        return x, y, x + w, y + h

    some = [(k, *box(k)) for k in range(150)]
    others = [(k, *box(k)) for k in range(120)]
    schema = "xmin double, ymin double, xmax double, ymax double"
    s = spark.createDataFrame([(*r, stamp) for r in some] + [(999, None, 0.0, 1.0, 1.0, stamp), (998, 5.0, 5.0, 4.0, 4.0, stamp)], f"item_id int, {schema}, ts timestamp")
    t = spark.createDataFrame([(*r, datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1)) for r in others], f"tile_id int, {schema}, start timestamp, end timestamp")
    found = scenes.scene_tile_overlap(s, t, 3e-4, tile_count=scenes.BROADCAST_TILES + 1)
    want = {(a[0], b[0]) for a in some for b in others if a[1] <= b[3] and a[3] >= b[1] and a[2] <= b[4] and a[4] >= b[2]}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want and len(want) > 300
    cells = scenes.box_cells(s.filter("xmin <= xmax and ymin <= ymax").withColumn("own", scenes.box_level(3e-4)), 3e-4, F.array("own"))
    assert cells.groupBy("item_id").count().agg(F.max("count")).first()[0] <= 4
    assert scenes.scene_tile_overlap(s, t.limit(0), 1.0, tile_count=scenes.BROADCAST_TILES + 1).isEmpty()


def test_a_search_opens_the_months_of_its_range_alone(spark, tmp_path):
    day = datetime.date
    rows = [(k, f"c{k % 2}", day(2023, 1 + k % 12, 1 + k % 28), k % 3, float(k % 100), 0.0, 0.0, 1.0, 1.0) for k in range(240)]
    kind = "item_id int, obs_date date, tile_id int, cloud_cover double, xmin double, ymin double, xmax double, ymax double"
    df = spark.createDataFrame([(r[0], *r[2:], r[1]) for r in rows], f"{kind}, collection string")
    catalogues.write_scene_store(df, str(tmp_path / "store"))
    for file in (tmp_path / "store").rglob("*.parquet"):
        if not any(f"collection=c0/month=2023-{m}" in str(file) for m in ("03", "05")):
            file.write_bytes(b"broken")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    store = catalogues.read_scene_store(spark, str(tmp_path / "store"), kind)
    found = scenes.scene_search(store, "c0", (0.0, 0.0, 2.0, 2.0), "2023-03-05", "2023-05-20", 50.0)
    want = {r[0] for r in rows if r[1] == "c0" and day(2023, 3, 5) <= r[2] <= day(2023, 5, 20) and r[4] < 50}
    assert {r["item_id"] for r in found.collect()} == want and len(want) > 5
