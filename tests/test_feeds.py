"""Feeds whose pages lie in files of many."""

import datetime
from pathlib import Path

import pytest

from orbitloom import catalogue
from orbitloom.plans import workloads
from orbitloom.sources import catalogues

SF = "/root/testdata/sf0.001"
PAGE = "page_no long, feed struct<entry: array<struct<time_start: string, title: string>>>"


@pytest.fixture
def feeds(monkeypatch, tmp_path):
    """The folder that queries write their feeds to."""
    own = catalogue.new_path
    monkeypatch.setattr(catalogue, "new_path", lambda spark, name: f"{tmp_path}/feed" if name == "feed" else own(spark, name))
    return tmp_path / "feed"


def files(folder: Path) -> int:
    return sum(p.name.startswith("part-") and p.is_file() for p in folder.rglob("*"))


def test_granule_composite_writes_no_file_a_page_and_reads_its_tables_once(spark, feeds):
    found = catalogue.QUERIES["granule_composite"](spark, SF)
    assert spark.read.parquet(f"{SF}/events.parquet").count() > 500 and files(feeds) <= 4
    assert found.count() > 0 and not any("lineitem" in f or "/feed" in f for f in found.inputFiles())  # both of the composite's readings are of what was stored


def test_composites_of_both_forms_of_a_feed_are_equal(spark, tmp_path):
    pages = [(n, ([(f"2020-05-0{1 + n % 2}T0{k}:00:00", f"G{n}{k}") for k in range(3)],)) for n in (10, 2, 1)]
    rows = spark.createDataFrame(pages, PAGE)
    catalogues.write_feed_pages(rows.coalesce(1), f"{tmp_path}/many")
    (tmp_path / "each").mkdir()
    for r in rows.selectExpr("page_no", "to_json(struct(feed)) page").collect():
        (tmp_path / "each" / f"page-{r['page_no']}.json").write_text(r["page"])
    pixels = spark.createDataFrame([(f"G{n}{k}_VV", "ascending", 1, 0, 0, 0.1 + 0.05 * n + 0.01 * k, 0.2) for n, _ in pages for k in range(3)], "item_id string, orbit string, tile_id int, y int, x int, vv double, vh double")
    each = workloads.granule_composite(spark, f"{tmp_path}/each", "https://h", pixels).orderBy("obs_date").collect()
    many = workloads.granule_composite(spark, f"{tmp_path}/many", "https://h", pixels, catalogues.read_feed_pages).orderBy("obs_date").collect()
    assert each == many and [r["obs_date"] for r in many] == [datetime.date(2020, 5, 1), datetime.date(2020, 5, 2)]


def test_asset_paths_writes_no_file_a_page(spark, feeds):
    found = catalogue.QUERIES["asset_paths"](spark, SF)
    assert files(feeds) <= 4 < spark.read.parquet(f"{SF}/events.parquet").selectExpr("floor(event_id / 100)").distinct().count()
    entries = spark.read.parquet(f"{SF}/events.parquet").filter("event_id % 17 <> 0 and value >= 20").count()
    assert found.filter("ord is null or path is null or item_id is null").isEmpty() and found.select("ord").distinct().count() == found.count() == entries


def test_feed_of_many_pages_a_file_keeps_its_order(spark, tmp_path):
    """Numbers alone tell the order: pages lie in any order, in files that several tasks read."""
    pages = [(n, ([("2020-05-01T01:00:00", f"A{n}\n\"é"), ("", "B"), (None, "C"), ("2020-05-02", f"D{n}"), ("2020-05-03", ""), ("2020-05-03", None)],)) for n in (100_000, 7, 10, 9)]
    catalogues.write_feed_pages(spark.createDataFrame(pages, PAGE).repartition(1), str(tmp_path / "feed"))
    assert files(tmp_path / "feed") == 1
    least = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        rows = catalogues.read_feed_pages(spark, str(tmp_path / "feed"))
        assert rows.rdd.getNumPartitions() > 1
        got = [tuple(r) for r in rows.orderBy("ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", least)
    assert got == [e for n, _ in sorted(pages) for e in ((n * 1_000_000, f"A{n}\n\"é", datetime.date(2020, 5, 1)), (n * 1_000_000 + 3, f"D{n}", datetime.date(2020, 5, 2)))]


def test_read_granule_feed_writes_no_file_a_page(spark, feeds):
    assert catalogue.QUERIES["read_granule_feed"](spark, SF).count() > 400 and files(feeds) <= 4
