"""Scene catalogues and granule feeds as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.functions.scalars import obs_date
from orbitloom.operators.scenes import FEED, feed_granules, parse_granules

SCENE = "id string, collection string, bbox array<double>, properties struct<datetime: string, cloud_cover: double, tile: string, epsg: int, orbit_state: string>, assets map<string, struct<href: string>>"


def scene_columns(s: Column) -> list[Column]:
    box = [F.get(s["bbox"], F.lit(k)).alias(n) for k, n in enumerate(("xmin", "ymin", "xmax", "ymax"))]
    p = s["properties"]
    return [
        s["id"].alias("item_id"), s["collection"].alias("collection"), F.to_timestamp(p["datetime"]).alias("ts"), obs_date(p["datetime"]).alias("obs_date"), p["tile"].alias("tile_id"), p["epsg"].alias("epsg"), *box,
        p["cloud_cover"].alias("cloud_cover"), F.coalesce(p["orbit_state"], F.lit("unknown")).alias("orbit_state"), F.transform_values(s["assets"], lambda _, a: a["href"]).alias("assets"),
    ]


def parse_scenes(df: DataFrame, column: str) -> DataFrame:
    """One row a scene description in JSON; a missing orbit is "unknown". Text that isn't a scene gives a row of nulls."""
    return df.select(F.from_json(column, SCENE).alias("s")).select(*scene_columns(F.col("s")))


def read_scene_catalog(spark: SparkSession, path: str) -> DataFrame:
    return parse_scenes(spark.read.text(path), "value")


def write_feed_pages(pages: DataFrame, path: str) -> None:
    """Pages (page_no, feed) as files of many pages, one a line with its number, so that there are no more files than tasks."""
    pages.select("page_no", "feed").write.json(path)


def read_feed_pages(spark: SparkSession, path: str) -> DataFrame:
    """The granules of a feed that write_feed_pages() wrote; a page's place is told by its number alone, and a large file is read by several tasks."""
    return feed_granules(spark.read.schema(f"page_no long, {FEED}").json(path))


def read_granule_feed(spark: SparkSession, path: str) -> DataFrame:
    """The granules of a feed whose pages are files of their own, as they were fetched; long feeds belong in files of many pages (write_feed_pages). Pages are numbered by the last number in the name of their file or, where Spark named the file, of its folder (a partition by page)."""
    pages = spark.read.text(path, wholetext=True).select(F.col("value").alias("page"), F.regexp_extract(F.regexp_replace(F.input_file_name(), r"/part-\d+-[^/]*$", ""), r"(\d+)[^/\d]*$", 1).cast("long").alias("page_no"))
    return parse_granules(pages)


def write_scene_store(scenes: DataFrame, path: str) -> None:
    """Scenes (collection, obs_date and others) as a table partitioned by collection and month; partitions that are written again are replaced."""
    rows = scenes.withColumn("month", F.date_format("obs_date", "yyyy-MM"))
    rows.repartition("collection", "month").sortWithinPartitions("collection", "month", "obs_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("collection", "month").parquet(path)


def read_scene_store(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """The store at path, whose other columns are given as DDL; a search (operators.scenes.scene_search) opens the folders of its collection and months alone."""
    return spark.read.schema(f"{columns}, collection string, month string").parquet(path)
