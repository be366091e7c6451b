"""Scenes and granules: search, order, groups, addresses, tile overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orbitloom.functions.scalars import grid_name, obs_date

#: Tiles whose boxes are broadcast at most; more are matched by grid cells.
BROADCAST_TILES = 10_000


def boxes_meet(a: str, b: str) -> Column:
    """Boxes xmin, ymin, xmax, ymax of the two aliases share a point."""
    return F.expr(f"{a}.xmin <= {b}.xmax and {a}.xmax >= {b}.xmin and {a}.ymin <= {b}.ymax and {a}.ymax >= {b}.ymin")


def scene_search(scenes: DataFrame, collection: str, box: tuple[float, float, float, float], start: str, end: str, max_cloud: float = 100.0, tile: str | int | None = None, tile_prefix: str = "") -> DataFrame:
    """Scenes of a collection that meet the box between two dates with strictly less cloud than the limit, and of one tile code if it is given."""
    xmin, ymin, xmax, ymax = box
    date = F.col("obs_date") if "obs_date" in scenes.columns else F.to_date("ts")
    found = scenes.filter((F.col("collection") == collection) & date.between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (F.col("cloud_cover") < max_cloud))
    if "month" in scenes.columns:  # a store by month: only the months of the range are opened
        found = found.filter(F.col("month").between(str(start)[:7], str(end)[:7]))
    found = found.filter(F.expr(f"xmin <= {xmax}D and xmax >= {xmin}D and ymin <= {ymax}D and ymax >= {ymin}D"))
    return found if tile is None else found.filter(F.col("tile_id").cast("string") == f"{tile_prefix}{tile}")


def with_ordinal(scenes: DataFrame) -> DataFrame:
    """item_ord: the place of a scene within its tile and date, from 0, by time and id."""
    w = W.partitionBy("tile_id", "obs_date").orderBy("ts", "item_id")
    return scenes.withColumn("item_ord", F.row_number().over(w) - 1)


def box_level(cell: float) -> Column:
    """The level of a box: the least k for which cells of cell * 2^k are at least as wide and high as it, so that it touches four of them at most."""
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(0.0)) / cell
    level = F.greatest(F.ceil(F.log2(F.greatest(extent, F.lit(1.0)))), F.lit(0)).cast("int")
    return F.when(F.pow(F.lit(2.0), level) < extent, level + 1).otherwise(level)  # a logarithm may fall short by its last digit


def box_cells(df: DataFrame, cell: float, levels: Column) -> DataFrame:
    """df with (lev, cx, cy): the cells that the box touches on each of the levels in a list of them."""
    out = df.withColumn("lev", F.explode(levels))
    side = F.lit(cell) * F.pow(F.lit(2.0), F.col("lev"))
    for a in "xy":
        out = out.withColumn(f"c{a}", F.explode(F.sequence(F.floor(F.col(f"{a}min") / side), F.floor(F.col(f"{a}max") / side))))
    return out


def scene_tile_overlap(scenes: DataFrame, tiles: DataFrame, cell: float = 1.0, tile_count: int | None = None) -> DataFrame:
    """(item_id, tile_id) of all scenes that meet a tile's box and time range (start, end): few tiles are broadcast, more are matched by cells.

    Cells come in several sizes, each twice the one below. A box has a level of its own, where it touches four cells at most, however large it is. Two boxes that meet share a cell on the coarser of their levels: so each box is written to
    the cells of its own level, and looks in those of its own and of each coarser level that the other side has boxes on. Pairs of equal level are looked for from one side. Boxes with a null, or whose end lies before their beginning, meet nothing.
    """
    tile_count = tiles.count() if tile_count is None else tile_count
    s, t = scenes.alias("s"), tiles.alias("t")
    on = boxes_meet("s", "t") & F.expr("s.ts >= t.start and s.ts < t.end")
    if tile_count <= BROADCAST_TILES:
        return s.join(F.broadcast(t), on).select("s.item_id", "t.tile_id")
    sized = [df.filter("xmin <= xmax and ymin <= ymax").withColumn("own", box_level(cell)) for df in (scenes, tiles)]
    levels_of = sized[0].select(F.lit(0).alias("side"), "own").unionByName(sized[1].select(F.lit(1).alias("side"), "own")).distinct().collect()  # some tens of levels at most
    used = [sorted(r["own"] for r in levels_of if r["side"] == side) for side in (0, 1)]

    def met(at_home: int, from_level: int) -> DataFrame:
        """Boxes of one side in their own cells with boxes of the other that look there from levels that are finer by from_level at least."""
        home, guest = sized[at_home], sized[1 - at_home]
        levels = F.array(*(F.lit(k) for k in used[at_home])) if used[at_home] else F.array().cast("array<int>")
        home = box_cells(home, cell, F.array("own"))
        guest = box_cells(guest, cell, F.filter(levels, lambda k: k >= F.col("own") + from_level))
        s, t = (home, guest) if at_home == 0 else (guest, home)
        side = f"({float(cell)!r}D * pow(2D, s.lev))"
        first = F.expr(f"s.cx = floor(greatest(s.xmin, t.xmin) / {side}) and s.cy = floor(greatest(s.ymin, t.ymin) / {side})")  # of the cells that both touch, that of their common corner tells the pair
        return s.alias("s").join(t.alias("t"), F.expr("s.lev = t.lev and s.cx = t.cx and s.cy = t.cy") & on & first).select("s.item_id", "t.tile_id")

    return met(0, 0).unionByName(met(1, 1))


def radar_groups(scenes: DataFrame) -> DataFrame:
    """One row a (tile_id, obs_date, orbit) with its scenes as an ordered list; only descriptions are gathered, never pixels."""
    entry = F.struct("item_ord", "item_id", F.col("assets")["vv"].alias("vv"), F.col("assets")["vh"].alias("vh"))
    return scenes.groupBy("tile_id", "obs_date", F.coalesce("orbit_state", F.lit("unknown")).alias("orbit")).agg(F.array_sort(F.collect_list(entry)).alias("scenes"))


def radar_assets_long(groups: DataFrame) -> DataFrame:
    """One row an asset that exists: (obs_date, orbit, item_id, pol, url)."""
    rows = groups.select("tile_id", "obs_date", "orbit", F.inline("scenes"))
    return rows.unpivot(["tile_id", "obs_date", "orbit", "item_id"], ["vv", "vh"], "pol", "url").filter("url is not null")


def first_scene_per_tile(scenes: DataFrame) -> DataFrame:
    return scenes.groupBy("tile_id").agg(F.min_by("item_id", F.struct("ts", "item_id")).alias("item_id"))


def dates_sorted(df: DataFrame) -> DataFrame:
    return df.select("obs_date").distinct().orderBy("obs_date")


def granule_urls(granules: DataFrame, base: str) -> DataFrame:
    """Addresses of both polarisations from the title, the item id, and the ordinal under which the last in the reversed order wins."""
    w = W.partitionBy("obs_date").orderBy(F.desc("ord"))
    url = F.concat(F.lit(base.rstrip("/") + "/"), "title", F.lit("/"), "title")
    vv = F.concat(url, F.lit("_VV.tif"))
    return granules.withColumns({"vv_url": vv, "vh_url": F.concat(url, F.lit("_VH.tif")), "item_id": grid_name(vv), "item_ord": F.row_number().over(w) - 1})


def tile_bounds(tiles: DataFrame) -> DataFrame:
    """Right and bottom edge and resolution from origin, pixel size and shape; a pixel's height is negative."""
    return tiles.withColumns({"right": F.expr("left + width * pixel_w"), "bottom": F.expr("top + height * pixel_h"), "resolution": F.abs("pixel_w")})


def pixel_centres(pixels: DataFrame, tiles: DataFrame) -> DataFrame:
    own = tiles.select("tile_id", "left", "top", "pixel_w", "pixel_h")
    return pixels.join(own, "tile_id").withColumns({"cx": F.expr("left + (x + 0.5D) * pixel_w"), "cy": F.expr("top + (y + 0.5D) * pixel_h")}).drop("left", "top", "pixel_w", "pixel_h")


#: A page of a feed in JSON.
FEED = "feed struct<entry: array<struct<time_start: string, title: string>>>"


def feed_granules(pages: DataFrame) -> DataFrame:
    """Rows of the entries of pages (page_no, feed) in page order: `ord` is the place in the feed; entries without time or title go."""
    entries = pages.select("page_no", F.posexplode(F.col("feed")["entry"]).alias("pos", "e"))
    kept = entries.filter("coalesce(e.time_start, '') <> '' and coalesce(e.title, '') <> ''")
    return kept.select((F.col("page_no").cast("long") * 1_000_000 + F.col("pos")).alias("ord"), F.col("e.title").alias("title"), obs_date(F.col("e.time_start")).alias("obs_date"))


def parse_granules(pages: DataFrame, column: str = "page") -> DataFrame:
    """feed_granules() of pages (page_no and a column of JSON)."""
    return feed_granules(pages.select("page_no", F.from_json(column, FEED)["feed"].alias("feed")))
