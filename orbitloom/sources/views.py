"""Pixel tables derived by arithmetic from the general test tables, as text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orbitloom.functions.constants import BANDS

_KEYS = """cast(l_suppkey % 4 as int) tile_id,
       cast(date_trunc('month', l_shipdate) + interval 24 year + interval 24 day as date) obs_date,
       cast(l_linenumber - 1 as int) item_ord,
       cast(floor((l_partkey % 64) / 8) as int) {y}, cast(l_partkey % 8 as int) {x}"""

#: By view: its table and its query. 8 x 8 pixels, four tiles, monthly dates, seven scenes a date.
VIEWS = {
    "scl_obs": ("lineitem", f"""select {_KEYS.format(y="y20", x="x20")},
       max(case when (l_partkey % 64) % 11 = 0 and l_orderkey % 10 <> 0 then 6 else cast(floor(l_quantity) as int) % 12 end) scl
from lineitem group by 1, 2, 3, 4, 5"""),
    "band_obs": ("lineitem", f"""select {_KEYS.format(y="y", x="x")},
       {", ".join(f"cast(max(cast(floor(l_extendedprice) as bigint) * {i + 3} % 12000) as int) b{i}" for i in range(len(BANDS)))}
from lineitem group by 1, 2, 3, 4, 5"""),
    "sar_obs": ("lineitem", """select tile_id, orbit, obs_date, item_ord, y, x, max(vv) vv, max(vh) vh from (
  select cast(l_suppkey % 4 as int) tile_id,
         case l_returnflag when 'A' then 'ascending' when 'R' then 'descending' else 'unknown' end orbit,
         cast(date_trunc('month', l_shipdate) + interval 24 year + interval 24 day as date) obs_date,
         cast(l_linenumber - 1 as int) item_ord,
         cast(floor((l_partkey % 64) / 8) as int) y, cast(l_partkey % 8 as int) x,
         l_extendedprice / 250000.0{d} vv, l_discount * l_quantity / 20.0{d} vh
  from lineitem) v group by 1, 2, 3, 4, 5, 6"""),
    "scenes": ("events", """select cast(event_id as bigint) item_id, 'optical' || cast(event_id % 3 as int) collection, ts, cast(ts as date) obs_date, cast(user_id % 4 as int) tile_id,
       cast(value % 100.0{d} as double) cloud_cover,
       case event_type when 'view' then 'ascending' when 'error' then 'descending' when 'click' then 'ascending' end orbit_state,
       cast({k} as double) xmin, cast({k} as double) ymin, cast({k} + 10 as double) xmax, cast({k} + 5 as double) ymax
from events"""),
    "tiles": ("lineitem", """select cast(l_suppkey % 4 as int) tile_id, 8 height, 8 width, cast(l_suppkey % 4 as int) * 100.0{d} as "left", 900.0{d} top, 10.0{d} pixel_w, -10.0{d} pixel_h,
       cast(l_suppkey % 4 as int) * 25.0{d} xmin, cast(l_suppkey % 4 as int) * 20.0{d} ymin, cast(l_suppkey % 4 as int) * 25.0{d} + 20.0{d} xmax, cast(l_suppkey % 4 as int) * 20.0{d} + 15.0{d} ymax
from lineitem group by 1, 4, 8, 9, 10, 11"""),
    "roi": ("lineitem", """select cast(l_suppkey % 4 as int) tile_id, cast(floor((l_partkey % 64) / 8) as int) y, cast(l_partkey % 8 as int) x, max(case when (l_partkey % 64) % 13 = 5 then 0 else 1 end) in_roi
from lineitem group by 1, 2, 3"""),
}
_ENGINES = {"spark": {"d": "D", "k": "cast(get_json_object(props, '$.k') as int)"}, "duckdb": {"d": "::double", "k": "cast(json_extract(props, '$.k') as int)"}}


def view_sql(name: str, engine: str) -> str:
    text = VIEWS[name][1]
    for mark, value in _ENGINES[engine].items():
        text = text.replace("{" + mark + "}", value)
    return text.replace('"left"', "`left`") if engine == "spark" else text


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = VIEWS[name][0]
    text = view_sql(name, "spark").replace(f"from {source}", "from {source}")
    return spark.sql(text, source=spark.read.parquet(f"{sf_dir}/{source}.parquet"))
