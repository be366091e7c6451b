"""A store of pixel observations, partitioned by tile and block, so that work on a few blocks reads those alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.functions.scalars import block_of

#: What the partitions of a store are named by.
BLOCK_KEYS = ("tile_id", "block_y", "block_x")


@dataclass(frozen=True)
class Observations:
    """optical (tile_id, obs_date, item_ord, y, x, scl, bands) and radar (tile_id, orbit, obs_date, item_ord, y, x, vv, vh), both with block_y and block_x for blocks of `block` pixels a side."""

    optical: DataFrame
    radar: DataFrame
    block: int

    @classmethod
    def of(cls, optical: DataFrame, radar: DataFrame, block: int) -> Observations:
        """From tables without blocks: nothing is pruned, as a pixel's block has to be computed."""

        def keyed(df: DataFrame) -> DataFrame:
            by, bx = block_of(F.col("y"), F.col("x"), block)
            return df.withColumns({"block_y": by, "block_x": bx})

        return cls(keyed(optical), keyed(radar), block)


def write_observations(obs: Observations, path: str) -> None:
    """Writes both tables below path, a folder a tile and block; a date's rows of a block lie together, and dates are dealt to tasks, so neither a large tile nor a large block is one task's. What the path held before in these blocks is replaced."""
    for name, df in (("optical", obs.optical), ("radar", obs.radar)):
        rows = df.repartition(*BLOCK_KEYS, "obs_date").sortWithinPartitions(*BLOCK_KEYS, "obs_date", "item_ord", "y", "x")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*BLOCK_KEYS).parquet(f"{path}/{name}")


def read_observations(spark: SparkSession, path: str, block: int, tile_type: str = "int") -> Observations:
    """The store at path. A join with a few blocks that are chosen at run time reads only their folders (dynamic partition pruning)."""
    keys = f"tile_id {tile_type}, block_y int, block_x int"
    optical = spark.read.schema(f"obs_date date, item_ord int, y int, x int, scl int, bands array<int>, {keys}").parquet(f"{path}/optical")
    radar = spark.read.schema(f"orbit string, obs_date date, item_ord int, y int, x int, vv double, vh double, {keys}").parquet(f"{path}/radar")
    return Observations(optical, radar, block)
