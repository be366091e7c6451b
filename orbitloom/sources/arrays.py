"""Array files (.npy) of a tile's cubes and embeddings as tables and back."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files of a tile and their types.
FORMATS = {"bands": "<u2", "masks": "|u1", "doys": "<u2", "sar_ascending": "<i2", "sar_ascending_doy": "<i2", "sar_descending": "<i2", "sar_descending_doy": "<i2", "mask_optimized": "|u1"}
#: Places of an array that are read at once, and rows of an image that are gathered at once for a file.
ROWS, STRIP = 65_536, 256
#: Zero bytes that are written at once.
ZEROS = 1 << 20


def npy_header(shape: tuple[int, ...], dtype: str) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": dtype, "fortran_order": False, "shape": shape})
    return out.getvalue()


def opened(path: str):
    """A file opened for reading at any place, by the address that Spark gives it."""
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return store.open_input_file(at)


def npy_files(spark: SparkSession, folder: str) -> DataFrame:
    """(tile, name, path): the array files below a folder that holds one folder a tile, flat or with s2/ and s1/ inside; only their names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npy").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)/(?:s[12]/)?[^/]+\.npy$", 1).alias("tile"), F.regexp_extract("path", r"([^/]+)\.npy$", 1).alias("name"), "path")


def pieces(files: DataFrame) -> DataFrame:
    """(tile, path, dtype, begin, shape, first, number): ROWS places at most of each array, from what its header says. Pieces are dealt evenly, so no task reads a whole file."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for tile, path in zip(frame["tile"], frame["path"], strict=True):
                with opened(path) as f:
                    read = {1: np.lib.format.read_array_header_1_0, 2: np.lib.format.read_array_header_2_0}[np.lib.format.read_magic(f)[0]]
                    shape, fortran, dtype = read(f)
                    begin = f.tell()
                if fortran:
                    raise ValueError(f"{path}: column-major arrays are not read")
                first = np.arange(0, int(np.prod(shape[:3])), ROWS)
                yield pd.DataFrame({"tile": tile, "path": path, "dtype": dtype.str, "begin": begin, "shape": [list(shape)] * len(first), "first": first, "number": np.minimum(ROWS, int(np.prod(shape[:3])) - first)})

    found = files.select("tile", "path").mapInPandas(run, "tile string, path string, dtype string, begin long, shape array<long>, first long, number long")
    return found.repartition("path", "first")


def values(row: dict) -> np.ndarray:
    """The values of one piece, a row for each place."""
    dtype, channels = np.dtype(row["dtype"]), row["shape"][3] if len(row["shape"]) > 3 else 1
    with opened(row["path"]) as f:
        f.seek(row["begin"] + row["first"] * channels * dtype.itemsize)
        return np.frombuffer(f.read(row["number"] * channels * dtype.itemsize), dtype).reshape(-1, channels).astype(np.int32)


def cube_rows(files: DataFrame, name: str) -> DataFrame:
    """(tile, t, y, x, v) of one array of shape (T, H, W[, C]); v holds the C values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v, (height, width) = values(row), row["shape"][1:3]
                k = row["first"] + np.arange(len(v))
                places = [pa.array(c.astype(np.int32)) for c in (k // (height * width), k // width % height, k % width)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([row["tile"]] * len(v)), *places, lists], names=["tile", "t", "y", "x", "v"])

    return pieces(files.filter(F.col("name") == name)).mapInArrow(run, "tile string, t int, y int, x int, v array<int>")


def series_rows(files: DataFrame, name: str) -> DataFrame:
    """(tile, t, v) of an array of shape (T,)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v = values(row).ravel()
                yield pa.RecordBatch.from_arrays([pa.array([row["tile"]] * len(v)), pa.array((row["first"] + np.arange(len(v))).astype(np.int32)), pa.array(v)], names=["tile", "t", "v"])

    return pieces(files.filter(F.col("name") == name)).mapInArrow(run, "tile string, t int, v int")


def read_cube_npy(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """s2 (tile, t, y, x, doy, bands, mask) and s1 (tile, orbit_dir, t, y, x, doy, vv, vh) of every tile below a folder."""
    files = npy_files(spark, folder)
    keys = ["tile", "t", "y", "x"]
    s2 = cube_rows(files, "bands").withColumnRenamed("v", "bands").join(cube_rows(files, "masks").select(*keys, F.get("v", F.lit(0)).alias("mask")), keys)
    s2 = s2.join(series_rows(files, "doys").withColumnRenamed("v", "doy"), ["tile", "t"])
    parts = []
    for d in ("ascending", "descending"):
        rows = cube_rows(files, f"sar_{d}").join(series_rows(files, f"sar_{d}_doy").withColumnRenamed("v", "doy"), ["tile", "t"])
        parts.append(rows.select("tile", F.lit(d).alias("orbit_dir"), "t", "y", "x", "doy", F.get("v", F.lit(0)).alias("vv"), F.get("v", F.lit(1)).alias("vh")))
    return s2.select(*keys, "doy", "bands", "mask"), parts[0].unionByName(parts[1])


def strips(rows: DataFrame, value: str, height: int, width: int, dtype: str, channels: int = 0) -> DataFrame:
    """(tile, part, bytes): the pixels of a tile and time, STRIP rows of an image at most, as the bytes of one array, absent ones 0; parts count from 0 in the order of the file."""
    each = -(-height // STRIP)

    def run(table: pa.Table) -> pa.Table:
        y, x = (table.column(c).to_numpy() for c in ("y", "x"))
        t, strip = (table.column(c)[0].as_py() for c in ("t", "strip"))
        a = np.zeros((min(STRIP, height - strip * STRIP), width, *([channels] if channels else [])), dtype)
        v = table.column(value).combine_chunks()
        a[y - strip * STRIP, x] = v.flatten().to_numpy().reshape(-1, channels) if channels else v.to_numpy(zero_copy_only=False)
        return pa.table({"tile": [table.column("tile")[0].as_py()], "part": pa.array([t * each + strip], pa.int64()), "bytes": pa.array([a.tobytes()], pa.binary())})

    rows = rows.select("tile", "t", F.floor(F.col("y") / STRIP).cast("int").alias("strip"), "y", "x", value)
    return rows.groupBy("tile", "t", "strip").applyInArrow(run, "tile string, part long, bytes binary")


def array_files(rows: DataFrame, name: str, value: str, height: int, width: int, dtype: str, channels: int = 0) -> DataFrame:
    """(tile, name, part, bytes, zeros): the pieces of a tile's file in order, part -1 its header; a sink writes them one after the other and never holds a whole tile. Strips that no pixel is in are told by their number of zero bytes alone."""
    each, shape = -(-height // STRIP), (height, width, channels) if channels else (height, width)
    counts = rows.groupBy("tile").agg((F.max("t") + 1).alias("n"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"tile": frame["tile"], "part": -1, "bytes": [npy_header((int(n), *shape), dtype) for n in frame["n"]]})

    heads = counts.mapInPandas(run, "tile string, part long, bytes binary")
    own = strips(rows, value, height, width, dtype, channels)
    every = counts.select("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") * each - 1)).alias("part"))
    size = F.when(F.col("part") % each == each - 1, height - (each - 1) * STRIP).otherwise(STRIP) * int(np.prod(shape[1:])) * np.dtype(dtype).itemsize
    zeros = every.join(own.select("tile", "part"), ["tile", "part"], "left_anti").select("tile", "part", F.lit(b"").alias("bytes"), size.cast("long").alias("zeros"))
    return own.unionByName(heads).withColumn("zeros", F.lit(0).cast("long")).unionByName(zeros).select("tile", F.lit(name).alias("name"), "part", "bytes", "zeros")


def write_array_files(parts: DataFrame, folder: str) -> DataFrame:
    """Writes <folder>/<tile>/<name>.npy, one task a file, through the file system of the folder's address, and returns (tile, name, size) of what was written. A file appears whole: it is written beside its place and moved there."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        out, open_, key, size = [], None, None, 0

        def close() -> None:
            if open_ is not None:
                open_.close()
                store.move(f"{root}/{key[0]}/{mark}", f"{root}/{key[0]}/{key[1]}.npy")
                out.append((*key, size))

        mark = ""
        for frame in frames:
            for tile, name, data, zeros in zip(frame["tile"], frame["name"], frame["bytes"], frame["zeros"], strict=True):
                if (tile, name) != key:
                    close()
                    key, size, mark = (tile, name), 0, f".{name}-{uuid.uuid4().hex}"
                    store.create_dir(f"{root}/{tile}", recursive=True)
                    open_ = store.open_output_stream(f"{root}/{tile}/{mark}")
                open_.write(data)
                for at in range(0, zeros, ZEROS):
                    open_.write(bytes(min(ZEROS, zeros - at)))
                size += len(data) + zeros
        close()
        yield pd.DataFrame(out, columns=["tile", "name", "size"])

    ordered = parts.repartition("tile", "name").sortWithinPartitions("tile", "name", "part")
    return ordered.select("tile", "name", "bytes", "zeros").mapInPandas(run, "tile string, name string, size long")


def write_cube_npy(s2: DataFrame, s1: DataFrame, folder: str, height: int, width: int) -> DataFrame:
    """Writes the seven arrays of each tile from s2 (tile, t, y, x, doy, bands, mask) and s1 (tile, orbit_dir, t, y, x, doy, vv, vh), and mask_optimized from mask_opt if s2 has it; returns what was written."""

    def times(rows: DataFrame, name: str) -> DataFrame:
        lists = rows.select("tile", "t", "doy").distinct().groupBy("tile").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "doy"))), lambda e: e["doy"]).alias("doys"))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                data = [npy_header((len(d),), FORMATS[name]) + np.asarray(d).astype(FORMATS[name]).tobytes() for d in frame["doys"]]
                yield pd.DataFrame({"tile": frame["tile"], "name": name, "part": 0, "bytes": data})

        return lists.mapInPandas(run, "tile string, name string, part long, bytes binary").withColumn("zeros", F.lit(0).cast("long"))

    def cube(rows: DataFrame, name: str, value: str, channels: int = 0) -> DataFrame:
        return array_files(rows, name, value, height, width, FORMATS[name], channels)

    parts = [cube(s2, "bands", "bands", 10), cube(s2, "masks", "mask"), times(s2, "doys")]
    if "mask_opt" in s2.columns:
        parts.append(cube(s2, "mask_optimized", "mask_opt"))
    for d in ("ascending", "descending"):
        own = s1.filter(F.col("orbit_dir") == d).withColumn("_v", F.array("vv", "vh"))
        parts += [cube(own, f"sar_{d}", "_v", 2), times(own, f"sar_{d}_doy")]
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    return write_array_files(total, folder)


def write_embeddings(rows: DataFrame, path: str, mode: str = "int8", block: int = 1024, watched: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Writes (tile_id, y, x, emb) by tile and block: int8 as q and scale, float16 as rounded floats, float32 as floats. Blocks that were written before are replaced, others stay. `watched` may observe what is written, rows with block_y and block_x."""
    from orbitloom.functions.scalars import block_of, float16_round
    from orbitloom.operators.embed import quantised

    block_y, block_x = block_of(F.col("y"), F.col("x"), block)
    rows = rows.withColumns({"block_y": block_y, "block_x": block_x})
    if mode == "int8":
        rows = quantised(rows)
    elif mode == "float16":
        rows = rows.withColumn("emb", float16_round(F.col("emb").cast("array<float>")))
    elif mode == "float32":
        rows = rows.withColumn("emb", F.col("emb").cast("array<float>"))
    else:
        raise ValueError(mode)
    watched(rows.repartition("tile_id", "block_y", "block_x")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile_id", "block_y", "block_x").parquet(path)
