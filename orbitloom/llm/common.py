"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from orbitloom.sources.storage import stored  # noqa: F401  the operators take it from here

#: Rows, and bytes of text and binary values, after which an output batch is sent.
BATCH_ROWS, BATCH_BYTES = 2048, 4 << 20
#: Most bytes of an Arrow batch on its way to Python; a longer row is a batch of its own.
ARROW_BYTES = 4 << 20
#: Rows that one bucket of `numbered` is meant to hold, and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 100_000, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def marked(columns: list[str]) -> str:
    """A prefix for an operator's own columns that no column of its input begins with."""
    mark = "_"
    while any(c.lower().startswith(mark) for c in columns):
        mark += "_"
    return mark


def by_bytes(spark: SparkSession) -> None:
    """Whole texts are long: unless the session has its own limit, Arrow batches are from now on cut by bytes, not only by rows, so that neither side of a task holds tens of megabytes of texts at once."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def release() -> None:
    """Gives memory that a finished task no longer uses back to the system, as its worker process lives on beside others."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def map_rows(df: DataFrame, make: Callable[[], Callable[[tuple], Iterable[tuple]]], schema: str) -> DataFrame:
    """Row-wise work in Arrow batches. make() runs once a task and returns the function from a row's values to output rows, so models and caches load where they are used."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    by_bytes(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, rows, size = make(), [], 0

        def sent() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)

        for batch in batches:
            columns = batch.columns
            for at in range(0, batch.num_rows, 256):  # few Python values at a time, however large the batch is
                for row in zip(*(c.slice(at, 256).to_pylist() for c in columns), strict=True):
                    for out in f(row):
                        rows.append(out)
                        size += sum(len(x) for x in out if isinstance(x, (str, bytes, list)))
                        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield sent()
                            rows, size = [], 0
        if rows:
            yield sent()
        rows, f = [], None
        release()

    return df.mapInArrow(run, schema)


def numbered(df: DataFrame, key: Column, order: list[str], name: str, rows: int) -> DataFrame:
    """Adds a gapless number from 0 within each key without gathering a key in one task.

    df must be a stored table, as it is read twice. Rows are dealt to hash buckets of the order columns, numbered inside a
    bucket, and shifted by the sum of the buckets before it, so a key that holds a third of all rows is spread evenly too.
    """
    buckets, m = max(LEAST_BUCKETS, rows // BUCKET_ROWS), marked([*df.columns, name])
    df = df.withColumns({f"{m}key": key, f"{m}bucket": F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")})
    counts = df.groupBy(f"{m}key", f"{m}bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy(f"{m}key").orderBy(f"{m}bucket").rowsBetween(W.unboundedPreceding, -1))
    shifts = counts.select(f"{m}key", f"{m}bucket", F.coalesce(before, F.lit(0)).alias(f"{m}shift"))
    within = F.row_number().over(W.partitionBy(f"{m}key", f"{m}bucket").orderBy(*order)) - 1
    found = df.withColumn(f"{m}within", within).join(shifts, [f"{m}key", f"{m}bucket"]).withColumn(name, F.col(f"{m}shift") + F.col(f"{m}within"))
    return found.drop(*(m + c for c in ("key", "bucket", "within", "shift")))


def map_streams(df: DataFrame, run: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Work on a whole partition as a stream: run() gets the rows of a task one by one, in order, and yields output rows; both sides are cut into Arrow batches by rows and bytes."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    by_bytes(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield from zip(*(c.slice(at, 256).to_pylist() for c in batch.columns), strict=True)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)

        for out in run(each(batches)):
            rows.append(out)
            size += sum(len(x) for x in out if isinstance(x, (str, bytes, list)))
            if len(rows) >= 4 * BATCH_ROWS or size >= BATCH_BYTES:
                yield sent()
                rows, size = [], 0
        if rows:
            yield sent()
        rows = []
        release()

    return df.mapInArrow(task, schema)
