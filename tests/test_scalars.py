import datetime
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orbitloom.functions import scalars


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("day", "v", "expected"), [(25, 1001, 1001), (25, 999, 999), (26, 999, 999), (26, 1000, 0), (26, 1001, 1)])
def test_harmonise_is_strictly_after_the_date(spark, day, v, expected):
    assert one(spark, scalars.harmonise(F.lit(v), F.lit(datetime.date(2022, 1, day)))) == expected


def test_missing_class_is_invalid(spark):
    assert one(spark, scalars.scl_valid(F.lit(None).cast("int"))) is False
    assert [one(spark, scalars.scl_valid(F.lit(k))) for k in range(12)] == [k not in (0, 1, 2, 3, 8, 9) for k in range(12)]


@pytest.mark.parametrize(("a", "expected"), [(0.0, 0), (-1.0, 0), (math.nan, 0), (math.inf, 0), (1.0, 10000), (1e9, 32767), (None, 0)])
def test_decibels(spark, a, expected):
    assert one(spark, scalars.amplitude_to_db(F.lit(a).cast("double"))) == expected
    assert one(spark, scalars.amplitude_to_db(F.lit(a).cast("double"), F.lit(False))) == 0


def test_clip(spark):
    raw = [math.nan, math.inf, -math.inf, -5.0, 65535.9, 12.9]
    assert [one(spark, scalars.clip_u16(F.lit(v))) for v in raw] == [0, 65535, 0, 0, 65535, 12]


def strata(n, k, r):
    if n <= k:
        return sorted((list(range(n)) * (k // n + 1))[:k])
    return [min(n * i // k + r % (n * (i + 1) // k - n * i // k), n - 1) for i in range(k)]


@pytest.mark.parametrize("offset", [0, 1, 5])
def test_strata(spark, offset):
    ns = [1, 2, 39, 40, 41, 79, 80, 164, 184, 816]
    rows = spark.createDataFrame([(n,) for n in ns], "n int").select("n", scalars.select_strata(F.col("n"), 40, offset).alias("v")).collect()
    for r in rows:
        assert r["v"] == strata(r["n"], 40, offset)


def test_quantise_rounds_half_to_even_and_keeps_zero(spark):
    z = F.array(*(F.lit(float(v)) for v in (127, 0.5, 1.5, -2.5, -127)))
    assert one(spark, scalars.quantise(z)) == [127, 0, 2, -2, -127]
    assert one(spark, scalars.quantise_scale(F.array(F.lit(0.0), F.lit(0.0)))) == 1e-8


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, width=32), min_size=1, max_size=20))
def test_dequantised_is_within_half_a_step(spark, z):
    row = spark.createDataFrame([(z,)], "z array<double>").select(scalars.quantise(F.col("z")).alias("q"), scalars.quantise_scale(F.col("z")).alias("s")).first()
    assert all(abs(q * row["s"] - v) <= row["s"] / 2 + 1e-9 for q, v in zip(row["q"], z, strict=True))


def test_bytes_names_and_paths(spark):
    assert one(spark, scalars.to_unsigned(F.lit(-1).cast("tinyint"))) == 255
    assert one(spark, scalars.to_signed(F.lit(255))) == -1
    assert one(spark, scalars.band_of_alias(scalars.band_alias(F.lit("B8A")))) == "B8A"
    assert one(spark, scalars.virtual_path(F.lit("s3://b/k.tif"))) == "/vsis3/b/k.tif"
    assert one(spark, scalars.virtual_path(F.lit("https://h/k.tif"))) == "/vsicurl/https://h/k.tif"
    assert one(spark, scalars.grid_name(F.lit("/a/b/grid_1.2.npy"))) == "grid_1.2"
    assert one(spark, scalars.orbit_direction(F.lit("unknown"))) == "descending"


def test_half_precision(spark):
    z = [0.1, 1.0, 65504.0, 1e-8]
    row = spark.createDataFrame([(z,)], "z array<float>").select(scalars.float16_round(F.col("z")).alias("v")).first()
    assert row["v"] == np.array(z, np.float32).astype(np.float16).astype(float).tolist()
