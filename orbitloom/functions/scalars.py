"""Functions of columns: all stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbitloom.functions.constants import BAND_ALIASES, BANDS, HARMONISATION_DATE, HARMONISATION_OFFSET, SCL_INVALID


def scl_valid(scl: Column) -> Column:
    """A missing class counts as 0, which is invalid."""
    return ~F.coalesce(scl, F.lit(0)).isin(*SCL_INVALID)


def amplitude_valid(a: Column) -> Column:
    return F.coalesce(~F.isnan(a) & (a > 0) & (a < float("inf")), F.lit(False))


def amplitude_to_db(a: Column, inside: Column | None = None) -> Column:
    """Scaled decibels, truncated to an integer; 0 where the amplitude is invalid or the pixel outside."""
    db = F.greatest(F.least((20 * F.log10(a) + 50) * 200, F.lit(32767.0)), F.lit(0.0)).cast("int")
    ok = amplitude_valid(a) if inside is None else amplitude_valid(a) & inside
    return F.when(ok, db).otherwise(0)


def clip_u16(v: Column) -> Column:
    return F.greatest(F.least(F.nanvl(v.cast("double"), F.lit(0.0)), F.lit(65535.0)), F.lit(0.0)).cast("int")


def harmonise(v: Column, date: Column) -> Column:
    """A value from a date strictly after the change loses the offset if it has it."""
    return F.when((date > F.lit(HARMONISATION_DATE)) & (v >= HARMONISATION_OFFSET), v - HARMONISATION_OFFSET).otherwise(v)


def harmonise_bands(bands: Column, date: Column) -> Column:
    return F.transform(bands, lambda v: clip_u16(harmonise(v, date)))


def obs_date(ts: Column) -> Column:
    """The date of an ISO timestamp in text: its first ten characters."""
    return F.to_date(F.substring(ts.cast("string"), 1, 10))


def day_of_year(date: Column) -> Column:
    return F.dayofyear(date)


def doubles(values: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(x)) for x in values))


def normalise(values: Column, mean: Sequence[float], std: Sequence[float], doy: Column | None = None) -> Column:
    """(v - mean) / (std + 1e-9) per band; the day of year, if given, follows as it is."""
    out = F.zip_with(values, F.arrays_zip(doubles(mean).alias("m"), doubles(std).alias("s")), lambda v, p: (v - p["m"]) / (p["s"] + 1e-9))
    return out if doy is None else F.concat(out, F.array(doy.cast("double")))


def block_of(y: Column, x: Column, size: int) -> tuple[Column, Column]:
    return F.floor(y / size).cast("int"), F.floor(x / size).cast("int")


def cell_of(v: Column) -> Column:
    """The 20 m row or column of a 10 m one."""
    return F.floor(v / 2).cast("int")


def global_index(y: Column, x: Column, width: Column) -> Column:
    return y.cast("long") * width + x


def orbit_direction(orbit: Column) -> Column:
    """Everything that isn't ascending, unknown included, goes with descending."""
    return F.when(orbit == "ascending", "ascending").otherwise("descending")


def band_alias(band: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in zip(BANDS, BAND_ALIASES, strict=True) for x in pair)), band)


def band_of_alias(alias: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in zip(BAND_ALIASES, BANDS, strict=True) for x in pair)), alias)


def virtual_path(url: Column) -> Column:
    """Object-store and web addresses as virtual file paths."""
    return F.when(url.startswith("s3://") & (F.length(url) > 5), F.concat(F.lit("/vsis3/"), F.substr(url, F.lit(6)))).otherwise(F.concat(F.lit("/vsicurl/"), url))


def grid_name(path: Column) -> Column:
    """The last part of a path without its extension."""
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"(.)\.[^.]*$", "$1")


def quantise_scale(z: Column) -> Column:
    return F.greatest(F.array_max(F.transform(z, lambda v: F.abs(v.cast("double")))) / 127, F.lit(1e-8))


def quantise(z: Column) -> Column:
    """Signed bytes of a vector, rounded half to even."""
    scale = quantise_scale(z)
    return F.transform(z, lambda v: F.greatest(F.least(F.rint(v.cast("double") / scale), F.lit(127.0)), F.lit(-128.0)).cast("tinyint"))


def dequantise(q: Column, scale: Column) -> Column:
    return F.transform(q, lambda v: v.cast("double") * scale)


def to_unsigned(q: Column) -> Column:
    return q.cast("int").bitwiseAND(255)


def to_signed(v: Column) -> Column:
    return F.when(v > 127, v - 256).otherwise(v)


def float16_round(z: Column) -> Column:
    """Vectors rounded to half precision, half to even: 11 significant bits, steps of 2^-24 under 2^-14, infinite from 65520 on."""

    def rounded(v: Column) -> Column:
        a = F.abs(v.cast("double"))
        step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(a)), F.lit(-14)) - 10)
        return F.when(F.isnan(v) | (a == float("inf")) | (a == 0), v.cast("double")).when(a >= 65520, F.signum(v) * float("inf")).otherwise(F.rint(v / step) * step).cast("float")

    return F.transform(z, lambda v: rounded(v.cast("float")))


def select_strata(n: Column, slots: int, offset: int = 0) -> Column:
    """Positions 0..n-1 that fill exactly `slots` slots in order.

    Fewer than the slots are repeated, the first ones once more; otherwise bin i is [n*i div slots, n*(i+1) div slots) and
    the offset, modulo the bin's size, picks a position. n must be positive.
    """
    n, k = n.cast("long"), F.lit(slots).cast("long")

    def whole(a: Column, b: Column) -> Column:
        return F.floor(a / b)

    def pick(i: Column) -> Column:
        each, more = whole(k, n), k % n
        few = F.when(i < (each + 1) * more, whole(i, each + 1)).otherwise(more + whole(i - (each + 1) * more, F.greatest(each, F.lit(1))))
        low, high = whole(n * i, k), whole(n * (i + 1), k)
        return F.when(n <= k, few).otherwise(F.least(low + F.lit(offset) % F.greatest(high - low, F.lit(1)), n - 1))

    return F.transform(F.sequence(F.lit(0).cast("long"), k - 1), pick)
