"""Scalar rules for numbers, places and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeseek.functions import text as tx

# Bounding boxes (south, north, west, east), tried in this order.
CONTINENTS = (
    ("Africa", -34, 37, -18, 51),
    ("North America", 7, 83, -168, -52),
    ("South America", -55, 12, -82, -34),
    ("Europe", 34, 72, -10, 40),
    ("Asia", -10, 55, 26, 180),
    ("Oceania", -50, -10, 110, 180),
    ("Antarctica", -90, -60, None, None),
)

# Upper bounds of the count classes shown on the map.
COUNT_CLASSES = ((20, "red"), (40, "yellow"))
COUNT_CLASS_ABOVE = "green"


def continent(lat: Column, lon: Column) -> Column:
    """Name of the first box that holds the point, bounds included."""
    out = None
    for name, south, north, west, east in CONTINENTS:
        inside = lat.between(south, north)
        if west is not None:
            inside = inside & lon.between(west, east)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out.otherwise("Unknown")


def country(location: Column) -> Column:
    """What follows the last comma; empty without a comma."""
    parts = F.split(location, ",")
    return F.when(F.size(parts) > 1, tx.strip(F.element_at(parts, -1))).otherwise("")


def count_class(count: Column) -> Column:
    out = None
    for bound, name in COUNT_CLASSES:
        out = F.when(count <= bound, name) if out is None else out.when(count <= bound, name)
    return out.otherwise(COUNT_CLASS_ABOVE)


def without_nan(value: Column) -> Column:
    return F.when(F.isnan(value), None).otherwise(value)


def exact_decimal(value: Column) -> Column:
    """Through text, so the decimal shows the digits the double prints."""
    return without_nan(value).cast("string").try_cast("decimal(38,18)")


def coordinate(value: Column, zero_is_missing: bool = False) -> Column:
    out = value.cast("double")
    return F.nullif(out, F.lit(0.0)) if zero_is_missing else out


def half_up(value: Column, digits: int) -> Column:
    """Round the binary value; a built-in rounds the decimal text and may differ on ties."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / scale


def norm(vector: Column) -> Column:
    squares = F.transform(vector, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def unit(vector: Column, eps: float = 1e-12) -> Column:
    """Divide by the Euclidean length, or by ``eps`` for a vector near zero."""
    # Repeating the length, instead of using it in the function, computes it once.
    length = F.array_repeat(F.greatest(norm(vector), F.lit(eps)), F.size(vector))
    return F.zip_with(vector, length, lambda x, n: x.cast("double") / n)


def smoothed_idf(n: Column, df: Column) -> Column:
    """ln(1 + (N - df + 1/2) / (df + 1/2)); always positive."""
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def plain_idf(n: Column, df: Column) -> Column:
    """ln(N - df + 1/2) - ln(df + 1/2); negative for terms in most documents."""
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def term_weight(tf: Column, dl: Column, avgdl: Column, k1: float, b: float) -> Column:
    """Saturated term frequency, damped by document length."""
    scale = F.when(avgdl > 0, dl / avgdl).otherwise(0.0)
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * scale))


def ramp(share: Column) -> Column:
    """Integer 0..255 for a share of 0..1."""
    return F.floor(F.lit(255.0) * share).cast("int")


