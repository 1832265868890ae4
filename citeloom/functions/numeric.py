"""Column expressions over numbers, dates, arrays and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """The number, or null for text that is none, NaN and infinities."""
    d = x.try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def ratio(a: Column, b: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), digits)


def age_years(published: Column, year: Column, observed: Column) -> Column:
    """Years since publication, not below 0; with a year only, from its middle."""
    exact = F.datediff(observed, published) / 365.2425
    return F.greatest(F.coalesce(exact, F.year(observed) - year + 0.5), F.lit(0.0))


def window_sum(counts: Column, observed_year: Column, n: int) -> Column:
    """Sum of (year, n) structs over the n calendar years up to the observed one."""
    inside = F.filter(counts, lambda c: (c["year"] > observed_year - n) & (c["year"] <= observed_year))
    return F.aggregate(inside, F.lit(0).cast("long"), lambda s, c: s + c["n"])


def decay(age: Column, half_life: float) -> Column:
    return F.pow(F.lit(0.5), age / half_life)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """L2-normalised, with a floor of 1e-12 under the length."""
    n = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(a, lambda x: x.cast("double") / n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-12))


def overlap_or_open(a: Column, b: Column) -> Column:
    """Two sets overlap, or one of them says nothing."""
    return (F.size(a) == 0) | (F.size(b) == 0) | F.arrays_overlap(a, b)
