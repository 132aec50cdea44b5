"""Scalar column helpers. Everything here stays inside JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SQUARE_METRES_PER_SQUARE_FOOT = 0.092903


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(c: Column | str, digits: int) -> Column:
    """Round half up at ``digits`` places with plain double arithmetic (same bits on any engine)."""
    scale = float(10**digits)
    return F.floor(_col(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def square_metres(feet: Column | str, factor: float = SQUARE_METRES_PER_SQUARE_FOOT) -> Column:
    return F.round(_col(feet) * F.lit(factor), 2)


def null_where(c: Column | str, condition: Column) -> Column:
    """NULL where ``condition`` holds, the value itself elsewhere (also where the test is NULL)."""
    return F.when(~F.coalesce(condition, F.lit(False)), _col(c))


def unit_number(c: Column | str) -> Column:
    """``"6u"`` -> 6.0; anything that is not a number with an optional unit gives NULL."""
    return F.regexp_replace(F.trim(_col(c)), "[A-Za-z]+$", "").try_cast("double")


def parse_day(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text -> date, NULL when it does not parse."""
    return F.try_to_date(_col(c), "yyyy-MM-dd")


def year_offset(c: Column | str, base: int = 2007) -> Column:
    return F.year(_col(c)) - F.lit(base)


def scale01(c: Column | str, low: Column, high: Column) -> Column:
    """Linear position of a value between ``low`` and ``high``; NULL where they coincide."""
    return F.try_divide(_col(c) - low, high - low)


def epoch_seconds(c: Column | str) -> Column:
    return F.timestamp_seconds(_col(c))


def as_wall_clock(c: Column | str) -> Column:
    """UTC instant -> timestamp without time zone (the type the parquet inputs use)."""
    return _col(c).cast("timestamp_ntz")


def archive_parts(ts: Column | str) -> list[Column]:
    t = _col(ts)
    return [
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"),
        F.hour(t).alias("hour"),
    ]


def bucket_of(key: Column | str, buckets: int = 100, salt: str = "") -> Column:
    """A repeatable bucket in ``[0, buckets)`` from the md5 of a stable key."""
    digest = F.md5(F.concat(F.lit(salt), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two arrays of doubles."""
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def indicator(union: Column | str, tokens: Column | str) -> Column:
    """1.0/0.0 per element of ``union`` for membership in ``tokens``."""
    t = _col(tokens)
    return F.transform(
        _col(union), lambda x: F.when(F.array_contains(t, x), F.lit(1.0)).otherwise(F.lit(0.0))
    )
