"""Calendar and cyclic column expressions (weekday, day of year, hour, periods, years)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def encode_cyclic(value, period: float) -> tuple[Column, Column]:
    """(cos 2*pi*v/period, sin 2*pi*v/period): the X and Y of a point on the unit circle."""
    angle = F.lit(2 * math.pi) * _c(value) / F.lit(float(period))
    return F.cos(angle), F.sin(angle)


def weekday(ts="Dates") -> Column:
    """Monday = 0 ... Sunday = 6 (not ``dayofweek``, which is Sunday = 1)."""
    return F.weekday(_c(ts))


def fractional_hour(ts="Dates") -> Column:
    """hour + minute / 60; seconds are ignored."""
    return F.hour(_c(ts)) + F.minute(_c(ts)) / F.lit(60.0)


def period_flags(ts="Dates") -> list[Column]:
    """Night (00-05), day (06-17), evening (18-23) as 0/1 ints."""
    h = F.hour(_c(ts))
    return [(h < 6).cast("int"), ((h >= 6) & (h <= 17)).cast("int"), (h >= 18).cast("int")]


def year_group_flags(ts="Dates") -> list[Column]:
    """<=2005, 2006-2009, 2010-2012, >=2013 as 0/1 ints (open at both ends)."""
    y = F.year(_c(ts))
    return [(y <= 2005).cast("int"), ((y >= 2006) & (y <= 2009)).cast("int"),
            ((y >= 2010) & (y <= 2012)).cast("int"), (y >= 2013).cast("int")]


def date_parts(ts="Dates") -> dict[str, Column]:
    """year, month, day, hour, minute, second of a timestamp."""
    t = _c(ts)
    return {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
            "hour": F.hour(t), "minute": F.minute(t), "second": F.second(t)}
