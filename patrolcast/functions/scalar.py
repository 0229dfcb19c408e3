"""Small scalar column helpers (safe ratio arctangent, substring flag, rotation)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def atan_ratio(y, x) -> Column:
    """atan(y / x) with x = 0 giving sign(y) * pi/2 (no divide-by-zero error); 0/0 gives NULL."""
    y, x = _c(y), _c(x)
    half_pi = F.lit(math.pi / 2)
    return (F.when(x == 0, F.when(y > 0, half_pi).when(y < 0, -half_pi))
            .otherwise(F.atan(F.try_divide(y, x))))


def contains_flag(s, needle: str) -> Column:
    """1 if ``needle`` occurs in ``s``; NULL text counts as 0."""
    return F.coalesce(F.instr(_c(s), needle) > 0, F.lit(False)).cast("int")


def rotate(x, y, angle: float) -> tuple[Column, Column]:
    """Rotation of axes by ``angle`` radians: (x cos a + y sin a, y cos a - x sin a)."""
    x, y = _c(x), _c(y)
    c, s = F.lit(math.cos(angle)), F.lit(math.sin(angle))
    return x * c + y * s, y * c - x * s
