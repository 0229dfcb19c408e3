"""Column-expression builders (all JVM-side, codegen-friendly)."""

from .calendar import date_parts, encode_cyclic, fractional_hour, period_flags, weekday, year_group_flags
from .geo import bearing, haversine, nearest_point
from .scalar import atan_ratio, contains_flag, rotate

__all__ = ["date_parts", "encode_cyclic", "fractional_hour", "period_flags", "weekday", "year_group_flags",
           "bearing", "haversine", "nearest_point", "atan_ratio", "contains_flag", "rotate"]
