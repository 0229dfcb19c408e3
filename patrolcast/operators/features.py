"""Feature operators H1-H18. Each is a ``df -> df`` projection; fitted state
(district vocabulary, PCA axes) is learnt on train rows only and reused on
test rows (trap T5).

``main_clean`` applies all of them in one ``select`` so Catalyst sees a single
narrow projection (one whole-stage-codegen span, no shuffle). The fit is one
grouped aggregate (per district: shifted moments of X and Y), whose keys give
the vocabulary and whose sums give the PCA moments.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import MAX_X, MAX_Y, MIN_X, MIN_Y, PATROL_DIVISION, PERIOD_COLUMNS, ROTATION_ANGLES, YEAR_GROUP_COLUMNS
from ..functions.calendar import encode_cyclic, fractional_hour, period_flags, weekday, year_group_flags
from ..functions.geo import bearing, nearest_point
from ..functions.scalar import atan_ratio, contains_flag, rotate

MAX_VOCAB = 1_000_000

DOUBLE_FEATURES = ["X", "Y", "DayOfWeek_X", "DayOfWeek_Y", "DayOfYear_X", "DayOfYear_Y", "Hour_X", "Hour_Y",
                   "Polar_Rho", "Polar_Phi", "X_R30", "Y_R30", "X_R60", "Y_R60", "XY_PCA1", "XY_PCA2",
                   "Nearest_Station", "Nearest_Station_Bearing"]


def _lit_map(d: dict) -> Column:
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


# --- single operators (each usable alone) ---------------------------------

def district_dummies(vocab: list[str], col="PdDistrict") -> dict[str, Column]:
    """H1: one 0/1 int column per district in the fitted vocabulary; NULL -> all 0."""
    return {f"PdDistrict_{v}": F.coalesce(F.col(col) == F.lit(v), F.lit(False)).cast("int") for v in vocab}


def patrol_division(col="PdDistrict") -> Column:
    """H2: district -> division code via a literal map; unknown or NULL -> NULL."""
    return _lit_map(PATROL_DIVISION)[F.col(col)].cast("int")


def intersection(col="Address") -> Column:
    """H3: 1 if the address has a '/'; NULL -> 0 (trap T12)."""
    return contains_flag(col, "/")


def day_of_week(ts="Dates") -> tuple[Column, Column]:
    """H5: cyclic weekday, Monday = 0, period 7."""
    return encode_cyclic(weekday(ts), 7)


def day_of_year(ts="Dates") -> tuple[Column, Column]:
    """H6: cyclic day of year, period 365 (day 366 wraps past a full turn)."""
    return encode_cyclic(F.dayofyear(F.col(ts)), 365)


def hour_of_day(ts="Dates") -> tuple[Column, Column]:
    """H7: cyclic hour + minute/60, period 24."""
    return encode_cyclic(fractional_hour(ts), 24)


def polar(x="X", y="Y") -> tuple[Column, Column]:
    """rho = sqrt(x^2 + y^2), phi = atan(y/x) (single-argument arctangent)."""
    return F.sqrt(F.col(x) * F.col(x) + F.col(y) * F.col(y)), atan_ratio(y, x)


# --- fitted state -----------------------------------------------------------

@dataclass
class PcaFit:
    """Closed-form 2-D PCA: centre on train means, rotate on the principal axes."""
    mean_x: float
    mean_y: float
    components: list = field(default_factory=list)  # [[c1x, c1y], [c2x, c2y]]

    @staticmethod
    def axes(var_x: float, var_y: float, cov: float) -> list:
        theta = 0.5 * math.atan2(2.0 * cov, var_x - var_y)
        comps = [[math.cos(theta), math.sin(theta)], [-math.sin(theta), math.cos(theta)]]
        # sign convention: the largest-magnitude loading of each axis is positive
        out = []
        for a, b in comps:
            s = a if abs(a) >= abs(b) else b
            out.append([a, b] if s >= 0 else [-a, -b])
        return out

    def project(self, x="X", y="Y") -> tuple[Column, Column]:
        cx = F.col(x) - F.lit(self.mean_x)
        cy = F.col(y) - F.lit(self.mean_y)
        (a1, b1), (a2, b2) = self.components
        return cx * F.lit(a1) + cy * F.lit(b1), cx * F.lit(a2) + cy * F.lit(b2)


@dataclass
class FeatureFit:
    """Train-time state of ``main_clean``: district vocabulary and PCA axes."""
    districts: list
    pca: PcaFit

    @classmethod
    def fit(cls, train: DataFrame) -> "FeatureFit":
        """One grouped aggregate: per district, the (shifted) first and second
        moments of X, Y. The district keys are the vocabulary; the moments add
        up to the global PCA moments (shift = centre of the city box, so the
        sums of squares keep their precision)."""
        cx, cy = (MIN_X + MAX_X) / 2, (MIN_Y + MAX_Y) / 2
        ok = F.col("X").isNotNull() & F.col("Y").isNotNull()
        dx = F.when(ok, F.col("X") - cx)
        dy = F.when(ok, F.col("Y") - cy)
        rows = (train.groupBy("PdDistrict").agg(
            F.count(dx).alias("n"), F.sum(dx).alias("sx"), F.sum(dy).alias("sy"), F.sum(dx * dx).alias("sxx"),
            F.sum(dy * dy).alias("syy"), F.sum(dx * dy).alias("sxy")).limit(MAX_VOCAB + 2).collect())
        vocab = [r["PdDistrict"] for r in rows if r["PdDistrict"] is not None]
        if len(vocab) > MAX_VOCAB:
            raise ValueError("district vocabulary too large")
        tot = {k: sum((r[k] or 0.0) for r in rows) for k in ("n", "sx", "sy", "sxx", "syy", "sxy")}
        n = tot["n"]
        mx, my = tot["sx"] / n, tot["sy"] / n
        vx = (tot["sxx"] - n * mx * mx) / (n - 1)
        vy = (tot["syy"] - n * my * my) / (n - 1)
        cxy = (tot["sxy"] - n * mx * my) / (n - 1)
        pca = PcaFit(cx + mx, cy + my, PcaFit.axes(vx, vy, cxy))
        return cls(sorted(vocab), pca)

    def to_dict(self) -> dict:
        return {"districts": self.districts, "pca": {"mean_x": self.pca.mean_x, "mean_y": self.pca.mean_y,
                                                     "components": self.pca.components}}

    @classmethod
    def from_dict(cls, d: dict) -> "FeatureFit":
        return cls(d["districts"], PcaFit(**d["pca"]))


def feature_columns(fit: FeatureFit) -> list[str]:
    """The 37 feature names in pipeline order."""
    return (["X", "Y"] + [f"PdDistrict_{v}" for v in fit.districts] + ["Patrol_Division", "Intersection",
            "DayOfWeek_X", "DayOfWeek_Y", "DayOfYear_X", "DayOfYear_Y", "Hour_X", "Hour_Y"]
            + PERIOD_COLUMNS + YEAR_GROUP_COLUMNS
            + ["Polar_Rho", "Polar_Phi", "X_R30", "Y_R30", "X_R60", "Y_R60", "XY_PCA1", "XY_PCA2",
               "Nearest_Station", "Nearest_Station_Bearing"])


def feature_exprs(fit: FeatureFit) -> dict[str, Column]:
    """H1-H14 as named column expressions (order = pipeline order)."""
    out: dict[str, Column] = {"X": F.col("X"), "Y": F.col("Y")}
    out.update(district_dummies(fit.districts))
    out["Patrol_Division"] = patrol_division()
    out["Intersection"] = intersection()
    out["DayOfWeek_X"], out["DayOfWeek_Y"] = day_of_week()
    out["DayOfYear_X"], out["DayOfYear_Y"] = day_of_year()
    out["Hour_X"], out["Hour_Y"] = hour_of_day()
    for name, c in zip(PERIOD_COLUMNS, period_flags()):
        out[name] = c
    for name, c in zip(YEAR_GROUP_COLUMNS, year_group_flags()):
        out[name] = c
    out["Polar_Rho"], out["Polar_Phi"] = polar()
    for a in ROTATION_ANGLES:
        out[f"X_R{a}"], out[f"Y_R{a}"] = rotate("X", "Y", a)
    out["XY_PCA1"], out["XY_PCA2"] = fit.pca.project()
    near = F.col("_near")
    out["Nearest_Station"] = near["dist"]
    out["Nearest_Station_Bearing"] = bearing("X", "Y", near["lon"], near["lat"])
    return out


def main_clean(df: DataFrame, fit: FeatureFit | None = None) -> tuple[DataFrame, FeatureFit]:
    """All features in one projection; drops PdDistrict, Address, DayOfWeek, Dates.

    Key and label columns (``Id``, ``Category``) are carried through.
    """
    if fit is None:
        fit = FeatureFit.fit(df)
    keep = [c for c in ("Id", "Category") if c in df.columns]
    # the nearest-station struct is projected once and read twice (distance, bearing)
    staged = df.withColumn("_near", nearest_point("X", "Y"))
    exprs = feature_exprs(fit)
    return staged.select(*keep, *[c.alias(n) for n, c in exprs.items()]), fit


def date_parts_matrix(df: DataFrame, vocabs: dict[str, list[str]]) -> DataFrame:
    """Factor codes (1-based, sorted levels) and date parts as a numeric table.

    ``vocabs`` maps each factor column to its fitted sorted levels.
    """
    from ..functions.calendar import date_parts

    cols = [F.col("Id")]
    for c in ("Category", "DayOfWeek", "PdDistrict", "Resolution"):
        idx = {v: i + 1 for i, v in enumerate(vocabs[c])}
        cols.append(_lit_map(idx)[F.col(c)].cast("int").alias(f"{c}_code"))
    cols += [F.col("X"), F.col("Y")]
    cols += [c.alias(n) for n, c in date_parts("Dates").items()]
    return df.select(*cols)
