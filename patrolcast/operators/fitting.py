"""Fused train-time fit of the repair (district means) and the features
(district vocabulary, PCA moments) in one grouped aggregate.

Pass 2 of the repair only moves each remaining outlier of district d onto
d's mean, so the moments of the repaired coordinates follow from sums taken
over pass-1 output grouped by (district, out-of-bounds):

* in-bounds groups give the district means and their own moments;
* an out-of-bounds group of a district with a mean contributes its row count
  times the point (mean X, mean Y);
* an out-of-bounds group without a mean (NULL district, or no in-bounds row)
  keeps its own coordinates and contributes its own moments.

One pass over the data replaces two (means, then moments of the repaired rows).
The result equals ``OutlierFit.fit`` followed by ``FeatureFit.fit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import MAX_X, MAX_Y, MIN_X, MIN_Y
from .features import MAX_VOCAB, FeatureFit, PcaFit
from .repair import OutlierFit, out_of_bounds

_CX, _CY = (MIN_X + MAX_X) / 2, (MIN_Y + MAX_Y) / 2


def fit_repair_and_features(passed: DataFrame) -> tuple[OutlierFit, FeatureFit]:
    """``passed`` = train rows after pass 1 (``repair_by_address``)."""
    both = F.col("X").isNotNull() & F.col("Y").isNotNull()
    dx, dy = F.col("X") - _CX, F.col("Y") - _CY
    jx, jy = F.when(both, dx), F.when(both, dy)
    rows = (passed.groupBy("PdDistrict", out_of_bounds().alias("_oob")).agg(
        F.count("*").alias("rows"), F.count("X").alias("nx"), F.sum(dx).alias("sxm"), F.count("Y").alias("ny"),
        F.sum(dy).alias("sym"), F.count(jx).alias("n"), F.sum(jx).alias("sx"), F.sum(jy).alias("sy"),
        F.sum(jx * jx).alias("sxx"), F.sum(jy * jy).alias("syy"), F.sum(jx * jy).alias("sxy"))
        .limit(2 * MAX_VOCAB + 4).collect())
    districts = {r["PdDistrict"] for r in rows if r["PdDistrict"] is not None}
    if len(districts) > MAX_VOCAB:
        raise ValueError("district vocabulary too large")
    means = {}
    for r in rows:
        if not r["_oob"] and r["PdDistrict"] is not None and r["nx"] and r["ny"]:
            means[r["PdDistrict"]] = (_CX + r["sxm"] / r["nx"], _CY + r["sym"] / r["ny"])
    tot = dict(n=0.0, sx=0.0, sy=0.0, sxx=0.0, syy=0.0, sxy=0.0)
    for r in rows:
        mean = means.get(r["PdDistrict"]) if r["_oob"] else None
        if mean is not None:
            m, ux, uy = r["rows"], mean[0] - _CX, mean[1] - _CY
            tot["n"] += m
            tot["sx"] += m * ux
            tot["sy"] += m * uy
            tot["sxx"] += m * ux * ux
            tot["syy"] += m * uy * uy
            tot["sxy"] += m * ux * uy
        else:
            for k in tot:
                tot[k] += r[k] or 0.0
    n = tot["n"]
    mx, my = tot["sx"] / n, tot["sy"] / n
    vx = (tot["sxx"] - n * mx * mx) / (n - 1)
    vy = (tot["syy"] - n * my * my) / (n - 1)
    cxy = (tot["sxy"] - n * mx * my) / (n - 1)
    pca = PcaFit(_CX + mx, _CY + my, PcaFit.axes(vx, vy, cxy))
    return OutlierFit(means), FeatureFit(sorted(districts), pca)
