"""DuckDB twins of the Spark plans, used only by ``oracle_sql()``.

Each builder returns CTE text; ``with_ctes`` puts the fixture first. Double
outputs are rounded to 6 decimals on both sides (``finish`` / ``rounded``).
"""

from __future__ import annotations

import math

from ..fixed import (DISTRICTS, MAX_X, MAX_Y, MIN_X, MIN_Y, PATROL_DIVISION, PERIOD_COLUMNS, ROTATION_ANGLES,
                     STATIONS, YEAR_GROUP_COLUMNS)
from ..functions.geo import bearing_sql, haversine_sql, nearest_sql
from ..sources.incidents import duckdb_with

TWO_PI = repr(2 * math.pi)
HALF_PI = repr(math.pi / 2)


def q(name: str) -> str:
    return f'"{name}"'


def oob(x="X", y="Y") -> str:
    return f"coalesce({x} < {MIN_X!r} OR {x} > {MAX_X!r} OR {y} < {MIN_Y!r} OR {y} > {MAX_Y!r}, false)"


def repair_ctes(src: str, out: str) -> list[str]:
    """Pass 1 within ``src`` -> ``{out}_p1``; pass 2 with train means (CTE ``means``) -> ``out``."""
    return [
        f"{out}_f AS (SELECT *, {oob()} AS _oob FROM {src})",
        f"{out}_fix AS (SELECT Address, min_by(X, Id) AS _fx, min_by(Y, Id) AS _fy FROM {out}_f "
        f"WHERE NOT _oob AND Address IS NOT NULL AND Address IN (SELECT Address FROM {out}_f WHERE _oob) GROUP BY Address)",
        f"{out}_p1 AS (SELECT f.* EXCLUDE (X, Y, _oob), CASE WHEN f._oob THEN coalesce(x._fx, f.X) ELSE f.X END AS X, "
        f"CASE WHEN f._oob THEN coalesce(x._fy, f.Y) ELSE f.Y END AS Y FROM {out}_f f LEFT JOIN {out}_fix x "
        f"ON f._oob AND f.Address = x.Address)",
    ]


def pass2_cte(out: str) -> str:
    return (f"{out} AS (SELECT p.* EXCLUDE (X, Y), CASE WHEN {oob('p.X', 'p.Y')} THEN coalesce(m.mx, p.X) ELSE p.X END AS X, "
            f"CASE WHEN {oob('p.X', 'p.Y')} THEN coalesce(m.my, p.Y) ELSE p.Y END AS Y "
            f"FROM {out}_p1 p LEFT JOIN means m ON p.PdDistrict = m.PdDistrict)")


MEANS_CTE = (f"means AS (SELECT PdDistrict, avg(X) AS mx, avg(Y) AS my FROM tr_p1 "
             f"WHERE NOT {oob()} AND PdDistrict IS NOT NULL GROUP BY PdDistrict)")

TRAIN_SRC = "train_in AS (SELECT * EXCLUDE (Descript, Resolution) FROM train)"


def repaired_ctes(test: bool = True) -> list[str]:
    """``tr_rep`` (train, pass 1 + 2) and ``te_rep`` (test: pass 1 within test, train means)."""
    ctes = [TRAIN_SRC] + repair_ctes("train_in", "tr_rep") + [MEANS_CTE.replace("tr_p1", "tr_rep_p1"), pass2_cte("tr_rep")]
    if test:
        ctes += repair_ctes("test", "te_rep") + [pass2_cte("te_rep")]
    return ctes


PCA_CTES = [
    "pca_m AS (SELECT avg(X) AS mx, avg(Y) AS my, var_samp(X) AS vx, var_samp(Y) AS vy, covar_samp(X, Y) AS cxy "
    "FROM tr_rep WHERE X IS NOT NULL AND Y IS NOT NULL)",
    "pca_t AS (SELECT mx, my, 0.5 * atan2(2.0 * cxy, vx - vy) AS th FROM pca_m)",
    "pca_s AS (SELECT mx, my, cos(th) AS c1x, sin(th) AS c1y, -sin(th) AS c2x, cos(th) AS c2y FROM pca_t)",
    "pca AS (SELECT mx, my, "
    "CASE WHEN (CASE WHEN abs(c1x) >= abs(c1y) THEN c1x ELSE c1y END) >= 0 THEN 1 ELSE -1 END AS s1, "
    "CASE WHEN (CASE WHEN abs(c2x) >= abs(c2y) THEN c2x ELSE c2y END) >= 0 THEN 1 ELSE -1 END AS s2, "
    "c1x, c1y, c2x, c2y FROM pca_s)",
]


def cyclic(v: str, period: int) -> tuple[str, str]:
    a = f"({TWO_PI} * ({v}) / {float(period)!r})"
    return f"cos({a})", f"sin({a})"


def feature_select(src: str, keep=("Id",), districts=DISTRICTS) -> str:
    """SELECT of the 37 features from a repaired CTE (needs CTE ``pca``)."""
    cols = [*keep, "X", "Y"]
    cols += [f"CAST(coalesce(PdDistrict = '{d}', false) AS INTEGER) AS {q('PdDistrict_' + d)}" for d in districts]
    div = " ".join(f"WHEN '{k}' THEN {v}" for k, v in PATROL_DIVISION.items())
    cols.append(f"CAST(CASE PdDistrict {div} END AS INTEGER) AS Patrol_Division")
    cols.append("CAST(coalesce(instr(Address, '/') > 0, false) AS INTEGER) AS Intersection")
    wx, wy = cyclic("isodow(Dates) - 1", 7)
    dx, dy = cyclic("dayofyear(Dates)", 365)
    hx, hy = cyclic("hour(Dates) + minute(Dates) / 60.0", 24)
    cols += [f"{wx} AS DayOfWeek_X", f"{wy} AS DayOfWeek_Y", f"{dx} AS DayOfYear_X", f"{dy} AS DayOfYear_Y",
             f"{hx} AS Hour_X", f"{hy} AS Hour_Y"]
    h = "hour(Dates)"
    for name, cond in zip(PERIOD_COLUMNS, [f"{h} < 6", f"{h} >= 6 AND {h} <= 17", f"{h} >= 18"]):
        cols.append(f"CAST({cond} AS INTEGER) AS {q(name)}")
    y = "year(Dates)"
    for name, cond in zip(YEAR_GROUP_COLUMNS, [f"{y} <= 2005", f"{y} >= 2006 AND {y} <= 2009",
                                               f"{y} >= 2010 AND {y} <= 2012", f"{y} >= 2013"]):
        cols.append(f"CAST({cond} AS INTEGER) AS {q(name)}")
    cols.append("sqrt(X * X + Y * Y) AS Polar_Rho")
    cols.append(f"CASE WHEN X = 0 THEN (CASE WHEN Y > 0 THEN {HALF_PI} WHEN Y < 0 THEN -{HALF_PI} END) "
                f"ELSE atan(Y / X) END AS Polar_Phi")
    for a in ROTATION_ANGLES:
        c, s = repr(math.cos(a)), repr(math.sin(a))
        cols += [f"X * {c} + Y * {s} AS X_R{a}", f"Y * {c} - X * {s} AS Y_R{a}"]
    cols.append("(X - pca.mx) * (pca.c1x * pca.s1) + (Y - pca.my) * (pca.c1y * pca.s1) AS XY_PCA1")
    cols.append("(X - pca.mx) * (pca.c2x * pca.s2) + (Y - pca.my) * (pca.c2y * pca.s2) AS XY_PCA2")
    dmin, lon, lat = nearest_sql("X", "Y")
    cols.append(f"{dmin} AS Nearest_Station")
    cols.append(f"{bearing_sql('X', 'Y', lon, lat)} AS Nearest_Station_Bearing")
    return f"SELECT {', '.join(cols)} FROM {src} JOIN pca ON true"


def featured_ctes() -> list[str]:
    """``tr_feat`` (Id, Category, 37 features) and ``te_feat`` (Id, 37 features)."""
    return repaired_ctes() + PCA_CTES + [
        f"tr_feat AS ({feature_select('tr_rep', keep=('Id', 'Category'))})",
        f"te_feat AS ({feature_select('te_rep', keep=('Id',))})",
    ]


def with_ctes(*ctes: str) -> str:
    return duckdb_with(*ctes)


def rounded(body: str, doubles: list[str]) -> str:
    """Wrap a query so listed double columns are rounded to 6 decimals."""
    if not doubles:
        return body
    rep = ", ".join(f"round({q(c)}, 6) AS {q(c)}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({body}) AS _r"


def station_distance_sql(i: int, x="X", y="Y") -> str:
    _, lon, lat = STATIONS[i]
    return haversine_sql(x, y, repr(lon), repr(lat))


def station_bearing_sql(i: int, x="X", y="Y") -> str:
    _, lon, lat = STATIONS[i]
    return bearing_sql(x, y, repr(lon), repr(lat))
