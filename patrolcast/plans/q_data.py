"""Registered queries for scans, profiling, projections, joins, aggregates,
scalar functions and feature operators (SURVEY 2.A-2.I), each with its DuckDB twin."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..fixed import (DISTRICTS, LINEAR_DROP, PERIOD_COLUMNS, ROTATION_ANGLES, STATIONS, YEAR_GROUP_COLUMNS)
from ..functions.calendar import encode_cyclic, weekday
from ..functions.geo import bearing, haversine, nearest_point
from ..functions.scalar import atan_ratio, contains_flag
from ..operators.encode import StandardScaler, Vocabulary, columns_by_type, feature_set
from ..operators.features import date_parts_matrix, feature_columns
from ..operators.profile import describe
from ..operators.repair import (OutlierFit, district_means, out_of_bounds, repair_by_address,
                                repair_by_district)
from ..sources.files import read_incidents, read_zipped_csv, stage_incidents, write_csv
from ..sources.incidents import test_rows, train_rows
from ..sources.zips import write_zip_csv
from . import sqlparts as S
from .common import featured, finish, raw, register, repaired, staging_dir

CLASSES = [f"CAT_{i:02d}" for i in range(39)]
FEATURES = feature_columns(type("F", (), {"districts": DISTRICTS})())
DOUBLE_FEATURES = [c for c in FEATURES if c in (
    "X", "Y", "DayOfWeek_X", "DayOfWeek_Y", "DayOfYear_X", "DayOfYear_Y", "Hour_X", "Hour_Y", "Polar_Rho",
    "Polar_Phi", "X_R30", "Y_R30", "X_R60", "Y_R60", "XY_PCA1", "XY_PCA2", "Nearest_Station",
    "Nearest_Station_Bearing")]


def _sql(body: str, doubles=(), ctes=()) -> str:
    return S.rounded(S.with_ctes(*ctes) + body, list(doubles))


FEAT = S.featured_ctes()
REP = S.repaired_ctes()

# ---------------------------------------------------------------- 2.A sources


@register("a1_read_incidents", _sql("SELECT * FROM incidents", ["X", "Y"]))
def a1_read_incidents(spark, sf):
    path = staging_dir(spark, "incidents-csv")
    write_csv(raw(spark, sf), path)
    return finish(read_incidents(spark, path, fmt="csv"))


@register("a1b_stage_incidents", _sql(
    "SELECT 'train' AS kind, CAST(NULL AS BIGINT) AS given_id, true AS keyed, Dates, Category, Descript, DayOfWeek, PdDistrict, "
    "Resolution, Address, X, Y FROM train UNION ALL SELECT 'test', Id, true, Dates, NULL, NULL, DayOfWeek, PdDistrict, NULL, "
    "Address, X, Y FROM test", ["X", "Y"]))
def a1b_stage_incidents(spark, sf):
    """The two file layouts: train files without Id, test files without the label columns."""
    df = raw(spark, sf)
    path = staging_dir(spark, "layouts")
    write_csv(train_rows(df).drop("Id"), f"{path}/train-csv")
    write_csv(test_rows(df), f"{path}/test-csv")
    train = stage_incidents(spark, f"{path}/train-csv", f"{path}/train")
    test = stage_incidents(spark, f"{path}/test-csv", f"{path}/test")
    rest = ["Dates", "Category", "Descript", "DayOfWeek", "PdDistrict", "Resolution", "Address", "X", "Y"]
    keyed = F.col("Id").isNotNull().alias("keyed")
    return finish(train.select(F.lit("train").alias("kind"), F.lit(None).cast("long").alias("given_id"), keyed, *rest)
                  .unionByName(test.select(F.lit("test").alias("kind"), F.col("Id").alias("given_id"), keyed, *rest)))


@register("a1c_read_zipped", _sql("SELECT * FROM incidents", ["X", "Y"]))
def a1c_read_zipped(spark, sf):
    """Archives of CSV members, written by one job and scanned member by member."""
    path = staging_dir(spark, "incidents-zip")
    write_zip_csv(raw(spark, sf), path, "incidents.csv")
    return finish(read_zipped_csv(spark, path, "incidents.csv"))


@register("a2_read_features", _sql("SELECT * FROM tr_feat", DOUBLE_FEATURES, FEAT))
def a2_read_features(spark, sf):
    tr, _, _ = featured(spark, sf)
    path = staging_dir(spark, "features-parquet")
    tr.write.mode("overwrite").parquet(path)
    return finish(spark.read.parquet(path))


def _prior_wide_sql() -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE Category = '{c}') / count(*) AS {S.q(c)}" for c in CLASSES)
    return (S.with_ctes(f"prior AS (SELECT {cols} FROM train)")
            + "SELECT test.Id, prior.* FROM test JOIN prior ON true")


def _prior_wide(spark, sf):
    from ..models.prior import ClassPrior
    df = raw(spark, sf)
    tr = train_rows(df)
    vocab = Vocabulary.fit(tr, "Category")
    model = ClassPrior.fit(vocab.transform(tr), len(vocab.levels))
    from ..sources.sinks import to_wide
    return to_wide(model.transform(test_rows(df)), vocab.levels)


@register("a3_write_probabilities", S.rounded(_prior_wide_sql(), CLASSES))
def a3_write_probabilities(spark, sf):
    from ..sources.sinks import read_probabilities, write_probabilities
    wide = _prior_wide(spark, sf)
    path = staging_dir(spark, "probabilities-csv")
    write_probabilities(wide, path)
    return finish(read_probabilities(spark, path, CLASSES))


@register("c8_insert_and_rename", S.rounded(_prior_wide_sql(), CLASSES))
def c8_insert_and_rename(spark, sf):
    """Class-prior probabilities of every test row: Id first, one column per class name."""
    return finish(_prior_wide(spark, sf))


@register("a6_preview", _sql("SELECT * FROM incidents ORDER BY Id LIMIT 10", ["X", "Y"]))
def a6_preview(spark, sf):
    return finish(raw(spark, sf).orderBy("Id").limit(10))


# ---------------------------------------------------------------- 2.B profiling

def _describe_sql(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
             f"min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
             f"quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM {src}" for c in cols]
    return " UNION ALL ".join(parts)


@register("b1_describe", _sql(_describe_sql("train", ["X", "Y"]),
                              ["mean", "std", "min", "p25", "p50", "p75", "max"]))
def b1_describe(spark, sf):
    return finish(describe(train_rows(raw(spark, sf)), ["X", "Y"]))


@register("b1b_describe_repaired", _sql(_describe_sql("tr_rep", ["X", "Y"]),
                                      ["mean", "std", "min", "p25", "p50", "p75", "max"], REP))
def b1b_describe_repaired(spark, sf):
    """The same profile after the coordinate repair (the driver script profiles both)."""
    tr, _, _ = repaired(spark, sf)
    return finish(describe(tr, ["X", "Y"]))


# ---------------------------------------------------------------- 2.C projection / filter

@register("c1_drop_columns", _sql("SELECT * EXCLUDE (Descript, Resolution) FROM train", ["X", "Y"]))
def c1_drop_columns(spark, sf):
    return finish(train_rows(raw(spark, sf)).drop("Descript", "Resolution"))


_KEEPS = ["Dates", "Category", "DayOfWeek", "PdDistrict", "Resolution", "X", "Y"]


@register("c2_select_columns", _sql(f"SELECT {', '.join(_KEEPS)} FROM train", ["X", "Y"]))
def c2_select_columns(spark, sf):
    return finish(train_rows(raw(spark, sf)).select(*_KEEPS))


_LINEAR = [c for c in FEATURES if c not in LINEAR_DROP]


@register("c3_feature_set", _sql(f"SELECT Id, {', '.join(S.q(c) for c in _LINEAR)} FROM tr_feat",
                                 [c for c in DOUBLE_FEATURES if c in _LINEAR], FEAT))
def c3_feature_set(spark, sf):
    tr, _, fit = featured(spark, sf)
    return finish(tr.select("Id", *[F.col(f"`{c}`") for c in feature_set(feature_columns(fit), "linear")]))


@register("c4_out_of_bounds", _sql(f"SELECT Id, X, Y, {S.oob()} AS is_outlier FROM incidents", ["X", "Y"]))
def c4_out_of_bounds(spark, sf):
    return finish(raw(spark, sf).select("Id", "X", "Y", out_of_bounds().alias("is_outlier")))


@register("c5_conditional_update", _sql(
    f"SELECT t.Id, CASE WHEN {S.oob('t.X', 't.Y')} THEN coalesce(m.mx, t.X) ELSE t.X END AS X, "
    f"CASE WHEN {S.oob('t.X', 't.Y')} THEN coalesce(m.my, t.Y) ELSE t.Y END AS Y "
    "FROM test t LEFT JOIN means m ON t.PdDistrict = m.PdDistrict", ["X", "Y"], REP))
def c5_conditional_update(spark, sf):
    _, _, ofit = repaired(spark, sf)
    return finish(repair_by_district(test_rows(raw(spark, sf)), ofit).select("Id", "X", "Y"))


@register("c6_mask_algebra", _sql(
    f"SELECT Id, PdDistrict, Address FROM incidents WHERE ({S.oob()} OR coalesce(instr(Address, '/') > 0, false)) "
    "AND NOT coalesce(PdDistrict = 'PARK', false)"))
def c6_mask_algebra(spark, sf):
    df = raw(spark, sf)
    mask = (out_of_bounds() | (contains_flag("Address", "/") == 1)) & ~F.coalesce(F.col("PdDistrict") == "PARK",
                                                                                 F.lit(False))
    return df.filter(mask).select("Id", "PdDistrict", "Address")


@register("c7_columns_by_type", (
    S.with_ctes(*FEAT) + f"SELECT CAST(i - 1 AS INTEGER) AS position, c AS \"column\" FROM (SELECT unnest(range(1, {len(FEATURES)} + 1)) AS i, "
    f"unnest({FEATURES!r}) AS c) n JOIN (SELECT * FROM (UNPIVOT (SELECT {', '.join(f'typeof({S.q(c)}) AS {S.q(c)}' for c in FEATURES)} "
    "FROM tr_feat LIMIT 1) ON COLUMNS(*) INTO NAME name VALUE kind)) k ON k.name = n.c WHERE k.kind <> 'DOUBLE'"))
def c7_columns_by_type(spark, sf):
    """Positions of the non-double (categorical) feature columns, from the feature table's schema."""
    tr, _, _ = featured(spark, sf)
    names = [f.name for f in tr.schema.fields if f.name not in ("Id", "Category")]
    pos = columns_by_type(tr)
    rows = [(p, names[p]) for p in pos]
    return spark.createDataFrame(rows, "position int, column string")


@register("c9_row_slice", _sql(
    "SELECT PdDistrict, max_by(X, Id) AS last_X, max_by(Y, Id) AS last_Y, max(Id) AS last_Id FROM incidents "
    "GROUP BY PdDistrict", ["last_X", "last_Y"]))
def c9_row_slice(spark, sf):
    return finish(raw(spark, sf).groupBy("PdDistrict").agg(
        F.max_by("X", "Id").alias("last_X"), F.max_by("Y", "Id").alias("last_Y"), F.max("Id").alias("last_Id")))


# ---------------------------------------------------------------- 2.D joins and lookups

@register("d1_address_semi_join", _sql(
    f"SELECT Id, Address FROM train WHERE NOT {S.oob()} AND Address IN "
    f"(SELECT Address FROM train WHERE {S.oob()})"))
def d1_address_semi_join(spark, sf):
    tr = train_rows(raw(spark, sf))
    outl = tr.filter(out_of_bounds()).select("Address")
    return tr.filter(~out_of_bounds()).join(outl, "Address", "left_semi").select("Id", "Address")


@register("d2_repair_by_address", _sql("SELECT Id, X, Y FROM tr_rep_p1", ["X", "Y"], REP))
def d2_repair_by_address(spark, sf):
    tr = train_rows(raw(spark, sf)).drop("Descript", "Resolution")
    return finish(repair_by_address(tr).select("Id", "X", "Y"))


@register("d3_repair_by_district", _sql("SELECT Id, X, Y FROM tr_rep", ["X", "Y"], REP))
def d3_repair_by_district(spark, sf):
    tr = train_rows(raw(spark, sf)).drop("Descript", "Resolution")
    p1 = repair_by_address(tr)
    return finish(repair_by_district(p1, OutlierFit.fit(p1)).select("Id", "X", "Y"))


@register("d4_handle_outliers", _sql(
    "SELECT Id, X, Y, false AS is_test FROM tr_rep UNION ALL SELECT Id, X, Y, true AS is_test FROM te_rep",
    ["X", "Y"], REP))
def d4_handle_outliers(spark, sf):
    tr, te, _ = repaired(spark, sf)
    return finish(tr.select("Id", "X", "Y", F.lit(False).alias("is_test"))
                  .unionByName(te.select("Id", "X", "Y", F.lit(True).alias("is_test"))))


@register("d6_map_lookup", _sql(
    "SELECT Id, PdDistrict, CAST(CASE PdDistrict " + " ".join(
        f"WHEN '{k}' THEN {v}" for k, v in __import__("patrolcast.fixed", fromlist=["x"]).PATROL_DIVISION.items())
    + " END AS INTEGER) AS Patrol_Division FROM incidents"))
def d6_map_lookup(spark, sf):
    from ..operators.features import patrol_division
    return raw(spark, sf).select("Id", "PdDistrict", patrol_division().alias("Patrol_Division"))


def _argmin_sql(x="X", y="Y") -> tuple[str, str]:
    ds = [S.station_distance_sql(i, x, y) for i in range(len(STATIONS))]
    dmin = f"least({', '.join(ds)})"
    idx = "CASE " + " ".join(f"WHEN {d} = {dmin} THEN {i}" for i, d in enumerate(ds)) + " END"
    return dmin, idx


@register("d7_nearest_point", _sql(
    "SELECT Id, {0} AS Nearest_Station, {1} AS Nearest_Index FROM tr_rep".format(*_argmin_sql()),
    ["Nearest_Station"], REP))
def d7_nearest_point(spark, sf):
    tr, _, _ = repaired(spark, sf)
    n = nearest_point("X", "Y")
    return finish(tr.select("Id", n["dist"].alias("Nearest_Station"), n["idx"].alias("Nearest_Index")))


# ---------------------------------------------------------------- 2.E aggregation

@register("e1_district_means", _sql("SELECT PdDistrict, mx AS X, my AS Y FROM means", ["X", "Y"], REP))
def e1_district_means(spark, sf):
    tr = train_rows(raw(spark, sf)).drop("Descript", "Resolution")
    return finish(district_means(repair_by_address(tr)))


@register("e2_min_across", _sql(
    "SELECT Id, {0} AS min_dist, {1} AS argmin FROM incidents".format(*_argmin_sql()), ["min_dist"]))
def e2_min_across(spark, sf):
    n = nearest_point("X", "Y")
    return finish(raw(spark, sf).select("Id", n["dist"].alias("min_dist"), n["idx"].alias("argmin")))


@register("e5_distinct_index", _sql(
    f"SELECT DISTINCT Id FROM (SELECT Id FROM incidents WHERE {S.oob()} UNION ALL "
    "SELECT Id FROM incidents WHERE coalesce(instr(Address, '/') > 0, false))"))
def e5_distinct_index(spark, sf):
    df = raw(spark, sf)
    both = df.filter(out_of_bounds()).select("Id").unionByName(
        df.filter(contains_flag("Address", "/") == 1).select("Id"))
    return both.distinct()


@register("e6_factorize", _sql(
    "SELECT Id, Category, CAST(dense_rank() OVER (ORDER BY Category) - 1 AS INTEGER) AS code FROM train"))
def e6_factorize(spark, sf):
    tr = train_rows(raw(spark, sf))
    voc = Vocabulary.fit(tr, "Category")
    return voc.transform(tr.select("Id", "Category"), "code")


@register("e6b_factorize_addresses", _sql(
    "SELECT Id, Address, CAST(CASE WHEN Address IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY Address NULLS LAST) - 1 END AS INTEGER) AS code FROM train"))
def e6b_factorize_addresses(spark, sf):
    """A column of many levels: the vocabulary is a table at any size and codes come from a join."""
    tr = train_rows(raw(spark, sf)).select("Id", "Address")
    return Vocabulary.fit(tr, "Address", max_literal=0).transform(tr, "code")


# ---------------------------------------------------------------- 2.G scalar functions

def _g(name, spark_cols, sql_cols, doubles, src_sql="incidents"):
    @register(name, _sql(f"SELECT Id, {', '.join(sql_cols)} FROM {src_sql}", doubles))
    def q(spark, sf):
        return finish(raw(spark, sf).select("Id", *spark_cols()))
    q.__name__ = name
    return q


_g("g1_trig", lambda: [F.cos(F.radians("X")).alias("cos_x"), F.sin(F.radians("Y")).alias("sin_y")],
   ["cos(radians(X)) AS cos_x", "sin(radians(Y)) AS sin_y"], ["cos_x", "sin_y"])
_g("g2_sqrt", lambda: [F.sqrt(F.col("X") * F.col("X") + F.col("Y") * F.col("Y")).alias("norm"),
                       (F.col("X") * F.col("X")).alias("x_sq")],
   ["sqrt(X * X + Y * Y) AS norm", "X * X AS x_sq"], ["norm", "x_sq"])
_g("g3_arc", lambda: [atan_ratio("Y", "X").alias("atan_ratio"), F.atan2("Y", "X").alias("atan2_yx"),
                      F.asin(F.least(F.abs(F.col("Y")) / 100.0, F.lit(1.0))).alias("asin_y")],
   [f"CASE WHEN X = 0 THEN (CASE WHEN Y > 0 THEN {S.HALF_PI} WHEN Y < 0 THEN -{S.HALF_PI} END) "
    "ELSE atan(Y / X) END AS atan_ratio", "atan2(Y, X) AS atan2_yx", "asin(least(abs(Y) / 100.0, 1.0)) AS asin_y"],
   ["atan_ratio", "atan2_yx", "asin_y"])
_g("g4_angle", lambda: [F.radians("X").alias("rad_x"), F.degrees(F.radians("Y")).alias("deg_y"),
                        (F.lit(math.pi) * F.col("Y") / 180.0).alias("pi_y")],
   ["radians(X) AS rad_x", "degrees(radians(Y)) AS deg_y", f"{math.pi!r} * Y / 180.0 AS pi_y"],
   ["rad_x", "deg_y", "pi_y"])
_g("g5_floor_div", lambda: [(F.floor(F.hour("Dates") / 6) % 6).cast("int").alias("period"),
                            F.try_divide(F.col("Y"), F.col("X")).alias("ratio"),
                            (F.hour("Dates") % 6).alias("hour_mod")],
   ["CAST(floor(hour(Dates) / 6) % 6 AS INTEGER) AS period", "Y / X AS ratio", "hour(Dates) % 6 AS hour_mod"],
   ["ratio"])
_g("g6_log", lambda: [F.log(F.abs(F.col("X"))).alias("ln_abs_x"), F.log(F.col("Y")).alias("ln_y")],
   ["ln(abs(X)) AS ln_abs_x", "ln(Y) AS ln_y"], ["ln_abs_x", "ln_y"])
_g("g7_calendar", lambda: [weekday("Dates").alias("weekday"), F.dayofyear("Dates").alias("dayofyear"),
                           F.hour("Dates").alias("hour"), F.minute("Dates").alias("minute"),
                           F.year("Dates").alias("year")],
   ["CAST(isodow(Dates) - 1 AS INTEGER) AS weekday", "CAST(dayofyear(Dates) AS INTEGER) AS dayofyear",
    "CAST(hour(Dates) AS INTEGER) AS hour", "CAST(minute(Dates) AS INTEGER) AS minute",
    "CAST(year(Dates) AS INTEGER) AS year"], [])
_g("g8_date_parts", lambda: [F.month("Dates").alias("month"), F.dayofmonth("Dates").alias("day"),
                             F.second("Dates").alias("second")],
   ["CAST(month(Dates) AS INTEGER) AS month", "CAST(day(Dates) AS INTEGER) AS day",
    "CAST(second(Dates) AS INTEGER) AS second"], [])
_g("g9_contains", lambda: [F.col("Address"), contains_flag("Address", "/").alias("has_slash")],
   ["Address", "CAST(coalesce(instr(Address, '/') > 0, false) AS INTEGER) AS has_slash"], [])
_g("g10_cast", lambda: [(F.col("X") > -122.4).cast("int").alias("east"),
                        F.floor(F.col("Y") * 100).cast("bigint").alias("y_centi")],
   ["CAST(X > -122.4 AS INTEGER) AS east", "CAST(floor(Y * 100) AS BIGINT) AS y_centi"], [])
# the square root of a negative number is NaN: west of -122.42 in the first column, nowhere in a row without X
_g("g11_isnan", lambda: [F.isnan(F.sqrt(F.col("X") + 122.42)).alias("x_nan"), F.col("Y").isNotNull().alias("y_present")],
   ["X IS NOT NULL AND X + 122.42 < 0 AS x_nan", "Y IS NOT NULL AS y_present"], [])


@register("g12_factor", _sql(
    "SELECT Id, Category, CAST(dense_rank() OVER (ORDER BY Category) AS INTEGER) AS factor FROM train"))
def g12_factor(spark, sf):
    tr = train_rows(raw(spark, sf))
    return Vocabulary.fit(tr, "Category").transform(tr.select("Id", "Category"), "factor", base=1)


# ---------------------------------------------------------------- 2.H feature operators

def _h(name, cols, src="tr_feat"):
    doubles = [c for c in cols if c in DOUBLE_FEATURES]
    sql = _sql(f"SELECT Id, {', '.join(S.q(c) for c in cols)} FROM {src}", doubles, FEAT)

    @register(name, sql)
    def q(spark, sf):
        tr, te, _ = featured(spark, sf)
        d = tr if src == "tr_feat" else te
        return finish(d.select("Id", *[F.col(f"`{c}`") for c in cols]))
    q.__name__ = name
    return q


_h("h1_encode_district", [f"PdDistrict_{d}" for d in DISTRICTS], src="te_feat")
_h("h2_patrol_division", ["Patrol_Division"])
_h("h3_intersection", ["Intersection"])
_h("h5_day_of_week", ["DayOfWeek_X", "DayOfWeek_Y"])
_h("h6_day_of_year", ["DayOfYear_X", "DayOfYear_Y"])
_h("h7_hour_of_day", ["Hour_X", "Hour_Y"])
_h("h8_periods", PERIOD_COLUMNS)
_h("h9_year_groups", YEAR_GROUP_COLUMNS)
_h("h10_polar", ["Polar_Rho", "Polar_Phi"])
_h("h11_rotate", [f"{a}_R{r}" for r in ROTATION_ANGLES for a in ("X", "Y")])
_h("h12_pca_rotation", ["XY_PCA1", "XY_PCA2"], src="te_feat")
_h("h13_nearest_station", ["Nearest_Station"])
_h("h14_nearest_station_bearing", ["Nearest_Station_Bearing"], src="te_feat")

_mx, _my = S.cyclic("month(Dates)", 12)


@register("h4_encode_cyclic", _sql(f"SELECT Id, {_mx} AS Month_X, {_my} AS Month_Y FROM incidents",
                                   ["Month_X", "Month_Y"]))
def h4_encode_cyclic(spark, sf):
    x, y = encode_cyclic(F.month("Dates"), 12)
    return finish(raw(spark, sf).select("Id", x.alias("Month_X"), y.alias("Month_Y")))


@register("h15_haversine", _sql(
    f"SELECT Id, {S.station_distance_sql(0)} AS dist_central, {S.station_distance_sql(9)} AS dist_taraval FROM tr_rep",
    ["dist_central", "dist_taraval"], REP))
def h15_haversine(spark, sf):
    tr, _, _ = repaired(spark, sf)
    (_, lo0, la0), (_, lo9, la9) = STATIONS[0], STATIONS[9]
    return finish(tr.select("Id", haversine("X", "Y", F.lit(lo0), F.lit(la0)).alias("dist_central"),
                            haversine("X", "Y", F.lit(lo9), F.lit(la9)).alias("dist_taraval")))


@register("h16_bearing", _sql(
    f"SELECT Id, {S.station_bearing_sql(0)} AS bearing_central FROM tr_rep", ["bearing_central"], REP))
def h16_bearing(spark, sf):
    tr, _, _ = repaired(spark, sf)
    _, lo0, la0 = STATIONS[0]
    return finish(tr.select("Id", bearing("X", "Y", F.lit(lo0), F.lit(la0)).alias("bearing_central")))


@register("h17_main_clean", _sql(
    "SELECT * FROM tr_feat UNION ALL BY NAME SELECT *, CAST(NULL AS VARCHAR) AS Category FROM te_feat",
    DOUBLE_FEATURES, FEAT))
def h17_main_clean(spark, sf):
    tr, te, _ = featured(spark, sf)
    return finish(tr.unionByName(te.withColumn("Category", F.lit(None).cast("string"))))


def _factor_sql(c: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {c}) AS INTEGER) AS {c}_code"


@register("h18_date_parts", _sql(
    "SELECT Id, " + ", ".join(_factor_sql(c) for c in ("Category", "DayOfWeek", "PdDistrict", "Resolution"))
    + ", X, Y, CAST(year(Dates) AS INTEGER) AS year, CAST(month(Dates) AS INTEGER) AS month, "
      "CAST(day(Dates) AS INTEGER) AS day, CAST(hour(Dates) AS INTEGER) AS hour, "
      "CAST(minute(Dates) AS INTEGER) AS minute, CAST(second(Dates) AS INTEGER) AS second FROM train",
    ["X", "Y"]))
def h18_date_parts(spark, sf):
    tr = train_rows(raw(spark, sf))
    vocabs = {c: Vocabulary.fit(tr, c).levels for c in ("Category", "DayOfWeek", "PdDistrict", "Resolution")}
    return finish(date_parts_matrix(tr, vocabs))


# ---------------------------------------------------------------- 2.I learned transforms

def _scaler_sql() -> str:
    stats = ", ".join(f"avg({S.q(c)}) AS {S.q('m_' + c)}, stddev_pop({S.q(c)}) AS {S.q('s_' + c)}" for c in _LINEAR)
    cols = ", ".join(
        f"(CAST(t.{S.q(c)} AS DOUBLE) - st.{S.q('m_' + c)}) / (CASE WHEN st.{S.q('s_' + c)} > 0 "
        f"THEN st.{S.q('s_' + c)} ELSE 1.0 END) AS {S.q(c)}" for c in _LINEAR)
    return _sql(f"SELECT t.Id, {cols} FROM te_feat t JOIN st ON true", _LINEAR,
                FEAT + [f"st AS (SELECT {stats} FROM tr_feat)"])


@register("i1_standard_scaler", _scaler_sql())
def i1_standard_scaler(spark, sf):
    tr, te, fit = featured(spark, sf)
    cols = feature_set(feature_columns(fit), "linear")
    sc = StandardScaler.fit(tr, cols)
    return finish(sc.transform(te.select("Id", *[F.col(f"`{c}`") for c in cols])))
