"""Hand-written edge rows (FIXTURES section 2) through repair and features."""
import datetime as dt
import math

import pytest

from patrolcast.fixed import MAX_Y, MIN_X, STATIONS
from patrolcast.operators.features import FeatureFit, PcaFit, main_clean
from patrolcast.operators.repair import OutlierFit, handle_outliers, out_of_bounds, repair_by_address
from patrolcast.sources.incidents import nan_to_null

SCHEMA = "Id long, Dates timestamp_ntz, Category string, PdDistrict string, Address string, X double, Y double"


def frame(spark, rows):
    return nan_to_null(spark.createDataFrame(rows, SCHEMA))


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_bounds_inclusive_and_nan(spark):
    rows = [(1, ts("2010-01-01 00:00:00"), "A", "PARK", "a", MIN_X, MAX_Y),
            (2, ts("2010-01-01 00:00:00"), "A", "PARK", "a", float("nan"), 37.75),
            (3, ts("2010-01-01 00:00:00"), "A", "PARK", "a", -120.5, 90.0)]
    got = {r.Id: r.o for r in frame(spark, rows).select("Id", out_of_bounds().alias("o")).collect()}
    assert got == {1: False, 2: False, 3: True}


def test_repair_by_address_lowest_id_wins(spark):
    rows = [(5, ts("2010-01-01 00:00:00"), "A", "PARK", "1 Main", -122.40, 37.75),
            (3, ts("2010-01-01 00:00:00"), "A", "PARK", "1 Main", -122.45, 37.76),
            (9, ts("2010-01-01 00:00:00"), "A", "PARK", "1 Main", -120.5, 90.0)]
    got = {r.Id: (r.X, r.Y) for r in repair_by_address(frame(spark, rows)).collect()}
    assert got[9] == (-122.45, 37.76)


def test_repair_by_district_means_and_missing_district(spark):
    rows = [(1, ts("2010-01-01 00:00:00"), "A", "PARK", "p1", -122.40, 37.70 + 0.05),
            (2, ts("2010-01-01 00:00:00"), "A", "PARK", "p2", -122.42, 37.77),
            (3, ts("2010-01-01 00:00:00"), "A", "PARK", "p3", -120.5, 90.0),
            (4, ts("2010-01-01 00:00:00"), "A", "BAYVIEW", "b1", -120.5, 90.0),   # no in-bounds BAYVIEW row
            (5, ts("2010-01-01 00:00:00"), "A", None, "n1", -120.5, 90.0)]
    out, fit = handle_outliers(frame(spark, rows))
    got = {r.Id: (r.X, r.Y) for r in out.collect()}
    assert got[3] == pytest.approx((-122.41, 37.76))
    assert got[4] == (-120.5, 90.0)          # value kept
    assert got[5] == (-120.5, 90.0)          # NULL district: no mean
    assert set(fit.means) == {"PARK"}
    # test rows reuse train means; their own rows never change the fit
    test_rows = [(10, ts("2010-01-01 00:00:00"), None, "PARK", "t1", -120.5, 90.0)]
    out2, fit2 = handle_outliers(frame(spark, test_rows), fit)
    assert fit2 is fit
    assert out2.first().X == pytest.approx(-122.41)


def feats(spark, rows, fit=None):
    df = frame(spark, rows)
    if fit is None:
        fit = FeatureFit(["BAYVIEW", "PARK"], PcaFit(-122.4, 37.75, [[1.0, 0.0], [0.0, 1.0]]))
    out, _ = main_clean(df, fit)
    return {r.Id: r.asDict() for r in out.collect()}


def test_calendar_edges(spark):
    rows = [(1, ts("2012-12-31 05:59:00"), "A", "PARK", "1 Main", -122.4, 37.75),
            (2, ts("2005-06-01 06:00:00"), "A", "PARK", "1 Main", -122.4, 37.75),
            (3, ts("2006-06-01 17:59:00"), "A", "PARK", "1 Main", -122.4, 37.75),
            (4, ts("2013-06-01 18:00:00"), "A", "PARK", "1 Main", -122.4, 37.75),
            (5, ts("2002-06-05 00:00:00"), "A", "PARK", "1 Main", -122.4, 37.75),
            (6, ts("2017-06-05 23:30:00"), "A", "PARK", "1 Main", -122.4, 37.75)]
    f = feats(spark, rows)
    # day 366 wraps past a full turn
    assert f[1]["DayOfYear_X"] == pytest.approx(math.cos(2 * math.pi * 366 / 365))
    assert (f[1]["0000-0559"], f[2]["0600-1759"], f[3]["0600-1759"], f[4]["1800-2359"]) == (1, 1, 1, 1)
    assert (f[2]["2003-2005"], f[3]["2006-2009"], f[1]["2010-2012"], f[4]["2013-2016"]) == (1, 1, 1, 1)
    assert (f[5]["2003-2005"], f[6]["2013-2016"]) == (1, 1)
    # Monday = 0: 2002-06-05 is a Wednesday -> 2
    assert f[5]["DayOfWeek_X"] == pytest.approx(math.cos(2 * math.pi * 2 / 7))
    assert f[6]["Hour_X"] == pytest.approx(math.cos(2 * math.pi * 23.5 / 24))


def test_null_text_and_unknown_district(spark):
    rows = [(1, ts("2010-01-01 00:00:00"), "A", None, None, -122.4, 37.75),
            (2, ts("2010-01-01 00:00:00"), "A", "NOWHERE", "A ST / B ST", -122.4, 37.75)]
    f = feats(spark, rows)
    assert f[1]["Intersection"] == 0 and f[2]["Intersection"] == 1
    assert f[1]["PdDistrict_PARK"] == 0 and f[1]["PdDistrict_BAYVIEW"] == 0
    assert f[1]["Patrol_Division"] is None and f[2]["Patrol_Division"] is None


def test_polar_at_zero_and_station_distance(spark):
    _, lon, lat = STATIONS[4]
    rows = [(1, ts("2010-01-01 00:00:00"), "A", "PARK", "x", 0.0, 37.75),
            (2, ts("2010-01-01 00:00:00"), "A", "PARK", "x", lon, lat)]
    f = feats(spark, rows)
    assert f[1]["Polar_Phi"] == pytest.approx(math.pi / 2)
    assert f[2]["Nearest_Station"] == pytest.approx(0.0, abs=1e-9)


def test_rotation_uses_radians(spark):
    rows = [(1, ts("2010-01-01 00:00:00"), "A", "PARK", "x", -122.4, 37.75)]
    f = feats(spark, rows)
    assert f[1]["X_R30"] == pytest.approx(-122.4 * math.cos(30) + 37.75 * math.sin(30))


def test_pca_fit_matches_numpy(spark):
    import numpy as np
    rng = np.random.RandomState(0)
    xs = -122.45 + 0.03 * rng.randn(300)
    ys = 37.76 + 0.5 * (xs + 122.45) + 0.01 * rng.randn(300)
    rows = [(i, ts("2010-01-01 00:00:00"), "A", "PARK", "x", float(x), float(y)) for i, (x, y) in enumerate(zip(xs, ys))]
    fit = FeatureFit.fit(frame(spark, rows))
    C = np.cov(np.vstack([xs, ys]))
    w, V = np.linalg.eigh(C)
    v1 = V[:, 1] * np.sign(V[np.argmax(np.abs(V[:, 1])), 1])
    assert fit.pca.components[0] == pytest.approx(list(v1), abs=1e-9)
    assert fit.pca.mean_x == pytest.approx(xs.mean())


def test_fused_fit_equals_separate_fits(spark):
    from patrolcast.operators.fitting import fit_repair_and_features
    from patrolcast.sources.incidents import incidents, train_rows
    from conftest import SF_MID
    extra = [(900001, ts("2010-01-01 00:00:00"), "A", None, "zz", -120.5, 90.0),
             (900002, ts("2010-01-01 00:00:00"), "A", "NOWHERE", "zz", -120.5, 90.0)]
    base = train_rows(incidents(spark, SF_MID)).select("Id", "Dates", "Category", "PdDistrict", "Address", "X", "Y")
    df = base.unionByName(frame(spark, extra))
    passed = repair_by_address(df)
    ofit, ffit = fit_repair_and_features(passed)
    o2 = OutlierFit.fit(passed)
    from patrolcast.operators.repair import repair_by_district
    f2 = FeatureFit.fit(repair_by_district(passed, o2))
    assert set(ofit.means) == set(o2.means)
    for k in o2.means:
        assert ofit.means[k] == pytest.approx(o2.means[k], rel=1e-12)
    assert ffit.districts == f2.districts
    assert ffit.pca.mean_x == pytest.approx(f2.pca.mean_x, rel=1e-12)
    assert sum(ffit.pca.components, []) == pytest.approx(sum(f2.pca.components, []), abs=1e-9)
