"""The shared trainer: folded feature maps, the softmax task, per-fold maps and the grids."""
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from patrolcast.models.base import softmax
from patrolcast.models.kernel import Nystroem
from patrolcast.models.linear import LinearTask, fit_softmax, fit_tasks, group_stats
from patrolcast.models.search import grid_search_linear, linear_grid
from patrolcast.operators import selection
from patrolcast.operators.selection import stratified_folds

K, COLS = 3, ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.RandomState(4)
    y = rng.randint(0, K, 600)
    x = np.column_stack([y + rng.randn(600), (y == 1) * 2 + rng.randn(600), rng.randn(600) * 3])
    return x, y


@pytest.fixture(scope="module")
def df(spark, data):
    x, y = data
    rows = [(i, *map(float, r), int(k), i % 2) for i, (r, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "Id long, a double, b double, c double, label int, grp int").repartition(4)


def explicit(ny):
    """The same features without a root: multiplied out in every pass."""
    return lambda X: ny(X)


def _hinge(Phi, y, m, mu):
    Y = np.where(y[:, None] == np.arange(K), 1.0, -1.0)
    h = 1 - Y * (Phi @ m.W.T + m.b)
    val = np.where(h <= 0, 0, np.where(h < mu, h * h / (2 * mu), h - mu / 2))
    return val.sum(axis=1).mean() + m.task.alpha / 2 * (m.W ** 2).sum()


def test_folded_root_solves_the_same_problem(df, data):
    x, y = data
    ny = Nystroem.fit(df, COLS, gamma=0.1, n_components=40)
    task = LinearTask("squared_hinge", alpha=1e-2)
    (folded,) = fit_tasks(df, COLS, K, [task], 2, tol=1e-9, featurize=ny, dim=ny.dim, standardize=False)
    (plain,) = fit_tasks(df, COLS, K, [task], 2, tol=1e-9, featurize=explicit(ny), dim=ny.dim, standardize=False)
    assert folded.converged and plain.converged
    def value(m):
        Y = np.where(y[:, None] == np.arange(K), 1.0, -1.0)
        return (np.maximum(0, 1 - Y * (ny(x) @ m.W.T + m.b)) ** 2).sum(axis=1).mean() + 5e-3 * (m.W ** 2).sum()
    assert abs(value(folded) - value(plain)) < 1e-6
    assert np.allclose(folded.decision(x), ny(x) @ folded.W.T + folded.b) and np.allclose(folded.decision(x), plain.decision(x), atol=2e-3)
    (band,) = fit_tasks(df, COLS, K, [LinearTask("hinge", alpha=1e-2)], 2, tol=1e-8, featurize=ny, dim=ny.dim, standardize=False)
    (other,) = fit_tasks(df, COLS, K, [LinearTask("hinge", alpha=1e-2)], 2, tol=1e-8, featurize=explicit(ny), dim=ny.dim, standardize=False)
    assert abs(_hinge(ny(x), y, band, 0.01) - _hinge(ny(x), y, other, 0.01)) < 1e-5
    assert (np.linalg.norm(ny(x), axis=1) ** 2 < ny.norm_bound + 1e-6).all()
    assert group_stats(df, COLS, K, 2, featurize=ny, dim=ny.dim).nk.sum() == 600


def test_maps_by_task(df, data):
    """Each task with its own map equals a fit of its own."""
    maps = [Nystroem.fit(df.where(F.col("grp") != f), COLS, gamma=0.1, n_components=30) for f in range(2)]
    tasks = [LinearTask("squared_hinge", alpha=1e-2, train_groups=[1 - f], feature_map=f) for f in range(2)]
    both = fit_tasks(df, COLS, K, tasks, 2, tol=1e-9, featurize=maps, dim=30, standardize=False)
    for f in range(2):
        (one,) = fit_tasks(df, COLS, K, [LinearTask("squared_hinge", alpha=1e-2, train_groups=[1 - f])], 2, tol=1e-9,
                           featurize=maps[f], dim=30, standardize=False)
        assert np.allclose(one.W, both[f].W, atol=1e-6) and np.allclose(one.decision(data[0]), both[f].decision(data[0]), atol=1e-5)


def test_softmax_task_is_the_multinomial_optimum(df, data):
    x, y = data
    (m,) = fit_tasks(df, COLS, K, [LinearTask("softmax", C=0.1)], 2, tol=1e-10)
    xs = (x - x.mean(0)) / x.std(0)
    p = softmax(xs @ m.W.T + m.b)
    g = (p - (y[:, None] == np.arange(K))).T @ xs / len(y) + m.W / (0.1 * len(y))
    assert m.converged and np.abs(g).max() < 1e-4
    assert np.allclose(m.probabilities(x), fit_softmax(df, COLS, K, C=0.1, tol=1e-10).predict_proba(x), atol=1e-3)
    (balanced,) = fit_tasks(df, COLS, K, [LinearTask("softmax", C=0.1, class_weight="balanced", train_groups=[0])], 2)
    assert balanced.converged and np.allclose(balanced.probabilities(x).sum(axis=1), 1)


def test_many_tasks_with_shared_rows_equal_single_fits(df):
    tasks = [LinearTask(loss, alpha=a, train_groups=g, fit_intercept=i) for loss in ("log", "softmax", "modified_huber")
             for a in (1e-2, 1e-1) for g in ([0], [1]) for i in (True, False)]
    for m, t in zip(fit_tasks(df, COLS, K, tasks, 2, tol=1e-9), tasks):
        (one,) = fit_tasks(df, COLS, K, [t], 2, tol=1e-9)
        assert np.allclose(m.W, one.W, atol=1e-8) and np.allclose(m.b, one.b, atol=1e-8)


@pytest.mark.parametrize("kind", ["softmax", "rbf"])
def test_grid_search(spark, df, kind):
    if kind == "softmax":
        grid = linear_grid("softmax", C=[1e-2, 1e-1, 1.0])
        out = grid_search_linear(spark, df, COLS, K, grid, tol=1e-8).collect()
    else:
        grid = linear_grid("hinge", alpha=[1e-3, 1e-2], class_weight=[None, "balanced"], fit_intercept=[True])
        out = grid_search_linear(spark, df, COLS, K, grid, calibrated=True,
                                 feature_map=lambda d: Nystroem.fit(d, COLS, gamma=0.1, n_components=25)).collect()
    assert len(out) == len(grid) == len({r.params for r in out}) and all(r.converged for r in out)
    assert all(-np.log(K) < r.mean_test_score < 0 for r in out) and min(r.rank_test_score for r in out) == 1
    if kind == "softmax":  # the score of a setting, from fits of its own
        folds = stratified_folds(df, 2, label="label", out="f")
        c = 0.1
        scores = []
        for f in range(2):
            m = fit_softmax(folds.where(F.col("f") != f), COLS, K, C=c, tol=1e-10)
            held = folds.where(F.col("f") == f).toPandas()
            p = m.predict_proba(held[COLS].to_numpy())
            scores.append(np.log(p[np.arange(len(held)), held.label]).mean())
        got = next(r for r in out if json.loads(r.params)["C"] == c)
        assert abs(got.mean_test_score - np.mean(scores)) < 1e-4


def test_strata_without_cut_points_count(spark, monkeypatch):
    rows = [(i, f"one{i}") for i in range(60)] + [(100 + 10 * s + i, f"ten{s}") for s in range(30) for i in range(10)]
    many = spark.createDataFrame(rows, "Id long, label string")
    monkeypatch.setattr(selection, "MAX_CUTS", 50)
    with pytest.raises(ValueError, match="strata"):
        stratified_folds(many, 2, label="label").count()
    monkeypatch.setattr(selection, "MAX_CUTS", 200)
    got = stratified_folds(many, 2, label="label").groupBy("label", "fold").count().collect()
    assert sum(r["count"] == 5 for r in got) == 60


@pytest.mark.parametrize("loss", ["log", "hinge", "squared_hinge", "modified_huber"])
@pytest.mark.parametrize("weighted", [False, True])
def test_losses_in_place_equal_the_plain_ones(loss, weighted):
    from patrolcast.models.linear import add_loss, loss_grad

    rng = np.random.RandomState(1)
    z, y = rng.randn(200, 5) * 3, rng.randint(0, 5, 200)
    z[:20] = np.rint(z[:20])  # margins at the kinks
    w = rng.rand(200) * 2 if weighted else None
    Y = np.where(y[:, None] == np.arange(5), 1.0, -1.0)
    value, der = loss_grad(loss, Y * z, 0.1)
    each = np.ones(200) if w is None else w
    work = np.empty((2, 5, 200))
    total = add_loss(loss, np.ascontiguousarray(z.T), (y, np.arange(200)), w, 0.1, *work)
    assert np.isclose(total, (value * each[:, None]).sum(), rtol=1e-12)
    assert np.allclose(work[1].T, Y * der * each[:, None], atol=1e-12)


def test_calibration_keeps_no_margins(df, monkeypatch):
    """A grid's margins are rows x settings x classes: the passes read packed rows and nothing else is held."""
    import patrolcast.models.base as base
    from patrolcast.models.calibration import calibrated_fits

    seen, plain = [], base.partial_sums
    def spy(data, *a, **k):
        seen.append((set(data.columns), data.sparkSession.sparkContext._jsc.sc().getPersistentRDDs().size()))
        return plain(data, *a, **k)
    monkeypatch.setattr(base, "partial_sums", spy)
    rows = df.withColumn("Id", F.monotonically_increasing_id()).drop("grp")
    before = df.sparkSession.sparkContext._jsc.sc().getPersistentRDDs().size()
    settings = [LinearTask("squared_hinge", alpha=a) for a in (1e-2, 1e-1)]
    models = calibrated_fits(rows, COLS, K, settings, max_iter=3)
    assert all(c == {"grp", "whole", "y", "x"} and n <= before + 1 for c, n in seen) and len(seen) > 4
    assert all(np.isfinite(m.calib).all() for model in models for m in model.members)
