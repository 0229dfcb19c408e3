"""Fits of few rows run whole in a Spark task for each set of training rows: the same solver, no pass over all rows an iteration."""
import numpy as np
import pytest

import patrolcast.models.base as base
import patrolcast.models.linear as linear
from patrolcast.models.linear import LinearTask, add_loss, fit_tasks

K, COLS = 3, ["a", "b"]


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.RandomState(7)
    y = rng.randint(0, K, 900)
    x = np.column_stack([y + rng.randn(900), (y == 1) * 2 + rng.randn(900)])
    rows = [(i, float(a) if i % 50 else None, float(b), int(k), i % 3) for i, ((a, b), k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "Id long, a double, b double, label int, grp int").repartition(4)


TASKS = [LinearTask(loss, alpha=1e-2, penalty=p, fit_intercept=i, train_groups=g, class_weight=w)
         for loss, p in (("hinge", "l2"), ("log", "l2"), ("log", "l1"), ("softmax", "l2"))
         for i in (True, False) for g, w in (([0, 1], None), ([2], "balanced"))]


def test_equal_to_shared_passes(df, monkeypatch):
    passes, plain = [], base.partial_sums
    monkeypatch.setattr(base, "partial_sums", lambda *a, **k: passes.append(1) or plain(*a, **k))
    few = fit_tasks(df, COLS, K, TASKS, 3)
    assert len(passes) == 1  # the moments; before, a pass over all rows for every iteration
    monkeypatch.setattr(linear, "ONE_TASK", 0)
    shared = fit_tasks(df, COLS, K, TASKS, 3)
    assert len(passes) > 10
    for a, b in zip(few, shared):
        assert a.n_iter == b.n_iter and a.converged and b.converged
        assert (a.W == b.W).all() and (a.b == b.b).all()  # to the last digit
    # some apart, some shared: group 2 has 300 rows, groups 0 and 1 have 600
    monkeypatch.setattr(linear, "ONE_TASK", 300 * K * 3 * 8)
    for a, b in zip(fit_tasks(df, COLS, K, TASKS, 3), shared):
        assert a.n_iter == b.n_iter and (a.W == b.W).all()


def test_limit_of_passes_and_no_rows(df):
    with pytest.warns(RuntimeWarning, match="limit"):
        cut, none = fit_tasks(df, COLS, K, [LinearTask("log", alpha=1e-4, train_groups=[0]), LinearTask("log", train_groups=[])], 3, max_iter=2)
    assert not cut.converged and cut.n_iter == 2 and not none.W.any()


def test_log_loss_of_far_margins():
    """One logarithm for a few classes; margins too far for their product are taken one by one."""
    for far in (30.0, 79.0, 500.0, 1000.0):
        z = np.array([[-far, far, 0.5], [0.0, -1.0, 2.0], *[[far, -far, 1.0]] * 20])
        hot, w = (np.array([0, 1, 2]), np.arange(3)), np.array([1.0, 2.0, 0.5])
        y = np.full(z.shape, -1.0)
        y[hot] = 1.0
        value, der = linear.loss_grad("log", y * z)
        work = np.empty((2, *z.shape))
        assert np.isclose(add_loss("log", z.copy(), hot, w, 0.1, *work), (value * w).sum(), rtol=1e-12)
        assert np.allclose(work[1], y * der * w, atol=1e-12)
