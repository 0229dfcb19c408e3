"""Trials fitted in shared passes against each trial fitted alone."""
import dataclasses

import numpy as np
import pytest

from patrolcast.models.boost import Binner, BoostParams, fit_boost
from patrolcast.models.forest import fit_forest, oob_losses, oob_votes
from patrolcast.models.search import boost_objective, forest_objective, random_search
from patrolcast.operators.selection import log_loss
from patrolcast.sources.sinks import read_trials

COLS, K = ["a", "b", "c", "d"], 3


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.RandomState(5)
    X = rng.normal(size=(600, 4)).round(3)
    y = (X[:, 0] + 0.5 * X[:, 1] ** 2 + rng.normal(scale=0.4, size=600) > 0.3).astype(int) + (X[:, 2] > 0.8)
    df = spark.createDataFrame([(i, int(y[i]), int(i * 7919 % 2), *map(float, X[i])) for i in range(600)],
                               "Id long, label int, fold int, a double, b double, c double, d double").repartition(4).cache()
    df.count()
    return df


SETTINGS = [
    dict(max_depth=5, eta=0.8, subsample=0.7, colsample=0.75, reg_alpha=0.5, gamma=0.1, min_child_weight=2.0),
    dict(max_depth=2, eta=0.1, subsample=1.0, reg_lambda=3.0),
    dict(max_depth=3, eta=0.3, subsample=0.9, seed=7, min_child_samples=20, n_rounds=2),
    dict(max_depth=1, eta=0.0, early_stopping_rounds=1),
]


@pytest.mark.parametrize("growth", ["depthwise", "leafwise", "symmetric"])
def test_boosted_trials_equal_single_fits(spark, rows, growth):
    base = BoostParams(n_rounds=4, growth=growth, num_leaves=6, max_bins=16, early_stopping_rounds=2, checkpoint_every=2)
    binner = Binner.fit(rows, COLS, 16)
    trials = [dataclasses.replace(base, **s) for s in SETTINGS]
    log: list = []
    together = fit_boost(rows, COLS, K, base, grp="fold", n_models=2, binner=binner, round_log=log, trials=trials)
    X = np.random.RandomState(0).normal(size=(50, 4))
    for j, p in enumerate(trials):
        own: list = []
        alone = fit_boost(rows, COLS, K, p, grp="fold", n_models=2, binner=binner, round_log=own)
        mine = [(m - 2 * j, r, loss) for m, r, loss in log if m // 2 == j]
        assert [x[:2] for x in mine] == [x[:2] for x in own]
        assert np.allclose([x[2] for x in mine], [x[2] for x in own], atol=1e-9)
        for a, b in zip(together[2 * j:2 * j + 2], alone):
            assert len(a.rounds) == len(b.rounds)
            assert np.allclose(a.predict_proba(X), b.predict_proba(X), atol=1e-9)


def test_trials_must_share_what_the_run_shares(rows):
    with pytest.raises(ValueError, match="share growth"):
        fit_boost(rows, COLS, K, BoostParams(), trials=[BoostParams(), BoostParams(max_bins=8)])


def test_forest_depths_equal_single_forests(rows):
    binner = Binner.fit(rows, COLS, 16)
    args = dict(n_trees=6, min_leaf=2, binner=binner)
    losses = oob_losses(rows, COLS, K, [2, 40, 4, 2], **args)
    assert sorted(losses) == [2, 4, 40]
    for depth, loss in losses.items():
        assert loss == pytest.approx(log_loss(oob_votes(rows, COLS, K, max_depth=depth, **args)), abs=1e-12)
    deep, same = (fit_forest(rows, COLS, K, max_depth=depth, **args) for depth in (40, 60))
    assert all((a.feat == b.feat).all() for a, b in zip(deep.shapes, same.shapes))


def test_search_logs_every_trial(spark, rows, tmp_path):
    space = {"max_depth": ("choice", [1, 2, 3]), "eta": ("quniform", 0.1, 0.5, 0.1), "reg_lambda": ("uniform", 0, 10)}
    binner = Binner.fit(rows, COLS, 16)
    objective = boost_objective(rows, COLS, K, BoostParams(n_rounds=2, max_bins=16), binner=binner)
    best, logs = [], []
    for n, together in enumerate((5, 2)):
        best.append(random_search(spark, space, 5, objective, f"{tmp_path}/log{n}", together=together))
        logs.append(read_trials(spark, f"{tmp_path}/log{n}").orderBy("iteration").collect())
    assert best[0] == best[1] and [r.iteration for r in logs[0]] == [1, 2, 3, 4, 5]
    assert [r.params for r in logs[0]] == [r.params for r in logs[1]]
    assert np.allclose([r.loss for r in logs[0]], [r.loss for r in logs[1]], atol=1e-9)
    assert min(logs[0], key=lambda r: r.loss).params["eta"] == str(best[0]["eta"]) and {r.estimators for r in logs[0]} <= {1, 2}
    forest = forest_objective(rows, COLS, K, n_trees=4, binner=binner)
    (a, n), (b, _), (c, _) = forest([{"max_depth": 3}, {"max_depth": 1}, {"max_depth": 3}])
    assert a == c != b and n == 4


def test_registered_search_has_the_rounds_of_the_script(spark, monkeypatch):
    from patrolcast.plans import q_models as q

    asked = []
    monkeypatch.setattr(q, "_boost_search", lambda spark, sf, path, space, trials, base, together: asked.append((trials, base)) or {})
    q.j5_random_search(spark, "")
    (trials, base), = asked
    assert (trials, base.n_rounds, base.early_stopping_rounds) == (50, 700, 50)


def test_a_search_keeps_losses_and_no_trees(rows):
    binner, p = Binner.fit(rows, COLS, 16), BoostParams(n_rounds=3, max_depth=2, max_bins=16, checkpoint_every=2)
    logs: list = [[], []]
    for log, keep in zip(logs, (True, False)):
        models = fit_boost(rows, COLS, K, p, grp="fold", n_models=2, binner=binner, round_log=log, keep=keep)
        assert [len(m.rounds) for m in models] == [3 * keep] * 2
    assert logs[0] == logs[1] and len(logs[0]) == 6
