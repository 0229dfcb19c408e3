"""Growth below a node of few rows happens in one task: the trees are those of level passes, with fewer passes over the rows."""
import numpy as np
import pytest

import patrolcast.models.boost as boost


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.RandomState(8)
    X = rng.randn(800, 4)
    y = (X[:, 0] * X[:, 1] > 0.2).astype(int) + (X[:, 2] + 0.3 * rng.randn(800) > 1).astype(int)
    return spark.createDataFrame([(i, int(y[i]), *map(float, X[i])) for i in range(800)],
                                 "Id long, label int, a double, b double, c double, d double").repartition(3).cache(), X


def _fit(df, monkeypatch, raw_rows, spare=16, **settings):
    """The model, and the number of passes over the rows that its trees took."""
    passes = []
    with monkeypatch.context() as mp:
        for name in ("_level", "_subtrees"):
            run = getattr(boost, name)
            mp.setattr(boost, name, lambda *a, run=run, name=name: passes.append(name) or run(*a))
        mp.setattr(boost, "RAW_ROWS", raw_rows)
        mp.setattr(boost, "SPARE_LEAVES", spare)
        model = boost.fit_boost(df, ["a", "b", "c", "d"], 3, boost.BoostParams(n_rounds=1, eta=0.5, **settings))[0]
    return model, passes


def test_deep_trees_send_their_rows_once(rows, monkeypatch):
    df, X = rows
    deep = dict(max_depth=9, min_child_weight=0.5)
    levels, many = _fit(df, monkeypatch, 0, **deep)
    assert many.count("_subtrees") == 0 and len(many) > 5
    for raw_rows, at_most in ((10 ** 6, 1), (300, 4)):
        model, passes = _fit(df, monkeypatch, raw_rows, **deep)
        assert passes.count("_subtrees") == 1 and len(passes) <= at_most
        assert np.allclose(model.predict_proba(X), levels.predict_proba(X), atol=1e-9)


def test_best_leaf_first_is_the_same_over_parts_of_a_tree(rows, monkeypatch):
    df, X = rows
    leafy = dict(growth="leafwise", num_leaves=24, max_depth=64, min_child_samples=3, min_child_weight=0.1)
    levels, _ = _fit(df, monkeypatch, 0, **leafy)
    assert max(sum(f < 0 for f in t.feat) for t in levels.rounds[0]) == 24
    for raw_rows, spare in ((10 ** 6, 16), (300, 16), (300, 2)):
        model, passes = _fit(df, monkeypatch, raw_rows, spare, **leafy)
        assert [sum(f < 0 for f in t.feat) for t in model.rounds[0]] == [sum(f < 0 for f in t.feat) for t in levels.rounds[0]]
        assert np.allclose(model.predict_proba(X), levels.predict_proba(X), atol=1e-9)
    assert passes.count("_subtrees") > 1
