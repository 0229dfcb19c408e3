"""One-scan report against each model scored alone; vocabularies as tables; boosting CV on given cuts."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from patrolcast.models.boost import BoostParams, fit_boost
from patrolcast.models.calibration import calibrated_fit, calibrated_fits
from patrolcast.models.forest import fit_forest
from patrolcast.models.gaussian import LDA
from patrolcast.models.linear import LinearTask
from patrolcast.models.prior import ClassPrior
from patrolcast.models.report import loss_report
from patrolcast.models.search import Chain
from patrolcast.operators.encode import Vocabulary
from patrolcast.operators.selection import log_loss

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.RandomState(4)
    y = rng.randint(0, 3, 400)
    X = (rng.randn(3, 3) * 2)[y] + rng.randn(400, 3)
    rows = [(i, int(y[i]), int(i % 2), *map(float, X[i])) for i in range(400)] + [(400, -1, 0, 0.0, 0.0, 0.0), (401, None, 1, 0.0, 0.0, None)]
    return spark.createDataFrame(rows, "Id long, label int, fold int, a double, b double, c double").repartition(4).cache()


def test_report_equals_each_model_alone(blobs):
    trn = blobs.where("fold = 0")
    models = {
        "prior": ClassPrior.fit(trn, 3), "lda": Chain.fit(trn, COLS, lambda d: LDA.fit(d, COLS, 3, centered=True)),
        "hinge": calibrated_fit(trn, COLS[:2], 3, LinearTask("hinge", alpha=1e-2)),
        "forest": fit_forest(trn, COLS, 3, n_trees=5, max_depth=4), "boost": fit_boost(trn, COLS[1:], 3, BoostParams(n_rounds=2, max_depth=3))[0],
    }
    got = loss_report(blobs, models, "fold", 3)
    for name, m in models.items():
        for fold in (0, 1):
            part = blobs.where(F.col("fold") == fold)
            alone = log_loss(m.transform(part) if name == "prior" else m.transform(part, keep=("Id", "label")))
            assert got[name, fold][0] == 200
            assert got[name, fold][1] == pytest.approx(alone, abs=1e-9)
        assert got[name, 2][0] == 0 and np.isnan(got[name, 2][1])


def test_settings_calibrated_together_equal_single_fits(blobs):
    tasks = [LinearTask("hinge", alpha=1e-2), LinearTask("squared_hinge", C=0.1, class_weight="balanced")]
    together = calibrated_fits(blobs, COLS, 3, tasks)
    for task, m in zip(tasks, together):
        alone = calibrated_fit(blobs, COLS, 3, task)
        X = np.random.RandomState(0).randn(50, 3)
        assert np.allclose(m.predict_proba(X), alone.predict_proba(X), atol=1e-6)


def test_level_table_equals_literal_codes(spark):
    """50,000 levels, a third of the rows in one of them, NULL and unseen values, a clashing column name."""
    n = 50_000
    df = spark.range(75_000).select(F.when(F.col("id") < n, F.col("id")).otherwise(7).alias("i")).select(
        F.when(F.col("i") % 1000 == 3, None).otherwise(F.concat(F.lit("é" * 2), F.hash("i").cast("string"), F.lit(" /"), F.col("i").cast("string"))).alias("name"),
        F.col("i").alias("code"))
    as_table = Vocabulary.fit(df, "name")
    assert as_table.levels is None and as_table.size == n - 50
    plain = Vocabulary.fit(df, "name", max_literal=n)
    want = {v: i for i, v in enumerate(plain.levels)}
    got = as_table.transform(df, "code")
    assert got.columns == ["name", "code"]
    rows = got.collect()
    assert len(rows) == 75_000
    assert all(r["code"] == want.get(r["name"], -1) for r in rows)
    unseen = as_table.transform(spark.createDataFrame([("new",), (None,)], "name string"), "label", base=1)
    assert [r.label for r in unseen.collect()] == [-1, -1]
    # the plan does not hold the levels
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 10_000
    with pytest.raises(ValueError):
        as_table.code()


def test_small_and_empty_vocabularies(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "name string")
    for limit in (0, 10):
        v = Vocabulary.fit(df, "name", max_literal=limit)
        assert v.size == 2
        assert sorted(r.label for r in v.transform(df).collect()) == [-1, 0, 0, 1]
    empty = Vocabulary.fit(df.where("false"), "name", max_literal=0)
    assert empty.size == 0 and {r.label for r in empty.transform(df).collect()} == {-1}


def test_report_fits_every_family_at_its_final_setting(monkeypatch):
    from types import SimpleNamespace

    from patrolcast.plans import q_models as q

    seen: dict = {}
    monkeypatch.setattr(q, "_sets", lambda fit: (["a"], ["a"], ["a"]))
    monkeypatch.setattr(q, "closed_form_models", lambda *a: {})
    monkeypatch.setattr(q, "fit_tasks", lambda *a: [None, None])
    monkeypatch.setattr(q, "calibrated_fits", lambda *a: [None] * 3)
    monkeypatch.setattr(q, "fit_softmax", lambda *a, **k: None)
    monkeypatch.setattr(q, "calibrated_fit", lambda trn, lin, n, task, **k: seen.update(alpha=task.alpha, landmarks=k["dim"]))
    monkeypatch.setattr(q, "Nystroem", SimpleNamespace(fit=lambda *a, n_components, **k: SimpleNamespace(dim=n_components)))
    monkeypatch.setattr(q, "fit_forest", lambda *a, **k: seen.update(k))
    monkeypatch.setattr(q, "fit_boost", lambda trn, cols, n, p: seen.update({p.growth: (p.n_rounds, p.max_depth, p.num_leaves)}) or [None])
    monkeypatch.setattr(q.F, "lit", lambda x: x)
    models = q._every_family(SimpleNamespace(withColumn=lambda *a: None), None, SimpleNamespace(size=3))
    assert len(models) == 11  # and the three of closed form
    assert (seen["alpha"], seen["landmarks"]) == (1e-3, 1000)
    assert (seen["n_trees"], seen["max_depth"], seen["min_leaf"]) == (1000, 17, 7)
    assert (seen["depthwise"], seen["leafwise"], seen["symmetric"]) == ((505, 12, 31), (100, 64, 150), (10_000, 6, 31))
