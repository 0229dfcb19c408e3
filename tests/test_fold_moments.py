"""Fold moments against one fit per fold, the truncated discriminant against numpy's SVD form, and model tables."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from patrolcast.models.calibration import calibrated_fit
from patrolcast.models.gaussian import LDA, QDA, FoldMoments
from patrolcast.models.kernel import Nystroem
from patrolcast.models.linear import LinearTask, fit_ova, fit_softmax
from patrolcast.models.search import Chain, cross_val_moments, cross_val_score
from patrolcast.models.store import CHUNK, load_model, save_model
from patrolcast.operators.selection import repeated_folds

COLS = ["a", "b", "c", "d"]


def frame(spark, X, y):
    rows = [(i, None if y[i] is None else int(y[i]), *[None if np.isnan(v) else float(v) for v in X[i]]) for i in range(len(y))]
    return spark.createDataFrame(rows, "Id long, label int, " + ", ".join(f"{c} double" for c in COLS[:X.shape[1]])).repartition(5).cache()


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.RandomState(11)
    y = rng.randint(0, 3, 600)
    X = (rng.randn(3, 4) * 2)[y] + rng.randn(600, 4) * [1.0, 0.01, 200.0, 1.0] + [0, 1000, 0, -5]
    return frame(spark, X, y), X, y


@pytest.mark.parametrize("model", [LDA, QDA])
@pytest.mark.parametrize("splits", [2, 3])
def test_fold_moments_equal_one_fit_per_fold(blobs, model, splits):
    data = repeated_folds(blobs[0], splits, 2, 5, "label").cache()
    folds = ["fold_0", "fold_1"]
    want = cross_val_score(data, folds, lambda d: Chain.fit(d, COLS, lambda s: model.fit(s, COLS, 3, centered=True)), splits)
    got = cross_val_moments(data, folds, COLS, 3, model, splits)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-9)


def test_fold_moments_with_nulls_unlabelled_and_constant_columns(spark):
    """Rows with a NULL feature count for the scaler's other columns only; rows without a class for the scaler only;
    a column that varies in one fold alone is constant on the other side."""
    rng = np.random.RandomState(3)
    X, y = rng.randn(200, 4), list(rng.randint(0, 2, 200))
    X[::17, 1] = np.nan
    X[:, 2] = 7.25
    y[5], y[6] = None, -1
    fold = rng.randint(0, 2, 200)
    X[:, 3] = np.where(fold == 0, rng.randn(200), 4.0)
    df = frame(spark, X, y).join(spark.createDataFrame([(i, int(f)) for i, f in enumerate(fold)], "Id long, f int"), "Id")
    m = FoldMoments.compute(df, COLS, 2, ["f"], 2)
    for held in (0, 1):
        mean, scale, mom = m.training(0, held)
        side = X[fold != held]
        std = np.nanstd(side, axis=0)
        assert np.allclose(mean, np.nanmean(side, axis=0))
        assert np.allclose(scale, np.where(std > 1e-9, std, 1.0))
        known = np.array([v is not None and v >= 0 for v in y])
        for k in (0, 1):
            rows = (fold != held) & known & np.array([v == k for v in y]) & ~np.isnan(X).any(axis=1)
            Z = (X[rows] - mean) / scale
            assert mom.n[k] == rows.sum()
            assert np.allclose(mom.mean[k], Z.mean(0))
            assert np.allclose(mom.covariance(k), np.cov(Z.T), atol=1e-9)
    assert all(np.isfinite(s) for _, _, s in cross_val_moments(df, ["f"], COLS, 2, LDA))


def svd_form(X, y, K, tol=1e-4):
    """Log densities from the singular values of each class's centred rows, those up to ``tol`` of the largest cut."""
    L, ranks = np.empty((len(X), K)), []
    for k in range(K):
        own = X[y == k]
        _, S, Vt = np.linalg.svd(own - own.mean(0), full_matrices=False)
        keep = S > tol * S[0]
        var = S[keep] ** 2 / (len(own) - 1)
        Z = (X - own.mean(0)) @ Vt[keep].T
        L[:, k] = -0.5 * (np.log(var).sum() + (Z * Z / var).sum(1)) + np.log((y == k).mean())
        ranks.append(int(keep.sum()))
    L = np.exp(L - L.max(1, keepdims=True))
    return L / L.sum(1, keepdims=True), ranks


def scores(model, df):
    return np.array([r.probability for r in model.transform(df, keep=("Id",)).orderBy("Id").collect()])


def test_rank_deficient_discriminant_equals_svd_form(spark):
    rng = np.random.RandomState(1)
    y = rng.randint(0, 3, 400)
    Z = (rng.randn(3, 2) * 2)[y] + rng.randn(400, 2) * np.array([[1, 0.3], [0.5, 2], [1, 1]])[y]
    X = np.column_stack([Z, Z @ [0.6, 0.8], Z @ [-2.0, 1.0]])
    df = frame(spark, X, y)
    model = QDA.fit(df, COLS, 3)
    P, ranks = svd_form(X, y, 3)
    assert model.ranks.tolist() == ranks == [2, 2, 2]
    assert np.allclose(scores(model, df), P, atol=1e-6)
    # and the density on the two columns that span the four
    two = QDA.fit(df, COLS[:2], 3)
    assert np.allclose(scores(model, df), scores(two, df), atol=1e-6)


def test_full_rank_discriminant_equals_svd_form(blobs):
    df, X, y = blobs
    scaled = (X - X.mean(0)) / X.std(0)
    P, ranks = svd_form(scaled, y, 3)
    model = Chain.fit(df, COLS, lambda s: QDA.fit(s, COLS, 3, centered=True))
    assert model.model.ranks.tolist() == ranks
    assert np.allclose(scores(model, df), P, atol=1e-7)


def test_class_without_spread_borrows_the_pooled_variance(spark):
    """A class with one constant column, a class of one row and a class without rows: finite, no class wins by its missing axes."""
    rng = np.random.RandomState(2)
    y = np.array([0] * 150 + [1] * 150 + [2])
    X = rng.randn(301, 2) + np.where(y == 1, 3.0, 0.0)[:, None]
    X[y == 1, 1] = 3.0
    df = frame(spark, X, y)
    model = QDA.fit(df, COLS[:2], 4)
    assert model.ranks.tolist() == [2, 1, 0, 0]
    P = scores(model, df)
    assert np.isfinite(P).all() and np.allclose(P.sum(1), 1) and not P[:, 3].any()
    assert (P[:150].argmax(1) == 0).mean() > 0.9 and (P[150:300].argmax(1) == 1).mean() > 0.9
    # all classes have a density over both axes, so far rows decide by distance in both
    assert all((s > 0).all() and len(s) == 2 for s in model.scales)


def test_no_spread_at_all(spark):
    df = frame(spark, np.ones((20, 2)), np.array([0] * 15 + [1] * 5))
    P = scores(QDA.fit(df, COLS[:2], 2), df)
    assert np.allclose(P, [0.75, 0.25])


def test_model_tables_reload(spark, blobs, tmp_path):
    df = blobs[0]
    ny = Nystroem.fit(df, COLS, gamma=0.1, n_components=280)  # its square root takes more than one row
    assert ny.normalization.size > CHUNK
    hinge = LinearTask("hinge", alpha=1e-2)
    models = {
        "lda": LDA.fit(df, COLS, 3), "qda": Chain.fit(df, COLS, lambda s: QDA.fit(s, COLS, 3, centered=True)),
        "log": fit_ova(df, COLS, 3, LinearTask("log", alpha=1e-2, class_weight="balanced")),
        "huber": fit_ova(df, COLS, 3, LinearTask("modified_huber", alpha=1e-2, fit_intercept=False)),
        "softmax": fit_softmax(df, COLS, 3), "hinge": calibrated_fit(df, COLS, 3, hinge),
        "rbf": calibrated_fit(df, COLS, 3, hinge, featurize=ny, dim=ny.dim, standardize=False),
    }
    for name, m in models.items():
        save_model(spark, m, str(tmp_path / name))
        again = load_model(spark, str(tmp_path / name))
        assert np.array_equal(scores(m, df), scores(again, df)), name
    assert load_model(spark, str(tmp_path / "hinge")).members[0].task == models["hinge"].members[0].task
    rbf = load_model(spark, str(tmp_path / "rbf"))
    assert rbf.members[0].featurize is rbf.members[1].featurize
    with pytest.raises(TypeError):
        save_model(spark, object(), str(tmp_path / "none"))
