"""Model invariants and closed-form checks on small data."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from patrolcast.models.boost import BoostParams, fit_boost
from patrolcast.models.calibration import calibrated_fit
from patrolcast.models.gaussian import LDA, QDA, ClassMoments
from patrolcast.models.kernel import Nystroem
from patrolcast.models.linear import LinearTask, fit_ova, fit_tasks, loss_grad
from patrolcast.models.prior import ClassPrior
from patrolcast.operators.selection import log_loss


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.RandomState(7)
    K, d, n = 3, 4, 900
    y = rng.randint(0, K, n)
    centers = rng.randn(K, d) * 2
    X = centers[y] + rng.randn(n, d) * np.array([1.0, 0.5, 2.0, 1.0])
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "Id long, label int, a double, b double, c double, d double").repartition(5)
    return df.cache(), X, y, ["a", "b", "c", "d"], K


def probs(model, df, cols):
    rows = model.transform(df, keep=("Id", "label")).orderBy("Id").collect()
    return np.array([r.probability for r in rows])


def test_class_moments_match_numpy(blobs):
    df, X, y, cols, K = blobs
    m = ClassMoments.compute(df, cols, K)
    for k in range(K):
        assert m.n[k] == (y == k).sum()
        assert np.allclose(m.mean[k], X[y == k].mean(0))
        assert np.allclose(m.covariance(k), np.cov(X[y == k].T), atol=1e-9)


def test_lda_matches_closed_form(blobs):
    df, X, y, cols, K = blobs
    P = probs(LDA.fit(df, cols, K), df, cols)
    mus = np.array([X[y == k].mean(0) for k in range(K)])
    Sw = sum(((X[y == k] - mus[k]).T @ (X[y == k] - mus[k])) for k in range(K)) / (len(y) - K)
    inv = np.linalg.inv(Sw)
    pri = np.bincount(y) / len(y)
    Z = X @ inv @ mus.T - 0.5 * np.einsum("kd,de,ke->k", mus, inv, mus) + np.log(pri)
    Z = np.exp(Z - Z.max(1, keepdims=True))
    assert np.allclose(P, Z / Z.sum(1, keepdims=True), atol=1e-8)


def test_qda_matches_closed_form(blobs):
    df, X, y, cols, K = blobs
    P = probs(QDA.fit(df, cols, K), df, cols)
    L = np.zeros((len(y), K))
    for k in range(K):
        mu, C = X[y == k].mean(0), np.cov(X[y == k].T)
        D = X - mu
        L[:, k] = -0.5 * (np.linalg.slogdet(C)[1] + np.einsum("nd,de,ne->n", D, np.linalg.inv(C), D)) + np.log((y == k).mean())
    L = np.exp(L - L.max(1, keepdims=True))
    assert np.allclose(P, L / L.sum(1, keepdims=True), atol=1e-7)


def test_probabilities_are_distributions_and_beat_prior(blobs):
    df, X, y, cols, K = blobs
    prior = log_loss(ClassPrior.fit(df, K).transform(df))
    for model in (LDA.fit(df, cols, K), fit_ova(df, cols, K, LinearTask("log", alpha=1e-3)),
                  calibrated_fit(df, cols, K, LinearTask("hinge", alpha=1e-2)),
                  fit_boost(df, cols, K, BoostParams(n_rounds=3, max_depth=3))[0]):
        scored = model.transform(df, keep=("Id", "label"))
        P = np.array([r.probability for r in scored.collect()])
        assert np.all((P >= 0) & (P <= 1))
        assert np.allclose(P.sum(1), 1.0, atol=1e-9)
        assert log_loss(scored) < prior


def test_logistic_gradient_vanishes_at_optimum(blobs):
    df, X, y, cols, K = blobs
    lam = 1e-2
    fitted = fit_ova(df, cols, K, LinearTask("log", alpha=lam), max_iter=300, tol=1e-12).members[0]
    Xs = (X - fitted.mean) / fitted.scale
    Y = np.where(y[:, None] == np.arange(K), 1.0, -1.0)
    Z = Xs @ fitted.W.T + fitted.b
    _, dl = loss_grad("log", Y * Z)
    G = Y * dl
    gw = G.T @ Xs / len(y) + lam * fitted.W
    gb = G.sum(0) / len(y)
    assert np.abs(gw).max() < 1e-5 and np.abs(gb).max() < 1e-5


def test_shared_tasks_equal_separate_fits(blobs):
    df, X, y, cols, K = blobs
    data = df.withColumn("grp", (F.col("Id") % 2).cast("int"))
    tasks = [LinearTask("log", alpha=1e-2, train_groups=[0]), LinearTask("squared_hinge", C=1.0, train_groups=[1])]
    together = fit_tasks(data, cols, K, tasks, 2, max_iter=200, tol=1e-10)
    alone = fit_tasks(data, cols, K, [tasks[1]], 2, max_iter=200, tol=1e-10)
    assert np.allclose(together[1].W, alone[0].W, atol=1e-6)


def test_boost_single_stump_by_hand(spark):
    # two classes, one feature, one round, depth 1, eta 1: leaf = -G/(H+lambda)
    rows = [(i, int(i >= 6), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "Id long, label int, x double")
    m = fit_boost(df, ["x"], 2, BoostParams(n_rounds=1, max_depth=1, eta=1.0, reg_lambda=1.0,
                                            min_child_weight=0.0, max_bins=16))[0]
    t = m.rounds[0][1]     # tree of class 1
    assert t.feat[0] == 0
    # margins start at 0: p = 0.5, g = p - y, h = 0.5 ; left = rows 0..5 (y=0), right = 6..9 (y=1)
    left, right = t.value[t.left[0]], t.value[t.right[0]]
    assert left == pytest.approx(-(6 * 0.5) / (6 * 0.5 + 1.0))
    assert right == pytest.approx(-(4 * -0.5) / (4 * 0.5 + 1.0))


def test_boost_partition_count_independent(blobs):
    df, X, y, cols, K = blobs
    p = BoostParams(n_rounds=2, max_depth=3)
    a = fit_boost(df.repartition(2), cols, K, p)[0]
    b = fit_boost(df.repartition(7), cols, K, p, binner=a.binner)[0]
    assert np.allclose(a.predict_proba(X), b.predict_proba(X), atol=1e-9)


def test_nystroem_reproduces_kernel_on_landmarks(blobs):
    df, X, y, cols, K = blobs
    ny = Nystroem.fit(df, cols, gamma=0.1, n_components=50)
    L = ny.landmarks * ny.scale + ny.mean
    Phi = ny(L)
    Kmm = np.exp(-0.1 * ((ny.landmarks[:, None, :] - ny.landmarks[None, :, :]) ** 2).sum(-1))
    assert np.allclose(Phi @ Phi.T, Kmm, atol=1e-6)


def test_same_seed_same_boosted_model(blobs):
    df, X, y, cols, K = blobs
    p = BoostParams(n_rounds=2, max_depth=3, subsample=0.7, colsample=0.5, seed=11)
    a = fit_boost(df, cols, K, p)[0]
    b = fit_boost(df.repartition(3), cols, K, p, binner=a.binner)[0]
    assert np.allclose(a.predict_proba(X), b.predict_proba(X), atol=1e-12)


def test_platt_on_separable_toy_is_monotone_and_sharp(spark):
    rng = np.random.RandomState(5)
    n = 600
    y = rng.randint(0, 2, n)
    X = np.c_[np.where(y == 1, 2.0, -2.0) + 0.3 * rng.randn(n), rng.randn(n)]
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "Id long, label int, a double, b double")
    model = calibrated_fit(df, ["a", "b"], 2, LinearTask("hinge", alpha=1e-2))
    for m in model.members:
        assert m.calib[1, 0] > 0          # larger margin -> larger probability of the class
    P = model.predict_proba(X)
    assert (P.argmax(1) == y).mean() > 0.99
    assert log_loss(model.transform(df, keep=("Id", "label"))) < 0.1


def test_fitted_state_ignores_scored_rows(spark):
    from patrolcast.operators.encode import StandardScaler, Vocabulary
    train = spark.createDataFrame([(1, "A", 1.0), (2, "B", 3.0)], "Id long, c string, x double")
    test = spark.createDataFrame([(3, "C", 100.0)], "Id long, c string, x double")
    sc = StandardScaler.fit(train, ["x"])
    voc = Vocabulary.fit(train, "c")
    out = voc.transform(sc.transform(test)).first()
    assert sc.mean == [2.0] and sc.std == [1.0]
    assert out.x == pytest.approx(98.0) and out.label == -1   # unseen level -> -1


def _grow_best_first(X, g, h, num_leaves, lam, min_samples):
    """Plain best-leaf-first growth on integer features: the row sets of the leaves."""
    def best(rows):
        G, H, top = g[rows].sum(), h[rows].sum(), (0.0, None)
        for f in range(X.shape[1]):
            for cut in np.unique(X[rows, f])[:-1]:
                left = X[rows, f] <= cut
                if min(left.sum(), (~left).sum()) < min_samples:
                    continue
                GL, HL = g[rows][left].sum(), h[rows][left].sum()
                gain = 0.5 * (GL**2 / (HL + lam) + (G - GL)**2 / (H - HL + lam) - G**2 / (H + lam))
                if gain > top[0] + 1e-9:
                    top = (gain, (rows[left], rows[~left]))
        return top
    open_ = [(*best(np.arange(len(X))), np.arange(len(X)))]
    while len(open_) < num_leaves:
        i = max(range(len(open_)), key=lambda j: open_[j][0])
        if open_[i][1] is None:
            break
        _, (a, b), _ = open_.pop(i)
        open_ += [(*best(a), a), (*best(b), b)]
    return sorted(tuple(rows.tolist()) for *_, rows in open_)


@pytest.mark.parametrize("num_leaves", [2, 4, 7, 12])
def test_leafwise_growth_splits_the_best_leaf_first(spark, num_leaves):
    from patrolcast.models.boost import descend
    rng = np.random.RandomState(11)
    X = rng.randint(0, 12, size=(400, 3)).astype(float)
    score = np.where(X[:, 0] > 7, 3.0 * (X[:, 1] > 5) - 1.5 + 2.0 * (X[:, 2] > 9) * (X[:, 1] <= 5), 0.15 * (X[:, 2] > 4))
    y = (rng.rand(400) < 1 / (1 + np.exp(-score))).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), *map(float, X[i])) for i in range(400)], "Id long, label int, a double, b double, c double")
    m = fit_boost(df, ["a", "b", "c"], 2, BoostParams(n_rounds=1, growth="leafwise", num_leaves=num_leaves, max_depth=64, eta=1.0,
                                                      reg_lambda=1.0, reg_alpha=0.0, gamma=0.0, min_child_weight=0.0, min_child_samples=5))[0]
    tree = m.rounds[0][1]
    at = descend(tree.arrays(), m.binner.bins(X))
    got = sorted(tuple(np.flatnonzero(at == n).tolist()) for n in np.unique(at))
    assert got == _grow_best_first(X, 0.5 - y, np.full(400, 0.5), num_leaves, 1.0, 5)


@pytest.mark.parametrize("loss,penalty", [("log", "l2"), ("log", "l1"), ("modified_huber", "l2"), ("squared_hinge", "l2"), ("hinge", "l2")])
def test_linear_fits_reach_a_stationary_point(blobs, loss, penalty):
    """No small step lowers the objective of a converged fit by more than the tolerance allows."""
    from patrolcast.models.linear import LinearTask, fit_tasks, loss_grad
    df, _, _, cols, K = blobs
    df = df.withColumn("grp", F.lit(0))
    (m,) = fit_tasks(df, cols, K, [LinearTask(loss=loss, penalty=penalty, alpha=1e-2)], tol=1e-7)
    assert m.converged
    rows = df.select(*cols, "label").collect()
    X = (np.array([[r[c] for c in cols] for r in rows], dtype=float) - m.mean) / m.scale
    Y = np.where(np.array([r["label"] for r in rows])[:, None] == np.arange(K), 1.0, -1.0)

    def objective(W, b):
        v = loss_grad(loss, Y * (X @ W.T + b), m.task.mu_final)[0].sum() / len(X)
        return v + (0.5 * 1e-2 * (W * W).sum() if penalty == "l2" else 1e-2 * np.abs(W).sum())

    at = objective(m.W, m.b)
    rng = np.random.RandomState(0)
    for size in (1e-1, 1e-2, 1e-3):
        for _ in range(40):
            assert objective(m.W + size * rng.randn(*m.W.shape), m.b + size * rng.randn(*m.b.shape)) > at - 1e-4 * max(1.0, at)


def test_cut_fits_are_flagged(blobs):
    from patrolcast.models.linear import LinearTask, fit_tasks
    df, _, _, cols, K = blobs
    with pytest.warns(RuntimeWarning, match="limit of 2 passes"):
        (m,) = fit_tasks(df.withColumn("grp", F.lit(0)), cols, K, [LinearTask(loss="log", alpha=1e-4)], max_iter=2)
    assert not m.converged and m.n_iter == 2


def test_models_survive_the_table_form(spark, tmp_path):
    from patrolcast.models.gaussian import LDA, QDA
    from patrolcast.models.prior import ClassPrior
    from patrolcast.models.search import Chain
    from patrolcast.models.store import load_model, save_model
    rng = np.random.RandomState(2)
    rows = [(i, i % 3, *map(float, rng.randn(2) + i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, "Id long, label int, a double, b double")
    for i, m in enumerate((LDA.fit(df, ["a", "b"], 3), QDA.fit(df, ["a", "b"], 3),
                           Chain.fit(df, ["a", "b"], lambda d: QDA.fit(d, ["a", "b"], 3, centered=True)), ClassPrior.fit(df, 3))):
        save_model(spark, m, str(tmp_path / str(i)))
        again = load_model(spark, str(tmp_path / str(i)))
        p = [[r.probability for r in x.transform(df).orderBy("Id").collect()] for x in (m, again)]
        assert p[0] == p[1]


def test_rows_without_a_class_do_not_change_a_fit(blobs):
    """NULL and unseen labels (-1) are left out of every fit and of the loss; scoring keeps the rows."""
    from patrolcast.models.calibration import calibrated_fit
    from patrolcast.models.gaussian import LDA
    from patrolcast.models.linear import LinearTask, fit_ova, fit_softmax
    from patrolcast.models.prior import ClassPrior
    from patrolcast.operators.selection import log_loss
    df, _, _, cols, K = blobs
    odd = df.limit(40).select((F.col("Id") + 10**6).alias("Id"), F.when(F.col("Id") % 2 == 0, F.lit(-1)).cast("int").alias("label"),
                              *[(F.col(c) * 5).alias(c) for c in cols])
    more = df.unionByName(odd)
    first = fit_boost(df, cols, K, BoostParams(n_rounds=2, max_depth=3))[0]
    fits = [lambda d: fit_boost(d, cols, K, BoostParams(n_rounds=2, max_depth=3), binner=first.binner)[0],
            lambda d: fit_ova(d, cols, K, LinearTask(loss="log", alpha=1e-2)), lambda d: fit_softmax(d, cols, K, C=1.0),
            lambda d: calibrated_fit(d, cols, K, LinearTask(loss="squared_hinge", alpha=1e-2)), lambda d: LDA.fit(d, cols, K)]
    for fit in fits:
        a, b = fit(df), fit(more)
        assert np.allclose(probs(a, df, cols), probs(b, df, cols), atol=1e-6)
        scored = b.transform(more, keep=("Id", "label"))
        assert scored.count() == more.count()
        assert abs(log_loss(scored) - log_loss(a.transform(df, keep=("Id", "label")))) < 1e-6
    assert ClassPrior.fit(more, K).probs == ClassPrior.fit(df, K).probs


def test_margins_and_probabilities_come_from_one_map(spark):
    from pyspark.sql import functions as F

    from patrolcast.models.base import softmax
    from patrolcast.models.boost import Binner, BoostModel, BoostParams, Tree

    trees = [Tree([0, -1, -1], [0] * 3, [1, -1, -1], [2, -1, -1], [0.0, float(k), -0.5 * k], [0, 1, 1]) for k in range(3)]
    model = BoostModel(["a"], Binner(["a"], [[0.5]]), 3, BoostParams(), [trees])
    df = spark.range(0, 20).select(F.col("id").alias("Id"), (F.col("id") % 2).cast("double").alias("a"))
    got = model.transform(df, output="both")
    assert got.columns == ["Id", "probability", "rawPrediction"]
    for r in got.collect():
        assert r.rawPrediction == ([0.0, 1.0, 2.0] if r.Id % 2 == 0 else [0.0, -0.5, -1.0])
        assert np.allclose(r.probability, softmax(np.array([r.rawPrediction]))[0])
