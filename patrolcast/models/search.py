"""Model selection on Spark: J2 cross-validated scores, J3 grid search (linear
tasks share passes), J4 boosting CV, J5 seeded random search with a trial
log (A4), J9 chained fits (scaler -> model, refitted inside each fold)."""

from __future__ import annotations

import dataclasses
import itertools
import json
from dataclasses import dataclass
from typing import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import SEED
from ..operators.encode import StandardScaler
from ..operators.selection import log_loss, rank_trials, stratified_folds
from ..sources.sinks import append_trials
from .base import arrow_matrix, arrow_vector, labelled, packed_rows, partial_sums
from .boost import Binner, BoostParams, fit_boost
from .calibration import platt
from .forest import oob_losses
from .gaussian import FoldMoments
from .linear import CHUNK, MAX_PASSES, LinearTask, Stack, fit_tasks, group_stats


@dataclass
class Chain:
    """A scaler fitted on the training rows, then a model on the scaled rows."""
    cols: list
    scaler: StandardScaler
    model: object

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str], fit_model: Callable[[DataFrame], object]) -> "Chain":
        sc = StandardScaler.fit(df, cols)
        return cls(list(cols), sc, fit_model(sc.transform(df)))

    def predict_proba(self, X: np.ndarray) -> np.ndarray:
        """For a model that scores matrices."""
        scale = np.array([s if s and s > 0 else 1.0 for s in self.scaler.std], dtype=float)
        return self.model.predict_proba((X - np.array(self.scaler.mean, dtype=float)) / scale)

    def transform(self, df: DataFrame, keep=("Id",)) -> DataFrame:
        return self.model.transform(self.scaler.transform(df), keep=keep)


def cross_val_score(df: DataFrame, fold_cols: list[str], fit: Callable[[DataFrame], object],
                    n_splits: int = 2, label: str = "label") -> list[tuple[int, int, float]]:
    """``(repeat, fold, -log_loss)`` per held-out fold; ``fit`` refits the whole chain."""
    out = []
    for r, fc in enumerate(fold_cols):
        for f in range(n_splits):
            model = fit(df.filter(F.col(fc) != f))
            held = model.transform(df.filter(F.col(fc) == f), keep=("Id", label))
            out.append((r, f, -log_loss(held, label=label)))
    return out


def cross_val_moments(df: DataFrame, fold_cols: list[str], cols: list[str], n_classes: int, model,
                      n_splits: int = 2, label: str = "label") -> list[tuple[int, int, float]]:
    """J2 for models that follow from class moments (``model``: LDA or QDA), scaler and model refitted in each fold.

    Beside the aggregate that finds the shift there are two scans, whatever the number of repeats and folds: one sums the
    moments of all folds, one scores the held-out rows of all. Returns ``(repeat, fold, -log_loss)``.
    """
    moments = FoldMoments.compute(df, cols, n_classes, fold_cols, n_splits, label)
    fits = []
    for r in range(len(fold_cols)):
        for f in range(n_splits):
            mean, scale, scaled = moments.training(r, f)
            fits.append((r, f, mean, scale, model.from_moments(scaled)))

    def part(batch):
        X = arrow_matrix(batch, cols)
        y = batch.column(batch.schema.names.index(label)).fill_null(-1).to_numpy(zero_copy_only=False)
        folds = [arrow_vector(batch, c, np.int64) for c in fold_cols]
        out = np.zeros((len(fits), 2))
        for j, (r, f, mean, scale, m) in enumerate(fits):
            rows = np.flatnonzero((folds[r] == f) & (y >= 0))
            if len(rows):
                p = m.predict_proba((X[rows] - mean) / scale)[np.arange(len(rows)), y[rows]]
                out[j] = -np.log(np.clip(p, 1e-15, 1 - 1e-15)).sum(), len(rows)
        return out.ravel()

    v = partial_sums(df.select(*[F.col(f"`{c}`") for c in cols], label, *fold_cols), 2 * len(fits), part).reshape(-1, 2)
    return [(r, f, float(-loss / n) if n else float("nan")) for (r, f, *_), (loss, n) in zip(fits, v)]


def grid_search_linear(spark: SparkSession, df: DataFrame, cols: list[str], n_classes: int,
                       grid: list[LinearTask], n_splits: int = 2, calibrated: bool = False, cv_inner: int = 2,
                       label: str = "label", key: str = "Id", seed: int = SEED, max_iter: int = MAX_PASSES,
                       tol: float = 1e-4, feature_map: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """Every parameter set x fold (x inner calibration fold) fitted in shared passes.

    Returns ``(params, mean_test_score, passes, converged, rank_test_score)`` with scores =
    -log loss on the held-out fold, averaged over folds, the passes of the longest fit of the
    setting, and whether all of its fits reached the tolerance; no refit. ``feature_map`` fits a map on
    the rows of an outer training fold (scaler and landmarks never see the held-out fold); the map
    replaces the scaler.
    """
    data = stratified_folds(labelled(df, label), n_splits, seed, label, key=key, out="fold")
    G = n_splits
    if calibrated:
        data = stratified_folds(data, cv_inner, seed + 1, label, extra_strata=["fold"], key=key, out="inner")
        data = data.withColumn("grp", F.col("fold") * cv_inner + F.col("inner"))
        G = n_splits * cv_inner
    else:
        data = data.withColumn("grp", F.col("fold"))
    inner = cv_inner if calibrated else 1
    maps = None if feature_map is None else [
        feature_map(data.where(F.floor(F.col("grp") / inner) != f)) for f in range(n_splits)]
    data = packed_rows(data, cols, label, "grp", key)
    try:
        dim = maps[0].dim if maps else None
        stats = group_stats(data, cols, n_classes, G, label, "grp", maps, dim)
        tasks, index = [], []
        for p, base in enumerate(grid):
            for f in range(n_splits):
                if calibrated:
                    for i in range(cv_inner):
                        groups = [fo * cv_inner + ii for fo in range(n_splits) for ii in range(cv_inner)
                                  if fo != f and ii != i]
                        tasks.append(dataclasses.replace(base, train_groups=groups, feature_map=f if maps else 0))
                        index.append((p, f, i))
                else:
                    tasks.append(dataclasses.replace(base, train_groups=[fo for fo in range(n_splits) if fo != f],
                                                     feature_map=f if maps else 0))
                    index.append((p, f, 0))
        fitted = fit_tasks(data, cols, n_classes, tasks, G, label, "grp", max_iter, tol, stats, maps, dim, maps is None)
        if calibrated:
            calib = [[fo * cv_inner + i for fo in range(n_splits) if fo != f] for (_, f, i) in index]
            platt(data, n_classes, fitted, calib, G, stats)
        # scoring pass: log loss of every (param, fold) on its held-out rows
        keys = sorted({(p, f) for p, f, _ in index})
        of_fold = [[j for j, (_, held, _) in enumerate(index) if held == f] for f in range(n_splits)]
        sent = spark.sparkContext.broadcast([(Stack([fitted[j] for j in own]), own) for own in of_fold])

        def part(g, y, X, whole, out):
            f = g // inner
            stack, own = sent.value[f]
            for first in range(0, len(y), CHUNK):
                ys = y[first:first + CHUNK]
                P: dict = {}
                for j, Z in stack.margins(X[first:first + CHUNK]):
                    k = keys.index((index[own[j]][0], f))
                    P[k] = P.get(k, 0.0) + fitted_of[own[j]].probabilities_of(Z)[np.arange(len(ys)), ys] / inner
                for k, p in P.items():
                    out[k] += -np.log(np.clip(p, 1e-15, 1 - 1e-15)).sum()
                    out[len(keys) + k] += len(ys)

        fitted_of = [dataclasses.replace(m, featurize=None, W=np.zeros((n_classes, 0))) for m in fitted]  # without the maps
        v = data.sums(2 * len(keys), part)
        sent.unpersist()
    finally:
        data.unpersist()
    per = v[:len(keys)] / np.maximum(v[len(keys):], 1)
    rows = []
    for p, base in enumerate(grid):
        scores = [-per[j] for j, k in enumerate(keys) if k[0] == p]
        own = [m for (q, _, _), m in zip(index, fitted) if q == p]
        rows.append((json.dumps(base.describe(), sort_keys=True), float(np.mean(scores)),
                     max(m.n_iter for m in own), all(m.converged for m in own)))
    trials = spark.createDataFrame(rows, "params string, mean_test_score double, passes int, converged boolean")
    return rank_trials(trials)


def linear_grid(loss: str, **axes) -> list[LinearTask]:
    """All combinations of the given axes (lists) as tasks."""
    names = sorted(axes)
    return [LinearTask(loss=loss, **dict(zip(names, combo))) for combo in itertools.product(*[axes[n] for n in names])]


def boost_cv(spark: SparkSession, df: DataFrame, cols: list[str], n_classes: int, params: BoostParams,
             n_folds: int = 2, label: str = "label", key: str = "Id", seed: int = SEED, binner: Binner | None = None) -> DataFrame:
    """``(fold, round, loss)`` hold-out loss per boosting round, all folds in shared passes.
    ``binner``: given cut points (else quantiles of the features)."""
    data = stratified_folds(df, n_folds, seed, label, key=key, out="fold")
    log: list = []
    fit_boost(data, cols, n_classes, params, label=label, grp="fold", n_models=n_folds, round_log=log, binner=binner, keep=False)
    return spark.createDataFrame([(int(m), int(r), float(l)) for m, r, l in log], "fold int, round int, loss double")


# --- J5 random search ---------------------------------------------------------

def sample_space(space: dict, rng: np.random.RandomState) -> dict:
    """Draw one setting: ("choice", [...]), ("quniform", lo, hi, q), ("uniform", lo, hi) or a constant."""
    out = {}
    for k in sorted(space):
        spec = space[k]
        if isinstance(spec, tuple) and spec and spec[0] == "choice":
            out[k] = spec[1][rng.randint(len(spec[1]))]
        elif isinstance(spec, tuple) and spec and spec[0] == "quniform":
            _, lo, hi, q = spec
            out[k] = float(np.round(rng.uniform(lo, hi) / q) * q)
        elif isinstance(spec, tuple) and spec and spec[0] == "uniform":
            out[k] = float(rng.uniform(spec[1], spec[2]))
        else:
            out[k] = spec
    return out


def random_search(spark: SparkSession, space: dict, n_trials: int, objective: Callable[[list[dict]], list[tuple]],
                  log_path: str, seed: int = SEED, together: int = 10) -> dict:
    """Seeded sampling of ``space``, ``together`` settings at a time fitted in shared passes on Spark by ``objective``,
    which returns ``(loss, estimators)`` for each; one row ``(loss, params, iteration, estimators)`` a trial goes into the trial log (A4).
    Returns the best setting (lowest loss, the first of equals). The settings do not depend on ``together``."""
    rng = np.random.RandomState(seed)
    settings = [sample_space(space, rng) for _ in range(n_trials)]
    best = None
    for first in range(0, n_trials, together):
        block = settings[first:first + together]
        results = objective(block)
        append_trials(spark, log_path, [(loss, p, first + i + 1, n) for i, (p, (loss, n)) in enumerate(zip(block, results))])
        for p, (loss, _) in zip(block, results):
            if best is None or loss < best[0]:
                best = (loss, p)
    return best[1] if best else {}


def boost_objective(df: DataFrame, cols: list[str], n_classes: int, base: BoostParams, n_folds: int = 2, label: str = "label",
                    grp: str = "fold", binner: Binner | None = None) -> Callable[[list[dict]], list[tuple]]:
    """Cross-validated loss of the best round, and its number, of several booster settings (the fields of ``base`` that a
    setting names are replaced): every trial and fold in the same passes over rows with their fold in ``grp``."""
    binner = binner or Binner.fit(df, cols, base.max_bins)

    def objective(settings: list[dict]) -> list[tuple]:
        log: list = []
        fit_boost(df, cols, n_classes, base, label, grp, n_folds, binner, log, keep=False,
                  trials=[dataclasses.replace(base, **p) for p in settings])
        out = []
        for j in range(len(settings)):
            rounds = {}
            for m, r, loss in log:
                if m // n_folds == j:
                    rounds.setdefault(r, []).append(loss)
            means = {r: float(np.mean(v)) for r, v in rounds.items()}
            best = min(means, key=means.get)
            out.append((means[best], best + 1))
        return out

    return objective


def forest_objective(df: DataFrame, cols: list[str], n_classes: int, n_trees: int = 100, min_leaf: int = 1, label: str = "label",
                     binner: Binner | None = None) -> Callable[[list[dict]], list[tuple]]:
    """Out-of-bag loss of forests that differ in ``max_depth``, all cut from one growth."""
    def objective(settings: list[dict]) -> list[tuple]:
        losses = oob_losses(df, cols, n_classes, [p["max_depth"] for p in settings], n_trees, min_leaf, label, binner=binner)
        return [(losses[p["max_depth"]], n_trees) for p in settings]

    return objective
