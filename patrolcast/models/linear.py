"""Linear classifiers: one-vs-rest margin models (K4-K8) trained together, and
the multinomial logistic regression (K3) on MLlib.

Shared one-vs-rest trainer
--------------------------
A *task* is one parameter set (loss, penalty strength, L1/L2, intercept,
class weights) fitted on one set of row groups (``grp`` column: folds, or
fold x inner-fold for calibration). Every iteration is **one** data pass that
returns the gradients of every class of every task (``partial_sums``), so a
grid of 16 settings x 2 folds costs the same number of passes as one fit.
Each task keeps its own scaler fitted on its own training rows (pipeline
semantics: the scaler never sees held-out rows). Tasks with the same training
rows share the scaled rows of a chunk, and their weights are stacked into one product. Rows are packed
into blocks of one group once (``Packed``); a pass works through a block in chunks that stay in the
processor's cache, classes by rows, losses and slopes in place (``add_loss``).

Where the tasks of one set of training rows are so little work that a pass over them takes about as long as starting a
Spark job (``ONE_TASK``), all their passes run in one Spark task (``_fit_apart``), which gathers only their own blocks; the
sets are dealt to the cores. Arithmetic and order of summation are those of a shared pass. Others share passes over all rows.

A feature map with a ``basis`` (cheap columns) and a ``root`` (features = basis x root') is never applied in
a pass: its root is folded into the weights on the driver, the pass multiplies basis columns only, and the
gradient is mapped back by the root. Tasks can have different maps (one a fold).

Objective per class k: (1/n) sum_i w_i L(y_ik z_ik) + lambda R(w_k), with
y_ik = +-1, z = w.x + b, R = 1/2 ||w||^2 (l2) or ||w||_1 (l1); the intercept
is not penalised. The loss ``softmax`` couples the classes: (1/n) sum_i w_i (logsumexp z_i - z_iy).
``alpha`` (SGD) maps to lambda directly, ``C`` (SVC) to
lambda = 1/(C n). L2 tasks are minimised by L-BFGS with Armijo backtracking, L1 tasks
by OWL-QN (its orthant-wise variant); the first step is scaled by 1/L, where L
comes from the exact largest eigenvalue of the task's standardised Gram matrix
(one pre-pass). The hinge is smoothed over a margin band of width
``mu`` (Nesterov smoothing) so the same solver applies; by continuation the
band shrinks 10x per stage from ``mu`` to ``mu_final``, each stage warm-started,
so the final objective is within mu_final/2 per row of the hinge.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Packed, labelled, map_probabilities, packed_rows, softmax, unpack

# Fits run to their tolerance; this many passes end one that does not get there (flagged, with a warning).
MAX_PASSES = 2_000
CURVATURE = {"log": 0.25, "softmax": 0.5, "modified_huber": 2.0, "squared_hinge": 2.0}
STACKED = 8  # tasks whose margins a chunk holds at once
CHUNK = 512  # rows worked on together
FLAT, FACTORS = 80.0, 8  # e^80 + 1 to the power of 8 is finite
ONE_TASK = 1_000_000_000  # rows x classes x features x fits that one Spark task passes over by itself (about 0.13 s)
ONE_TASK_BYTES = 64 << 20  # and the size of those rows


def loss_grad(loss: str, m: np.ndarray, mu: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Per-margin loss L(m) and dL/dm for margins m = y * z."""
    if loss == "log":
        return np.logaddexp(0.0, -m), -0.5 * (1.0 - np.tanh(0.5 * m))
    if loss == "modified_huber":
        h = np.maximum(0.0, 1.0 - m)
        return np.where(m >= -1, h * h, -4.0 * m), np.where(m >= -1, -2.0 * h, -4.0)
    if loss == "squared_hinge":
        h = np.maximum(0.0, 1.0 - m)
        return h * h, -2.0 * h
    if loss == "hinge":
        h = 1.0 - m
        quad = (h > 0) & (h < mu)
        val = np.where(h <= 0, 0.0, np.where(quad, h * h / (2 * mu), h - mu / 2))
        der = np.where(h <= 0, 0.0, np.where(quad, -h / mu, -1.0))
        return val, der
    raise ValueError(loss)


@dataclass
class LinearTask:
    loss: str = "log"
    alpha: float = 1e-4            # lambda; use ``from_C`` for SVC-style C
    penalty: str = "l2"
    fit_intercept: bool = True
    class_weight: str | None = None   # None or "balanced"
    train_groups: Sequence[int] | None = None  # None = every group
    C: float | None = None          # if set, lambda = 1 / (C * n_train)
    mu: float = 0.1                 # hinge smoothing band at the start
    mu_final: float = 0.01          # band after continuation (shrunk 10x per stage)
    feature_map: int = 0            # which of the given feature maps, if there are several

    def describe(self) -> dict:
        return {"loss": self.loss, "alpha": self.alpha, "C": self.C, "penalty": self.penalty,
                "fit_intercept": self.fit_intercept, "class_weight": self.class_weight}


@dataclass
class GroupStats:
    """Per group: rows, per-class rows, feature sums and Gram (shifted)."""
    n: np.ndarray        # (G,)
    nk: np.ndarray       # (G, K)
    sx: np.ndarray       # (G, d)
    sxx: np.ndarray      # (G, d, d)
    shift: np.ndarray    # (d,)

    def select(self, groups):
        g = list(range(len(self.n))) if groups is None else list(groups)
        return self.n[g].sum(), self.nk[g].sum(0), self.sx[g].sum(0), self.sxx[g].sum(0)


def _maps(featurize) -> list:
    return list(featurize) if isinstance(featurize, (list, tuple)) else [featurize]


def bounded(featurize) -> bool:
    """Feature maps that bound their rows' squared norm and have a root: no moments are needed for them."""
    return all(hasattr(m, "root") and hasattr(m, "norm_bound") for m in _maps(featurize))


def add_loss(loss: str, Z: np.ndarray, hot, w: np.ndarray | None, mu: float, hinge: np.ndarray, slope: np.ndarray) -> float:
    """Of one-vs-rest margins ``Z`` (classes x rows, changed), ``hot`` the places of the rows' own classes and row weights ``w``
    (None: all 1): the summed loss; ``slope`` receives dL/dz. Equal to ``loss_grad`` at m = y z; ``hinge`` is work space."""
    Z[hot] *= -1.0  # now -m everywhere
    if loss == "log":
        if Z.size and Z.min() > -FLAT:
            # log(1 + e^z) = z + log(1 + e^-z); one logarithm for the product of a few classes
            total = Z.sum() if w is None else Z.sum(axis=0) @ w
            np.exp(np.negative(Z, out=hinge), out=hinge)
            hinge += 1.0
            for at in range(0, len(hinge), FACTORS):
                logs = np.log(np.multiply.reduce(hinge[at:at + FACTORS], axis=0))
                total += logs.sum() if w is None else logs @ w
            np.reciprocal(hinge, out=slope)
        else:
            np.abs(Z, out=hinge)
            np.exp(np.negative(hinge, out=hinge), out=hinge)
            np.log(np.add(hinge, 1.0, out=hinge), out=hinge)
            hinge += np.maximum(Z, 0.0, out=slope)
            total = hinge.sum() if w is None else float(hinge.sum(axis=0) @ w)
            np.tanh(np.multiply(Z, 0.5, out=slope), out=slope)
            slope += 1.0
            slope *= 0.5
        if w is not None:
            slope *= w
    else:
        np.add(Z, 1.0, out=hinge)
        if loss == "hinge":
            np.divide(hinge, mu, out=slope)
            np.clip(slope, 0.0, 1.0, out=slope)
            np.multiply(slope, -mu / 2, out=Z)
            Z += hinge                                   # loss = slope (h - mu / 2 slope)
            if w is not None:
                slope *= w
            total = np.vdot(slope, Z)
        elif loss == "squared_hinge":
            np.maximum(hinge, 0.0, out=hinge)
            np.multiply(hinge, 2.0, out=slope)
            if w is not None:
                slope *= w
            total = 0.5 * np.vdot(slope, hinge)
        elif loss == "modified_huber":
            np.maximum(hinge, 0.0, out=hinge)
            np.multiply(np.minimum(hinge, 2.0, out=slope), 2.0, out=slope)
            np.multiply(slope, -0.25, out=Z)
            Z += hinge                                   # loss = 2 c (h - c / 2), c = min(h, 2)
            if w is not None:
                slope *= w
            total = np.vdot(slope, Z)
        else:
            raise ValueError(loss)
    slope[hot] *= -1.0
    return float(total)


def group_stats(df: DataFrame | Packed, cols: list[str], n_classes: int, n_groups: int, label="label",
                grp="grp", featurize=None, dim: int | None = None) -> GroupStats:
    """Per-group moments of the (optionally featurized) inputs; ``dim`` = output width of ``featurize``."""
    d, K, G = (dim or len(cols)), n_classes, n_groups
    data = df if isinstance(df, Packed) else packed_rows(df, cols, label, grp)
    counts_only = bounded(featurize)
    shift = data.shift if featurize is None else np.zeros(d)
    wide = 0 if counts_only else d

    def part(g, y, X, whole, out):
        out = out.reshape(G, K + wide + wide * wide)[g]
        out[:K] += np.bincount(y, minlength=K)
        if wide:
            X = (featurize(X) if featurize else X) - shift
            if featurize or not whole:
                X = np.nan_to_num(X)
            out[K:K + d] += X.sum(axis=0)
            out[K + d:] += (X.T @ X).ravel()

    try:
        v = data.sums(G * (K + wide + wide * wide), part).reshape(G, -1)
    finally:
        if data is not df:
            data.unpersist()
    nk = v[:, :K]
    if counts_only:
        return GroupStats(nk.sum(1), nk, np.zeros((G, 1)), np.zeros((G, 1, 1)), shift)
    return GroupStats(nk.sum(1), nk, v[:, K:K + d], v[:, K + d:].reshape(G, d, d), shift)


@dataclass
class FittedTask:
    task: LinearTask
    mean: np.ndarray     # scaler mean (raw units)
    scale: np.ndarray    # scaler std (0 -> 1)
    W: np.ndarray        # (K, d) on standardised inputs
    b: np.ndarray        # (K,)
    n_iter: int = 0
    calib: np.ndarray | None = None   # (K, 2) Platt (a, b) when calibrated
    featurize: object = None          # raw inputs -> model inputs (e.g. Nystroem map)
    converged: bool = True            # False if the pass limit ended the fit (a warning says so)

    def view(self) -> tuple:
        """Members that are equal here read the same inputs."""
        return id(self.featurize), self.mean.tobytes(), self.scale.tobytes()

    def folded(self) -> bool:
        return bounded(self.featurize) and not self.mean.any()

    def inputs(self, X: np.ndarray) -> np.ndarray:
        """What the weights multiply: scaled features, or a folded map's basis columns."""
        if self.folded():
            return self.featurize.basis(X)
        if self.featurize is not None:
            X = self.featurize(X)
        return np.nan_to_num((X - self.mean) / self.scale)

    def weights(self) -> np.ndarray:
        return self.W @ self.featurize.root if self.folded() else self.W

    def decision(self, X: np.ndarray) -> np.ndarray:
        return self.inputs(X) @ self.weights().T + self.b

    def probabilities(self, X: np.ndarray) -> np.ndarray:
        return self.probabilities_of(self.decision(X))

    def probabilities_of(self, Z: np.ndarray) -> np.ndarray:
        K = Z.shape[1]
        if self.calib is None and self.task.loss == "softmax":
            return softmax(Z)
        if self.calib is not None:
            P = 1.0 / (1.0 + np.exp(-(self.calib[:, 0] * Z + self.calib[:, 1])))
        elif self.task.loss == "log":
            P = 1.0 / (1.0 + np.exp(-Z))
        elif self.task.loss == "modified_huber":
            P = (np.clip(Z, -1, 1) + 1) / 2
        else:
            raise ValueError(f"{self.task.loss} gives margins only; calibrate it (K10)")
        s = P.sum(axis=1, keepdims=True)
        return np.where(s > 0, P / np.where(s > 0, s, 1), 1.0 / K)


class Stack:
    """The margins of several members, those of one view from shared inputs and stacked weights."""

    def __init__(self, members: list[FittedTask]):
        by: dict = {}
        for j, m in enumerate(members):
            by.setdefault(m.view(), []).append(j)
        self.views = [(members[own[0]], own, np.concatenate([members[j].weights() for j in own]),
                       np.concatenate([members[j].b for j in own])) for own in by.values()]

    def margins(self, X: np.ndarray):
        """(member number, its margins, rows x classes) for every member."""
        for first, own, W, b in self.views:
            Z = (first.inputs(X) @ W.T + b).reshape(len(X), len(own), -1)
            for at, j in enumerate(own):
                yield j, Z[:, at]


def fit_tasks(df: DataFrame | Packed, cols: list[str], n_classes: int, tasks: list[LinearTask], n_groups: int = 1,
              label: str = "label", grp: str = "grp", max_iter: int = MAX_PASSES, tol: float = 1e-4,
              stats: GroupStats | None = None, featurize=None, dim: int | None = None,
              standardize: bool = True) -> list[FittedTask]:
    """Fit every task; ``df`` must hold ``cols``, ``label`` (0..K-1) and ``grp`` (0..G-1).

    ``featurize`` maps raw input rows to model inputs inside each pass (recomputed,
    never materialised); a list of maps serves tasks by their ``feature_map``; ``standardize=False`` skips the per-task scaler;
    ``df`` may be rows that the caller holds packed.
    """
    K, d, T = n_classes, (dim or len(cols)), len(tasks)
    data = df if isinstance(df, Packed) else packed_rows(df, cols, label, grp)
    try:
        return _fit_tasks(data, cols, K, d, T, tasks, n_groups, max_iter, tol, stats, featurize, dim, standardize)
    finally:
        if data is not df:
            data.unpersist()


def _fit_tasks(data: Packed, cols, K, d, T, tasks, n_groups, max_iter, tol, stats, featurize, dim, standardize) -> list[FittedTask]:
    st = stats or group_stats(data, cols, K, n_groups, featurize=featurize, dim=dim)
    means, scales, lams, Ls, cws, masks = [], [], [], [], [], []
    for t in tasks:
        n, nk, sx, sxx = st.select(t.train_groups)
        mu_s = sx / max(n, 1)
        cov = sxx / max(n, 1) - np.outer(mu_s, mu_s)
        sd = np.sqrt(np.maximum(np.diag(cov), 0))
        scale = np.where(sd > 0, sd, 1.0)
        if bounded(featurize) and not standardize:
            mu_s, scale = np.zeros(d), np.ones(d)
            lam_max = _maps(featurize)[t.feature_map].norm_bound + (1.0 if t.fit_intercept else 0.0)
        elif standardize:
            corr = cov / np.outer(scale, scale)
            # centred, unit-variance inputs: the intercept direction is orthogonal
            lam_max = max(np.linalg.eigvalsh(corr).max(), 1.0 if t.fit_intercept else 0.0)
        else:
            # raw inputs (featurize=... gives shift 0): bound the augmented second-moment matrix
            mu_s, scale = -st.shift, np.ones(d)
            lam_max = np.linalg.eigvalsh(sxx / max(n, 1)).max() + (1.0 if t.fit_intercept else 0.0)
        means.append(mu_s + st.shift)
        scales.append(scale)
        cw = np.ones(K)
        if t.class_weight == "balanced":
            cw = np.where(nk > 0, n / (K * np.maximum(nk, 1)), 0.0)
        lam = (1.0 / (t.C * n)) if t.C is not None else t.alpha
        curv = CURVATURE.get(t.loss, 1.0 / t.mu)
        Ls.append(curv * cw.max() * lam_max + (lam if t.penalty == "l2" else 0.0))
        lams.append(lam)
        cws.append(cw)
        m = np.zeros(n_groups, dtype=bool)
        m[list(range(n_groups)) if t.train_groups is None else list(t.train_groups)] = True
        masks.append(m)
        t._n = n  # rows used for the mean
    solvers = [(_Lbfgs if t.penalty == "l2" else _OwlQn)((K, d + 1), Ls[i], lams[i], t.penalty, t.fit_intercept, tol)
               for i, t in enumerate(tasks)]
    stopped: list = []
    means_a, scales_a, cws_a, masks_a = np.array(means), np.array(scales), np.array(cws), np.array(masks)
    losses = [t.loss for t in tasks]
    mus = [t.mu for t in tasks]
    maps = _maps(featurize)
    fold_root = bounded(featurize) and not standardize
    finite = [bool(np.isfinite(m).all() and np.isfinite(s).all()) for m, s in zip(means, scales)]
    plain = [bool((c == 1.0).all()) for c in cws]           # no row weights
    sent = data.df.sparkSession.sparkContext.broadcast(maps) if fold_root else None  # once, not with every pass
    mapped, several, given = maps[0] is not None, len(maps) > 1, None if fold_root else maps
    width = K * (d + 1) + 1

    def views_of(act):
        """Tasks (places in ``act``) that see the same rows, scaled alike."""
        views: dict = {}
        for a, t in enumerate(act):
            views.setdefault((masks_a[t].tobytes(), tasks[t].feature_map), []).append((a, t))
        return views

    def scaled(X, t, whole):
        """Inputs of a task's weights, with a column of ones."""
        Xs = np.empty((len(X), d + 1))
        Xs[:, d] = 1.0
        np.divide(X - means_a[t], scales_a[t], out=Xs[:, :d])
        if mapped or not (whole and finite[t]):
            np.nan_to_num(Xs, copy=False)
        return Xs

    def add_block(g, y, X, whole, out, act, pts, mus, views, ready=False):
        """Adds to ``out`` each task's gradient and loss at ``pts`` over one block of rows (``ready``: scaled already)."""
        out = out.reshape(len(act), width)
        own_views = [(m, own) for (_, m), own in views.items() if masks_a[own[0][1]][g]]
        if not own_views:
            return
        hinge, slope = np.empty((2, K * CHUNK))
        for first in range(0, len(y), CHUNK):
            raw, ys = X[first:first + CHUNK], y[first:first + CHUNK]
            n, hot = len(ys), (ys, np.arange(len(ys)))
            work = hinge[:K * n].reshape(K, n), slope[:K * n].reshape(K, n)
            inputs: dict = {}
            for m, own in own_views:
                t0 = own[0][1]
                if ready:
                    Xs = raw
                else:
                    if m not in inputs:
                        f = (sent.value if fold_root else given)[m if several else 0]
                        inputs[m] = raw if f is None else f.basis(raw) if fold_root else f(raw)
                    if fold_root:
                        Xs = np.ones((n, d + 1))
                        Xs[:, :d] = inputs[m]
                    else:
                        Xs = scaled(inputs[m], t0, whole)
                for at in range(0, len(own), STACKED):
                    some = own[at:at + STACKED]
                    Z = pts[[a for a, _ in some]].reshape(-1, d + 1) @ Xs.T  # (tasks x classes, rows)
                    for j, (a, t) in enumerate(some):
                        z = Z[j * K:(j + 1) * K]
                        w = None if plain[t] else cws_a[t][ys]
                        if losses[t] == "softmax":
                            z -= z.max(axis=0)
                            own_z = z[hot]
                            np.exp(z, out=z)
                            total = z.sum(axis=0)
                            z /= total
                            z[hot] -= 1.0
                            lost = np.log(total) - own_z
                            if w is not None:
                                z *= w
                                lost *= w
                            out[a, -1] += lost.sum()
                        else:
                            out[a, -1] += add_loss(losses[t], z, hot, w, mus[t], *work)
                            z[:] = work[1]
                    GX = (Z @ Xs).reshape(len(some), -1)
                    for j, (a, _) in enumerate(some):
                        out[a, :-1] += GX[j]

    def advance(solver, t, loss_sum, grad_sum, it, mus) -> bool:
        """One step of a task's solver; True if the task is done."""
        n = max(tasks[t]._n, 1)
        if not solver.update(loss_sum / n, grad_sum / n, it):
            return False
        if losses[t] == "hinge" and mus[t] > tasks[t].mu_final * (1 + 1e-9):
            # continuation: a narrower smoothing band, warm-started from the current solution
            mus[t] = max(mus[t] / 10.0, tasks[t].mu_final)
            solver.restart(Ls[t] * 10.0)
            return False
        return True

    sets: dict = {}  # tasks with the same training rows
    for t in range(T):
        sets.setdefault(masks[t].tobytes(), []).append(t)
    apart = {} if mapped else {own[0]: own for own in sets.values() if (n := tasks[own[0]]._n) > 0
                               and n * K * (d + 1) * len(own) <= ONE_TASK and n * d * 8 <= ONE_TASK_BYTES}
    active = [t for t in range(T) if not any(t in own for own in apart.values())]
    if apart:
        def alone(first, blocks):
            """All passes of the tasks of one set, over its blocks by partition."""
            own, left, mus_t = {t: solvers[t] for t in apart[first]}, apart[first], list(mus)
            blocks = [[(g, y, scaled(X, first, whole), whole) for g, y, X, whole in held] for held in blocks]
            for it in range(max_iter):
                act, out = left, np.zeros(len(left) * width)
                pts, views = np.array([own[t].point() for t in act]), views_of(act)
                for held in blocks:
                    part_sum = np.zeros(len(out))
                    for g, y, X, whole in held:
                        add_block(g, y, X, whole, part_sum, act, pts, mus_t, views, ready=True)
                    out += part_sum
                res = out.reshape(len(act), width)
                left = [t for t, r in zip(act, res) if not advance(own[t], t, r[-1], r[:-1].reshape(K, d + 1), it, mus_t)]
                if not left:
                    break
            return [(t, x.x, x.n_iter, t not in left) for t, x in own.items()]

        for t, x, n_iter, done in _fit_apart(data, {first: np.flatnonzero(masks[first]).tolist() for first in apart}, len(cols), alone):
            solvers[t].x, solvers[t].n_iter = x.reshape(K, d + 1), n_iter
            if not done:
                stopped.append(t)
    for it in range(max_iter):
        if not active:
            break
        act = list(active)
        pts = np.array([solvers[t].point() for t in act])   # (A, K, d+1)
        if fold_root:
            for a, t in enumerate(act):
                pts[a, :, :d] = pts[a, :, :d] @ maps[tasks[t].feature_map].root

        def part(g, y, X, whole, out, act=act, pts=pts, views=views_of(act)):
            add_block(g, y, X, whole, out, act, pts, mus, views)

        res = data.sums(len(act) * width, part).reshape(len(act), width)
        loss_sums, res = res[:, -1], res[:, :-1].reshape(len(act), K, d + 1)
        if fold_root:
            for a, t in enumerate(act):
                res[a, :, :d] = res[a, :, :d] @ maps[tasks[t].feature_map].root.T
        active = [t for a, t in enumerate(act) if not advance(solvers[t], t, loss_sums[a], res[a], it, mus)]
    active += stopped
    if sent:
        sent.unpersist()
    if active:
        warnings.warn(f"{len(active)} of {T} linear fits ended at the limit of {max_iter} passes", RuntimeWarning, stacklevel=3)
    return [FittedTask(t, means[i], scales[i], solvers[i].x[:, :d].copy(), solvers[i].x[:, d].copy(),
                       solvers[i].n_iter, featurize=maps[t.feature_map] if len(maps) > 1 else maps[0], converged=i not in active) for i, t in enumerate(tasks)]


def _fit_apart(data: Packed, groups: dict, width: int, fit) -> list[tuple]:
    """Fits of few rows: for each of the sets (number -> its row groups) a Spark task gathers the blocks and returns
    ``fit(number, blocks)``, its tasks as (task, weights, passes, done). Blocks come by partition, in the order they are held,
    so that sums do not depend on how rows arrive."""
    of = data.df.sparkSession.createDataFrame([(int(g), int(t)) for t, own in groups.items() for g in own], "grp int, own int")

    def run(table: pa.Table) -> pa.Table:
        blocks: dict = {}
        rows = (b for x in table.to_batches() for b in unpack(x, width))
        for at, b in sorted(zip(table.column("at").to_pylist(), rows), key=lambda x: x[0]):
            blocks.setdefault(at >> 33, []).append(b)
        t, x, passes, done = zip(*fit(table.column("own")[0].as_py(), list(blocks.values())))
        return pa.table({"task": pa.array(t, pa.int32()), "x": pa.array([np.ascontiguousarray(w).tobytes() for w in x], pa.binary()),
                         "passes": pa.array(passes, pa.int32()), "done": pa.array(done)})

    dealt = data.df.withColumn("at", F.monotonically_increasing_id()).join(F.broadcast(of), "grp").repartitionByRange(len(groups), "own")
    rows = dealt.groupBy("own").applyInArrow(run, "task int, x binary, passes int, done boolean").collect()
    return [(r["task"], np.frombuffer(bytes(r["x"])), r["passes"], r["done"]) for r in rows]


class _Solver:
    """Per-task optimiser state; ``update(f, g)`` takes the data loss and gradient
    at ``point()`` (penalty excluded) and returns True when converged."""

    def __init__(self, shape, L, lam, penalty, fit_intercept, tol):
        self.x = np.zeros(shape)
        self.L, self.lam, self.penalty, self.fit_intercept, self.tol = L, lam, penalty, fit_intercept, tol
        self.n_iter = 0
        self.free = np.ones(shape, dtype=bool)
        if not fit_intercept:
            self.free[:, -1] = False

    def _penalised(self, x, f, g):
        w = x[:, :-1]
        if self.penalty == "l2":
            f = f + 0.5 * self.lam * float((w * w).sum())
            g = g.copy()
            g[:, :-1] += self.lam * w
        return f, np.where(self.free, g, 0.0)


class _Lbfgs(_Solver):
    """Limited-memory BFGS with Armijo backtracking (smooth L2 objectives).

    Every evaluation is one shared data pass; a rejected trial point costs one
    more pass at a shorter step."""

    def __init__(self, *a, memory: int = 10):
        super().__init__(*a)
        self.m = memory
        self.S, self.Y = [], []
        self.trial = self.x.copy()
        self.f = None
        self.g = None
        self.p = None
        self.alpha = 1.0
        self.small = 0

    def point(self):
        return self.trial

    def restart(self, L: float) -> None:
        """Forget the curvature history and re-evaluate at the current point."""
        self.L = L
        self.S, self.Y = [], []
        self.f, self.g, self.p = None, None, None
        self.alpha, self.small = 1.0, 0
        self.trial = self.x.copy()

    def _direction(self, g):
        q = g.ravel().copy()
        alphas = []
        for s, y in reversed(list(zip(self.S, self.Y))):
            rho = 1.0 / float(y @ s)
            a = rho * float(s @ q)
            alphas.append((rho, a, s, y))
            q -= a * y
        if self.S:
            s, y = self.S[-1], self.Y[-1]
            q *= float(s @ y) / float(y @ y)
        else:
            q /= self.L
        for rho, a, s, y in reversed(alphas):
            b = rho * float(y @ q)
            q += (a - b) * s
        return -q.reshape(g.shape)

    def update(self, f, g, it):
        f, g = self._penalised(self.trial, f, g)
        self.n_iter = it + 1
        if self.f is None:
            self.f, self.g = f, g
            self.p = self._direction(g)
            self.alpha = 1.0
            self.trial = self.x + self.alpha * self.p
            return float(np.abs(g).max()) == 0.0
        slope = float((self.g * self.p).sum())
        if f <= self.f + 1e-4 * self.alpha * slope or self.alpha < 1e-10:
            s = (self.trial - self.x).ravel()
            y = (g - self.g).ravel()
            self.small = self.small + 1 if abs(self.f - f) <= self.tol * max(1.0, abs(f)) else 0
            done = self.small >= 2 or float(np.abs(g).max()) <= self.tol * 1e-2
            if float(y @ s) > 1e-12:
                self.S.append(s)
                self.Y.append(y)
                if len(self.S) > self.m:
                    self.S.pop(0)
                    self.Y.pop(0)
            self.x, self.f, self.g = self.trial, f, g
            if done or self.alpha < 1e-10:
                return True
            self.p = self._direction(g)
            if float((g * self.p).sum()) >= 0:  # not a descent direction: restart
                self.S.clear()
                self.Y.clear()
                self.p = self._direction(g)
            self.alpha = 1.0
        else:
            self.alpha *= 0.5
        self.trial = self.x + self.alpha * self.p
        return False


class _OwlQn(_Lbfgs):
    """Orthant-wise limited-memory quasi-Newton for L1-penalised objectives
    (Andrew and Gao, 2007): L-BFGS on the pseudo-gradient, steps projected onto
    the current orthant; the intercept column is not penalised."""

    def _penalised_mask(self, x):
        pen = np.zeros_like(x, dtype=bool)
        pen[:, :-1] = True
        return pen

    def _pseudo(self, x, g):
        pen = self._penalised_mask(x)
        lam = self.lam
        pg = g.copy()
        pos, neg, zero = (x > 0) & pen, (x < 0) & pen, (x == 0) & pen
        pg[pos] += lam
        pg[neg] -= lam
        gz = g[zero]
        pg[zero] = np.where(gz + lam < 0, gz + lam, np.where(gz - lam > 0, gz - lam, 0.0))
        return np.where(self.free, pg, 0.0)

    def _objective(self, x, f):
        return f + self.lam * float(np.abs(x[:, :-1]).sum())

    def _new_direction(self):
        pg = self._pseudo(self.x, self.g)
        d = self._direction(pg)
        pen = self._penalised_mask(d)
        d = np.where(pen & (np.sign(d) != np.sign(-pg)), 0.0, d)
        self.orthant = np.where(self.x != 0, np.sign(self.x), np.sign(-pg))
        self.pg = pg
        return d

    def _project(self, x):
        """Zero the penalised coordinates that left the chosen orthant."""
        out = np.where(self._penalised_mask(x) & (np.sign(x) != self.orthant), 0.0, x)
        return np.where(self.free, out, 0.0)

    def update(self, f, g, it):
        g = np.where(self.free, g, 0.0)
        F = self._objective(self.trial, f)
        self.n_iter = it + 1
        if self.f is None:
            self.f, self.g = F, g
            self.p = self._new_direction()
            self.alpha = 1.0
            self.trial = self._project(self.x + self.alpha * self.p)
            return not self.p.any()
        if F <= self.f + 1e-4 * float((self.pg * (self.trial - self.x)).sum()) or self.alpha < 1e-10:
            s = (self.trial - self.x).ravel()
            y = (g - self.g).ravel()
            self.small = self.small + 1 if abs(self.f - F) <= self.tol * max(1.0, abs(F)) else 0
            done = self.small >= 2
            if float(y @ s) > 1e-12:
                self.S.append(s)
                self.Y.append(y)
                if len(self.S) > self.m:
                    self.S.pop(0)
                    self.Y.pop(0)
            self.x, self.f, self.g = self.trial, F, g
            if done or self.alpha < 1e-10:
                return True
            self.p = self._new_direction()
            if not self.p.any() or float(np.abs(self.pg).max()) <= 1e-9:
                return True
            self.alpha = 1.0
        else:
            self.alpha *= 0.5
        self.trial = self._project(self.x + self.alpha * self.p)
        return False


@dataclass
class LinearOVA:
    """A fitted one-vs-rest model (optionally a calibrated ensemble of fits)."""
    cols: list
    members: list = field(default_factory=list)   # FittedTask; probabilities are averaged

    def predict_proba(self, X: np.ndarray) -> np.ndarray:
        return np.mean([self.members[j].probabilities_of(Z) for j, Z in Stack(self.members).margins(X)], axis=0)

    def decision(self, X: np.ndarray) -> np.ndarray:
        return self.members[0].decision(X)

    def transform(self, df: DataFrame, keep=("Id",)) -> DataFrame:
        return map_probabilities(df, self.cols, [k for k in keep if k in df.columns], self.predict_proba)


def fit_ova(df: DataFrame, cols: list[str], n_classes: int, task: LinearTask, label="label",
            max_iter: int = MAX_PASSES, tol: float = 1e-4) -> LinearOVA:
    """Single fit on all rows of ``df`` (K4, K5 final models)."""
    data = df.withColumn("grp", F.lit(0))
    fitted = fit_tasks(data, cols, n_classes, [task], 1, label, "grp", max_iter, tol)
    return LinearOVA(list(cols), fitted)


# ---------------------------------------------------------------- K3 multinomial logistic

@dataclass
class SoftmaxModel:
    cols: list
    coef: np.ndarray      # (K, d) on standardised inputs
    intercept: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def predict_proba(self, X: np.ndarray) -> np.ndarray:
        Xs = np.nan_to_num((X - self.mean) / self.scale)
        return softmax(Xs @ self.coef.T + self.intercept)

    def transform(self, df: DataFrame, keep=("Id",)) -> DataFrame:
        return map_probabilities(df, self.cols, [k for k in keep if k in df.columns], self.predict_proba)


def fit_softmax(df: DataFrame, cols: list[str], n_classes: int, C: float = 0.1, label: str = "label",
                max_iter: int = MAX_PASSES, tol: float = 1e-4) -> SoftmaxModel:
    """K3: MLlib multinomial LogisticRegression on standardised features.

    The SVC-style C maps to ``regParam = 1 / (C n)`` (L2, ``elasticNetParam=0``);
    the scaler is our own population-std scaler, so MLlib's internal
    standardisation is switched off.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from ..operators.encode import StandardScaler

    df = labelled(df, label)
    sc = StandardScaler.fit(df, cols)
    scaled = sc.transform(df.select(*[F.col(f"`{c}`") for c in cols], F.col(label).alias("label")))
    safe = [f"f{i}" for i in range(len(cols))]
    renamed = scaled.select(*[F.col(f"`{c}`").alias(s) for c, s in zip(cols, safe)], "label")
    vec = VectorAssembler(inputCols=safe, outputCol="features", handleInvalid="keep").transform(renamed)
    n = sc.n
    lr = LogisticRegression(family="multinomial", regParam=1.0 / (C * n), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=tol, fitIntercept=True)
    model = lr.fit(vec)
    if model.summary.totalIterations >= max_iter:
        warnings.warn(f"the softmax fit ended at the limit of {max_iter} iterations", RuntimeWarning, stacklevel=2)
    coef = model.coefficientMatrix.toArray()
    icpt = model.interceptVector.toArray()
    if coef.shape[0] < n_classes:  # classes never seen at the top of the range
        pad = n_classes - coef.shape[0]
        coef = np.vstack([coef, np.zeros((pad, coef.shape[1]))])
        icpt = np.concatenate([icpt, np.full(pad, -np.inf)])
    mean = np.array(sc.mean, dtype=float)
    scale = np.array([s if s and s > 0 else 1.0 for s in sc.std], dtype=float)
    return SoftmaxModel(list(cols), coef, icpt, mean, scale)
