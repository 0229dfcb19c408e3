"""E7 class moments and the two discriminant models (K1 LDA, K2 QDA).

One data pass (``partial_sums``) yields per-class counts, sums and scatter
matrices for all classes at once; the d x d algebra happens on the driver
(K x d x d numbers, independent of the row count); scoring is a numpy batch
map. Data are shifted by a global mean before the products are summed so the
scatter does not lose precision to cancellation. ``FoldMoments`` keeps the same
sums per fold: the fit of every training side follows from them by subtraction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_matrix, arrow_vector, map_probabilities, partial_sums, softmax

RANK_TOL = 1e-4   # singular values below this share of the largest are cut


@dataclass
class ClassMoments:
    cols: list
    n: np.ndarray        # (K,) rows per class
    mean: np.ndarray     # (K, d) class means
    scatter: np.ndarray  # (K, d, d) centred scatter sum_i (x - mu_k)(x - mu_k)^T

    @classmethod
    def compute(cls, df: DataFrame, cols: list[str], n_classes: int, label: str = "label",
                centered: bool = False) -> "ClassMoments":
        """``centered=True`` (inputs already standardised) skips the job that finds the shift."""
        d, K = len(cols), n_classes
        shift = np.zeros(d) if centered else _shift(df, cols)
        size = K * (1 + d + d * d)

        def part(b):
            X = arrow_matrix(b, cols) - shift
            y = b.column(b.schema.names.index(label)).fill_null(-1).to_numpy(zero_copy_only=False)  # NaN as an integer differs by machine
            ok = ~np.isnan(X).any(axis=1) & (y >= 0) & (y < K)
            X, y = X[ok], y[ok]
            cnt = np.bincount(y, minlength=K).astype(float)
            sums = np.zeros((K, d))
            np.add.at(sums, y, X)
            scat = np.zeros((K, d, d))
            for k in np.unique(y):
                Xk = X[y == k]
                scat[k] = Xk.T @ Xk
            return np.concatenate([cnt, sums.ravel(), scat.ravel()])

        v = partial_sums(df.select(*[F.col(f"`{c}`") for c in cols], label), size, part)
        n = v[:K]
        sums = v[K:K + K * d].reshape(K, d)
        raw = v[K + K * d:].reshape(K, d, d)
        safe = np.maximum(n, 1)[:, None]
        mu_s = sums / safe
        scatter = raw - n[:, None, None] * np.einsum("ki,kj->kij", mu_s, mu_s)
        return cls(list(cols), n, mu_s + shift, scatter)

    def covariance(self, k: int) -> np.ndarray:
        return self.scatter[k] / max(self.n[k] - 1, 1)


def _shift(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Column means, about which products are summed; 0 for a column without values."""
    return np.nan_to_num(np.array(df.agg(*[F.avg(F.col(f"`{c}`").cast("double")) for c in cols]).first(), dtype=float))


@dataclass
class FoldMoments:
    """Moments per (repeat, fold), each about ``shift``, from one scan of rows with fold columns.

    Of every repeat all folds but the last are summed, and the whole table once; the last fold is the rest.
    ``training(r, f)`` is what a fit on the rows outside fold f of repeat r needs: the scaler (over the values that
    are not NULL, as ``StandardScaler``) and the class moments of the scaled rows (over complete rows with a class).
    """
    cols: list
    n_classes: int
    n_splits: int
    shift: np.ndarray
    whole: np.ndarray    # one vector of sums: class counts, class sums, class products, column counts, sums, squares
    held: np.ndarray     # (repeats, folds, the same)

    @classmethod
    def compute(cls, df: DataFrame, cols: list[str], n_classes: int, fold_cols: list[str], n_splits: int,
                label: str = "label") -> "FoldMoments":
        d, K, R, S = len(cols), n_classes, len(fold_cols), n_splits
        shift = _shift(df, cols)
        a, b = K, K + K * d                      # starts of the class sums and products
        c = b + K * d * d                        # start of the column sums
        size = c + 3 * d

        def add(out, X, y, known):
            """Adds rows of one class (``y``; None: the column sums of all rows)."""
            if y is None:
                Z = np.where(known, X, 0.0)
                out[c:c + d] += known.sum(0)
                out[c + d:c + 2 * d] += Z.sum(0)
                out[c + 2 * d:] += (Z * Z).sum(0)
            else:
                out[y] += len(X)
                out[a + y * d:a + (y + 1) * d] += X.sum(0)
                out[b + y * d * d:b + (y + 1) * d * d] += (X.T @ X).ravel()

        def part(batch):
            X = arrow_matrix(batch, cols) - shift
            folds = [arrow_vector(batch, f, np.int64) for f in fold_cols]
            y = batch.column(batch.schema.names.index(label)).fill_null(-1).to_numpy(zero_copy_only=False)
            known = ~np.isnan(X)
            out = np.zeros((1 + R * (S - 1), size))
            usable = known.all(axis=1) & (y >= 0) & (y < K)
            groups = [(None, np.arange(len(y)))] + [(int(k), np.flatnonzero(usable & (y == k))) for k in np.unique(y[usable])]
            for k, rows in groups:
                add(out[0], X[rows], k, known[rows])
                for r in range(R):
                    for f in range(S - 1):
                        own = rows[folds[r][rows] == f]
                        if len(own):
                            add(out[1 + r * (S - 1) + f], X[own], k, known[own])
            return out.ravel()

        v = partial_sums(df.select(*[F.col(f"`{x}`") for x in cols], label, *fold_cols), (1 + R * (S - 1)) * size, part)
        v = v.reshape(-1, size)
        first = v[1:].reshape(R, S - 1, size)
        held = np.concatenate([first, (v[0] - first.sum(axis=1))[:, None]], axis=1)
        return cls(list(cols), K, S, shift, v[0], held)

    def training(self, repeat: int, fold: int) -> tuple[np.ndarray, np.ndarray, ClassMoments]:
        """Scaler mean, scaler scale and scaled class moments of the rows outside the fold."""
        d, K = len(self.cols), self.n_classes
        v = self.whole - self.held[repeat, fold]
        n = np.rint(v[:K])
        sums = v[K:K + K * d].reshape(K, d)
        raw = v[K + K * d:K + K * d + K * d * d].reshape(K, d, d)
        count, s1, s2 = v[-3 * d:].reshape(3, d)
        count = np.maximum(np.rint(count), 1)
        var = np.maximum(s2 / count - (s1 / count) ** 2, 0)
        allc, all1, all2 = self.whole[-3 * d:].reshape(3, d)
        total = np.maximum(all2 / np.maximum(allc, 1) - (all1 / np.maximum(allc, 1)) ** 2, 0)
        mean = self.shift + s1 / count
        # what subtraction leaves of a column that is constant on this side is rounding, not spread
        constant = (var <= 1e-12 * total) | (var <= 1e-24 * mean ** 2)
        scale = np.where(constant, 1.0, np.sqrt(np.where(constant, 1.0, var)))
        mu = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], 0.0)
        scatter = (raw - n[:, None, None] * np.einsum("ki,kj->kij", mu, mu)) / np.outer(scale, scale)
        scatter[n < 2] = 0.0
        return mean, scale, ClassMoments(self.cols, n, (mu + self.shift - mean) / scale, scatter)


@dataclass
class LDA:
    """Linear discriminant: shared (pooled) covariance, class means, priors -> softmax."""
    cols: list
    coef: np.ndarray
    intercept: np.ndarray

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str], n_classes: int, label: str = "label", tol: float = RANK_TOL,
            centered: bool = False) -> "LDA":
        return cls.from_moments(ClassMoments.compute(df, cols, n_classes, label, centered), tol)

    @classmethod
    def from_moments(cls, m: ClassMoments, tol: float = RANK_TOL) -> "LDA":
        n, K = m.n.sum(), len(m.n)
        pooled = m.scatter.sum(axis=0) / max(n - K, 1)
        # rank tolerance in correlation space (features on any scale): singular values of the
        # data are cut at ``tol`` of the largest, hence eigenvalues at its square
        sd = np.sqrt(np.maximum(np.diag(pooled), 0))
        sd = np.where(sd > 0, sd, 1.0)
        s, V = np.linalg.eigh(pooled / np.outer(sd, sd))
        keep = s > tol**2 * s.max()
        inv = ((V[:, keep] / s[keep]) @ V[:, keep].T) / np.outer(sd, sd)
        prior = np.maximum(m.n, 1e-300) / n
        coef = m.mean @ inv
        intercept = -0.5 * np.einsum("kd,kd->k", coef, m.mean) + np.log(prior)
        intercept[m.n == 0] = -np.inf
        return cls(list(m.cols), coef, intercept)

    def predict_proba(self, X: np.ndarray) -> np.ndarray:
        return softmax(np.nan_to_num(X) @ self.coef.T + self.intercept)

    def transform(self, df: DataFrame, keep=("Id",)) -> DataFrame:
        return map_probabilities(df, self.cols, [k for k in keep if k in df.columns], self.predict_proba)


@dataclass
class QDA:
    """Quadratic discriminant: one covariance per class, cut to its rank.

    The quadratic feature set holds exact linear combinations of X and Y, so class covariances are rank-deficient.
    A class keeps the axes whose singular values (of its centred rows) exceed ``tol`` times its largest; ``ranks``
    says how many. Densities of classes are comparable only over one space, which is the span of the pooled scatter,
    cut by the same rule: along those of its axes in which a class has no spread of its own (constant columns, fewer
    rows than axes) the class takes the pooled variance. Where all classes have the pooled rank nothing is borrowed,
    and the result is the truncated singular value form. A class without rows gets probability 0.
    """
    cols: list
    means: np.ndarray      # (K, d)
    rotations: np.ndarray  # (K, d, r): axes of the density, r the pooled rank
    scales: np.ndarray     # (K, r) variances along them, the class's own first, largest first
    log_prior: np.ndarray  # (K,)
    ranks: np.ndarray      # (K,) axes of the class's own

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str], n_classes: int, label: str = "label", tol: float = RANK_TOL,
            centered: bool = False) -> "QDA":
        return cls.from_moments(ClassMoments.compute(df, cols, n_classes, label, centered), tol)

    @classmethod
    def from_moments(cls, m: ClassMoments, tol: float = RANK_TOL) -> "QDA":
        K, n = len(m.n), m.n.sum()
        var, base = _axes(m.scatter.sum(axis=0) / max(n - K, 1), tol)
        r = len(var)
        rots, scales, ranks = np.zeros((K, len(m.cols), r)), np.ones((K, r)), np.zeros(K, dtype=np.int64)
        for k in range(K):
            own, V = _axes(base.T @ m.covariance(k) @ base, tol)
            ranks[k] = q = len(own)
            # the rest of the pooled span, with the pooled variances along it
            rest = np.linalg.svd(V, full_matrices=True)[0][:, q:] if q else np.eye(r)
            lent, U = np.linalg.eigh(rest.T @ (var[:, None] * rest))
            rots[k] = base @ np.concatenate([V, rest @ U], axis=1)
            scales[k] = np.concatenate([own, lent])
        with np.errstate(divide="ignore"):
            lp = np.log(m.n / n)
        return cls(list(m.cols), m.mean, rots, scales, lp, ranks)

    def predict_proba(self, X: np.ndarray) -> np.ndarray:
        X = np.nan_to_num(X)
        K = self.means.shape[0]
        L = np.empty((X.shape[0], K))
        for k in range(K):
            Z = (X - self.means[k]) @ self.rotations[k] / np.sqrt(self.scales[k])
            L[:, k] = -0.5 * (np.log(self.scales[k]).sum() + (Z * Z).sum(axis=1)) + self.log_prior[k]
        return softmax(L)

    def transform(self, df: DataFrame, keep=("Id",)) -> DataFrame:
        return map_probabilities(df, self.cols, [k for k in keep if k in df.columns], self.predict_proba)


def _axes(cov: np.ndarray, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """Variances (largest first) and axes of a covariance; those whose root is at most ``tol`` times the largest are cut."""
    s, V = np.linalg.eigh(cov)
    s, V = s[::-1], V[:, ::-1]
    keep = s > (tol ** 2 * s[0] if len(s) and s[0] > 0 else np.inf)
    return s[keep], V[:, keep]
