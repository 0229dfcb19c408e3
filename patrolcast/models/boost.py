"""Multiclass gradient-boosted trees on histograms (K12 depth-wise, K13
leaf-wise, K14 symmetric), with k-fold training in the same passes (J4).

Data plan
---------
* Features are binned once: ``approxQuantile`` cut points (one job for all columns). Rows are packed into blocks
  (``_BLOCK``, about ``BLOCK_BYTES`` each): a byte a feature by feature, margins by tree, so that a pass moves a few buffers;
  the blocks are cached. A task works on as many blocks at once as have ``BLOCK_ROWS`` rows.
* One round grows one tree per class (softmax objective, g = p - y, h = max(2p(1-p), 1e-16)). The
  class probabilities of a round's sampled rows are computed once and cached; every pass reads them.
* A node of more than ``RAW_ROWS`` rows is split by a **level** pass: every task adds up its rows per (node, feature, bin),
  over its blocks within a bound, and one exchange by (tree, node) adds up the tasks' sums and picks the best split
  (by tree under symmetric growth, all nodes together).
* A node of up to ``RAW_ROWS`` rows sends them once, by (tree, node), to a task that grows all below it (``_grow``, the
  same split search). So a round costs a few level passes and one exchange of rows, whatever the depth. Best-leaf-first
  growth below a node follows the order that growth of the whole tree has there; the driver replays the choice over all
  nodes, and another exchange goes on below the nodes that were chosen and not looked into yet. A symmetric tree goes to one task only if it has that few rows as a whole.
  Only splits reach the driver.
* After a round the margins are advanced by a narrow ``mapInArrow`` over the
  cached blocks; every ``checkpoint_every`` rounds the blocks are checkpointed to
  the shared checkpoint folder, so lineage stays short and survives lost
  executors.
* Feature draws and row samples are functions of (seed, round), so a fit that starts from the first rounds
  of another (``init``, e.g. loaded from its tables) goes on exactly as that one would have.
* k-fold CV (``n_models`` > 1) trains model m on rows with ``grp != m`` and
  evaluates it on ``grp == m`` in the same passes.
* Several settings (``trials``) are cross-validated in the same passes too: a model is a (trial, fold), every number
  of a setting but ``growth``, ``max_bins`` and ``checkpoint_every`` is looked up by model, and a
  trial that stopped sends nothing any more. A row carries trials x folds x classes margins, so callers bound the trials of a run.

Split gain (regularised, L1 by soft threshold T):
  1/2 [T(GL)^2/(HL+lambda) + T(GR)^2/(HR+lambda) - T(G)^2/(H+lambda)] - gamma
Leaf value: -eta T(G)/(H+lambda). Ties go to the lowest feature, then bin.
"""

from __future__ import annotations

import heapq
import json
import math
from collections import namedtuple
from dataclasses import dataclass, field, replace
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.selection import P31, key_hash_np
from ..session import BLOCK_BYTES, cut_lineage, filled, session_setting
from .base import arrow_matrix, arrow_vector, cached, labelled, map_probabilities, partial_sums, softmax

RAW_ROWS = 200_000  # rows of a node that go to one task, which grows all below it; larger nodes are split by level passes
HELD_CELLS = 16_000_000  # numbers of added-up nodes that a task holds between blocks
SLOT_CELLS = 2_000_000  # dense cells that a split search holds at once
BLOCK_ROWS, WORK_BYTES = 16_384, 32 << 20  # rows worked on together, and bytes of their margins, at most
SENT_BYTES = 8 << 20  # of sums that a task sends at once
SPARE_LEAVES = 16  # leaves that a part of a leaf-wise tree may have beside its share
EXCHANGE_BYTES = 64 << 20  # about what a task receives of rows sent


@dataclass
class BoostParams:
    n_rounds: int = 5
    max_depth: int = 4
    eta: float = 0.3
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    growth: str = "depthwise"      # depthwise | leafwise | symmetric
    num_leaves: int = 31
    max_bins: int = 32
    seed: int = 2019
    early_stopping_rounds: int | None = None
    min_child_samples: int = 0
    checkpoint_every: int = 10


@dataclass
class Binner:
    cols: list
    cuts: list   # per feature sorted unique cut points; bin = #cuts < x

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str], max_bins: int) -> "Binner":
        probs = [i / max_bins for i in range(1, max_bins)]
        safe = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
        qs = safe.approxQuantile([f"x{i}" for i in range(len(cols))], probs, 1.0 / (4 * max_bins))
        return cls(list(cols), [sorted(set(q)) for q in qs])

    def bins(self, X: np.ndarray) -> np.ndarray:
        out = np.empty(X.shape, dtype=np.int16)
        for j, c in enumerate(self.cuts):
            col = np.nan_to_num(X[:, j], nan=-np.inf)
            out[:, j] = np.searchsorted(np.asarray(c, dtype=float), col, side="left")
        return out

    @property
    def n_bins(self) -> int:
        return max(len(c) for c in self.cuts) + 1


@dataclass
class Tree:
    feat: list = field(default_factory=lambda: [-1])
    thr: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])
    depth: list = field(default_factory=lambda: [0])

    def split(self, node: int, feat: int, thr: int) -> tuple[int, int]:
        lid, rid = len(self.feat), len(self.feat) + 1
        for _ in range(2):
            self.feat.append(-1); self.thr.append(0); self.left.append(-1); self.right.append(-1)
            self.value.append(0.0); self.depth.append(self.depth[node] + 1)
        self.feat[node], self.thr[node], self.left[node], self.right[node] = feat, thr, lid, rid
        return lid, rid

    def prune(self, kept: set) -> None:
        """Make every inner node that is not in ``kept`` a leaf (its value is known) and drop what is below; nodes are numbered by level."""
        old = Tree(*(list(x) for x in (self.feat, self.thr, self.left, self.right, self.value, self.depth)))
        self.__init__(value=[old.value[0]], depth=[old.depth[0]])
        queue = [(0, 0)]
        for was, now in queue:
            if old.feat[was] >= 0 and was in kept:
                for c, new in zip((old.left[was], old.right[was]), self.split(now, old.feat[was], old.thr[was])):
                    self.value[new] = old.value[c]
                    queue.append((c, new))

    def arrays(self):
        return (np.array(self.feat, dtype=np.int64), np.array(self.thr, dtype=np.int64),
                np.array(self.left, dtype=np.int64), np.array(self.right, dtype=np.int64),
                np.array(self.value, dtype=float))


def descend(arrs, B: np.ndarray, by_feature: bool = False) -> np.ndarray:
    """Current node of every row (binned features ``B``, rows x features, or the other way ``by_feature``) in a (partial) tree."""
    feat, thr, left, right = arrs[:4]
    n = B.shape[1 if by_feature else 0]
    flat, row_step, feat_step = B.reshape(-1), 1 if by_feature else B.shape[1], n if by_feature else 1
    inner_node, base, child = feat >= 0, np.maximum(feat, 0) * feat_step, np.stack([left, right], axis=1).ravel()
    out, rows, node = np.zeros(n, dtype=np.int64), np.arange(n), np.zeros(n, dtype=np.int64)
    while len(rows):
        inner = inner_node[node]
        if not inner.all():
            out[rows[~inner]] = node[~inner]
            rows, node = rows[inner], node[inner]
        node = child[2 * node + (flat[base[node] + rows * row_step] > thr[node])]
    return out


def best_first(tree: Tree, info: dict, num_leaves: int, max_depth: int) -> list[int]:
    """Nodes split by best-leaf-first growth, as far as the nodes' best splits (``info``) are known.

    Children that were not examined yet count as closed. Growth repeats this with ever more nodes
    known until every child of every chosen node is, and then it is the exact order: each step
    splits the open leaf with the largest gain (ties: the older node)."""
    heap = [(-info[0].gain, 0)] if 0 in info and info[0].feat >= 0 and tree.depth[0] < max_depth else []
    chosen: list[int] = []
    while heap and len(chosen) + 1 < num_leaves:
        _, n = heapq.heappop(heap)
        chosen.append(n)
        if tree.feat[n] >= 0:
            for c in (tree.left[n], tree.right[n]):
                if c in info and info[c].feat >= 0 and tree.depth[c] < max_depth:
                    heapq.heappush(heap, (-info[c].gain, c))
    return chosen


def _soft(G, alpha):
    return np.sign(G) * np.maximum(np.abs(G) - alpha, 0.0)


def _row_sample(ids: np.ndarray, seed: int, rnd: int, rate: float) -> np.ndarray:
    if rate >= 1.0:
        return np.ones(ids.shape[0], dtype=bool)
    return key_hash_np(ids, seed * 1000003 + rnd) < rate * P31


@dataclass
class BoostModel:
    cols: list
    binner: Binner
    n_classes: int
    params: BoostParams
    rounds: list = field(default_factory=list)   # per round: list of K trees (model 0)

    def arrays(self, n_rounds: int | None = None) -> list:
        """Every tree of every round as arrays, built once for scoring."""
        return [[t.arrays() for t in trees] for trees in self.rounds[:n_rounds]]

    def margins(self, X: np.ndarray, n_rounds: int | None = None) -> np.ndarray:
        return add_margins(self.arrays(n_rounds), self.binner.bins(X), np.zeros((X.shape[0], self.n_classes)))

    def predict_proba(self, X: np.ndarray) -> np.ndarray:
        return softmax(self.margins(X))

    def transform(self, df: DataFrame, keep=("Id",), output: str = "probability") -> DataFrame:
        """Probabilities, or ``rawPrediction``: the margins, or ``both`` from one descent. The trees are sent once to an executor."""
        sent = df.sparkSession.sparkContext.broadcast((self.arrays(), self.binner, self.n_classes))

        def score(X):
            arrays, binner, K = sent.value
            Z = add_margins(arrays, binner.bins(X), np.zeros((X.shape[0], K)))
            return (softmax(Z), Z) if output == "both" else softmax(Z) if output == "probability" else Z

        return map_probabilities(df, self.cols, [k for k in keep if k in df.columns], score,
                                 output=("probability", "rawPrediction") if output == "both" else output)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The node table ``round, class, node, feature, bin, cut, left, right, value``; leaves have no feature."""
        rows = [(r, k, n, self.cols[f] if f >= 0 else None, t.thr[n] if f >= 0 else None,
                 float(self.binner.cuts[f][t.thr[n]]) if f >= 0 and t.thr[n] < len(self.binner.cuts[f]) else None,
                 t.left[n] if f >= 0 else None, t.right[n] if f >= 0 else None, float(t.value[n]))
                for r, trees in enumerate(self.rounds) for k, t in enumerate(trees) for n, f in enumerate(t.feat)]
        return spark.createDataFrame(rows, _NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        """Two tables: the nodes, and the features with their cut points and the settings."""
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"n_classes": self.n_classes, "rounds": len(self.rounds), "params": self.params.__dict__})
        rows = [(i, c, [float(x) for x in cuts], meta) for i, (c, cuts) in enumerate(zip(self.cols, self.binner.cuts))]
        spark.createDataFrame(rows, "place int, feature string, cuts array<double>, settings string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostModel":
        rows = sorted(spark.read.parquet(f"{path}/features").collect(), key=lambda r: r["place"])
        meta, cols = json.loads(rows[0]["settings"]), [r["feature"] for r in rows]
        place = {c: i for i, c in enumerate(cols)}
        model = cls(cols, Binner(cols, [list(r["cuts"]) for r in rows]), meta["n_classes"], BoostParams(**meta["params"]))
        model.rounds = [[Tree([], [], [], [], [], []) for _ in range(meta["n_classes"])] for _ in range(meta["rounds"])]
        table = spark.read.parquet(f"{path}/nodes").sort("round", "class", "node").toArrow().to_pydict()
        for r, k, c, b, left, right, value in zip(*(table[n] for n in ("round", "class", "feature", "bin", "left", "right", "value"))):
            t = model.rounds[r][k]
            t.feat.append(-1 if c is None else place[c])
            t.thr.append(0 if c is None else b)
            t.left.append(-1 if c is None else left)
            t.right.append(-1 if c is None else right)
            t.value.append(value)
        for trees in model.rounds:
            for t in trees:
                t.depth = [0] * len(t.feat)
                for n, f in enumerate(t.feat):
                    if f >= 0:
                        t.depth[t.left[n]] = t.depth[t.right[n]] = t.depth[n] + 1
        return model


_NODES = ("round int, class int, node int, feature string, bin int, cut double, left int, right int, value double")
_BLOCK = "n int, ids binary, label binary, grp binary, bins binary, z binary"  # z: margins, or probabilities, by tree
_KINDS = (np.int64, np.int32, np.int32, np.uint8, np.float64)
_SUMS = "tree int, node int, sums binary"
_ROWS = "tree int, node int, n int, bins binary, p binary, hit binary"
_SPLIT_NAMES = ["tree", "node", "at", "left", "feat", "bin", "gain", "G", "H", "GL", "HL", "N", "CL"]
_SPLITS = "tree int, node int, at int, left int, feat int, bin int, gain double, G double, H double, GL double, HL double, N double, CL double"


def add_margins(arrays: list, B: np.ndarray, Z: np.ndarray) -> np.ndarray:
    """Adds the leaf values of every round's trees to the margins ``Z``."""
    for trees in arrays:
        for k, a in enumerate(trees):
            Z[:, k] += a[4][descend(a, B)]
    return Z


def _limits(models: list[BoostParams]) -> np.ndarray:
    """What a split search needs of every model's setting, a row each."""
    return np.array([[p.reg_alpha, p.reg_lambda, p.min_child_weight, p.min_child_samples, p.gamma] for p in models], dtype=float)


def _gains(g: np.ndarray, h: np.ndarray, c: np.ndarray | None, limits: np.ndarray):
    """Of sums (nodes, features, bins): node totals, left sums and gain of every cut, and which cuts are allowed.
    ``limits``: the tree's row of ``_limits``; ``c`` is None where no number of rows is asked for."""
    alpha, lam, weight, samples = limits[:4]
    G, H = (x[:, 0].sum(axis=1) for x in (g, h))
    GL, HL = (np.cumsum(x, axis=2)[:, :, :-1] for x in (g, h))
    G_, H_ = (x[:, None, None] for x in (G, H))
    score = lambda G, H: _soft(G, alpha) ** 2 / (H + lam)
    gain = 0.5 * (score(GL, HL) + score(G_ - GL, H_ - HL) - score(G_, H_))
    ok = (HL >= weight) & (H_ - HL >= weight)
    if c is None:
        return (G, H, np.zeros(len(G))), (GL, HL, None), gain, ok
    N, CL = c[:, 0].sum(axis=1), np.cumsum(c, axis=2)[:, :, :-1]
    ok &= (CL >= samples) & (N[:, None, None] - CL >= samples)
    return (G, H, N), (GL, HL, CL), gain, ok


Found = namedtuple("Found", "feat bin gain G H GL HL N CL")


def _found(totals, lefts, feat, cut, gain) -> list:
    """One ``Found`` for each node; feat -1 and no left sums where nothing may be split."""
    at, good = np.arange(len(feat)), feat >= 0
    f = np.maximum(feat, 0)
    left = [np.where(good, x[at, f, cut], 0.0) if x is not None and x.shape[2] else np.zeros(len(feat)) for x in lefts]
    cols = [feat, np.where(good, cut, 0), np.where(good, gain, 0.0), *totals[:2], *left[:2], totals[2], left[2]]
    return [Found(*x) for x in zip(*(c.tolist() for c in cols))]


def _best_splits(m: int, dense, mask: np.ndarray, limits: np.ndarray, step: int, symmetric: bool) -> list:
    """Best split of each of ``m`` nodes of a tree, ``dense(a, z)`` their sums, ``step`` nodes at once: the allowed cut of greatest
    gain; ties go to the lowest feature, then bin. Symmetric: the one cut, allowed in every node, with the greatest gain over all."""
    if symmetric:
        parts = [(a, min(a + step, m)) for a in range(0, m, step)]
        if len(parts) == 1:
            held = dense(0, m)
            dense = lambda a, z: held
        total, valid = None, None
        for a, z in parts:
            _, _, gain, ok = _gains(*dense(a, z), limits)
            total = gain.sum(axis=0) if total is None else total + gain.sum(axis=0)
            valid = ok.all(axis=0) if valid is None else valid & ok.all(axis=0)
        total = np.where(valid & mask[:, None], total - limits[4] * m, -np.inf)
        feat, cut = divmod(int(np.argmax(total)), total.shape[1]) if total.size else (0, 0)
        good = bool(total.size) and total[feat, cut] > 0
        out = []
        for a, z in parts:
            totals, lefts, _, _ = _gains(*dense(a, z), limits)
            out += _found(totals, lefts, np.full(z - a, feat if good else -1), np.full(z - a, cut),
                          np.full(z - a, total[feat, cut] if good else 0.0))
        return out
    out = []
    for a in range(0, m, step):
        totals, lefts, gain, ok = _gains(*dense(a, min(a + step, m)), limits)
        gain = np.where(ok & mask[:, None], gain - limits[4], -np.inf).reshape(len(gain), -1)
        if not gain.shape[1]:
            out += _found(totals, lefts, np.full(len(gain), -1), np.zeros(len(gain), int), np.zeros(len(gain)))
            continue
        best = gain.argmax(axis=1)
        top = gain[np.arange(len(gain)), best]
        feat, cut = np.divmod(best, lefts[0].shape[2])
        out += _found(totals, lefts, np.where(top > 0, feat, -1), cut, top)
    return out


def _histogram(B: np.ndarray, slot: np.ndarray, m: int, nb: int, g: np.ndarray, h: np.ndarray, counts: bool) -> np.ndarray:
    """Sums of g, h and (``counts``) rows per (node, feature, bin), of rows by feature ``B`` in the nodes ``slot`` < m."""
    d, n = B.shape
    out = np.zeros((3 if counts else 2, m, d, nb))
    step = max(BLOCK_ROWS, 4 * m * nb)
    for a in range(0, n, step):
        part, gs, hs = slice(a, a + step), g[a:a + step], h[a:a + step]
        first = slot[part] * nb
        for f in range(d):
            at = first + B[f, part]
            out[0, :, f] += np.bincount(at, gs, m * nb).reshape(m, nb)
            out[1, :, f] += np.bincount(at, hs, m * nb).reshape(m, nb)
            if counts:
                out[2, :, f] += np.bincount(at, minlength=m * nb).reshape(m, nb)
    return out


def _slopes(p: np.ndarray, hit: np.ndarray):
    return p - hit, np.maximum(2 * p * (1 - p), 1e-16)


def _to_split(tree: Tree, info: dict, fresh: list, p: BoostParams) -> list[int]:
    """The nodes to split now that ``fresh`` were examined."""
    if p.growth == "leafwise":
        return [n for n in best_first(tree, info, p.num_leaves, p.max_depth) if tree.feat[n] < 0]
    return sorted((n for n in fresh if info[n].feat >= 0 and tree.depth[n] < p.max_depth), key=lambda n: (-info[n].gain, n))


def _split(tree: Tree, n: int, r, p: BoostParams) -> tuple[int, int]:
    lid, rid = tree.split(n, int(r.feat), int(r.bin))
    tree.value[lid] = float(-p.eta * _soft(r.GL, p.reg_alpha) / (r.HL + p.reg_lambda))
    tree.value[rid] = float(-p.eta * _soft(r.G - r.GL, p.reg_alpha) / (r.H - r.HL + p.reg_lambda))
    return lid, rid


def _grow(B: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, p: BoostParams, mask: np.ndarray, nb: int, slot_cells: int):
    """(node, left child or -1, ``Found``) of every node examined below a node at ``depth``, itself 0, whose rows are given."""
    d, n = B.shape
    tree, info, limits = Tree(depth=[depth]), {}, _limits([p])[0]
    symmetric, counts, step = p.growth == "symmetric", p.min_child_samples > 0, max(1, slot_cells // (d * nb))
    flat, at, fresh = B.reshape(-1), np.zeros(n, np.int64), [0]
    while fresh:
        m = len(fresh)
        slot = np.full(len(tree.feat), -1)
        slot[fresh] = np.arange(m)
        s = slot[at]
        G, H, N = np.bincount(s + 1, g, m + 1)[1:], np.bincount(s + 1, h, m + 1)[1:], np.bincount(s + 1, minlength=m + 1)[1:]
        # a node that cannot have two children of the least weight and size is a leaf without a look at its cuts
        may = np.ones(m, bool) if symmetric else (H >= 2 * limits[2] * (1 - 1e-9)) & (N >= max(2, 2 * limits[3]))
        for j in np.flatnonzero(~may).tolist():
            info[fresh[j]] = Found(-1, 0, 0.0, float(G[j]), float(H[j]), 0.0, 0.0, 0.0, 0.0)
        live = [fresh[j] for j in np.flatnonzero(may).tolist()]
        slot = np.full(len(tree.feat), -1)
        slot[live] = np.arange(len(live))
        s = slot[at]
        rows = np.flatnonzero(s >= 0)
        s = s[rows]
        order = np.argsort(s.astype(np.int16) if len(live) < 32768 else s, kind="stable")
        rows, s = rows[order], s[order]
        starts = np.searchsorted(s, np.arange(len(live) + 1))

        def dense(a, z):
            some = rows[starts[a]:starts[z]]
            out = _histogram(B[:, some], s[starts[a]:starts[z]] - a, z - a, nb, g[some], h[some], counts)
            return out[0], out[1], out[2] if counts else None

        info.update(zip(live, _best_splits(len(live), dense, mask, limits, step, symmetric)))
        split, fresh = np.zeros(len(tree.feat), bool), []
        for k in _to_split(tree, info, live, p):
            split[k] = True
            lid, rid = _split(tree, k, info[k], p)
            if tree.depth[lid] < p.max_depth:
                fresh += [lid, rid]
        if fresh:
            feat, thr, left, right, _ = tree.arrays()
            moved = np.flatnonzero(split[at])
            was = at[moved]
            at[moved] = np.where(flat[feat[was] * n + moved] > thr[was], right[was], left[was])
    return [(k, tree.left[k] if tree.feat[k] >= 0 else -1, info[k]) for k in sorted(info)]


def _packed(ids, y, grp, B, Z):
    """The rows (as ``_blocks`` gives them) in packed blocks."""
    n = len(ids)
    size = -(-n // max(1, -(-n * (len(B) + 8 * len(Z) + 16) // BLOCK_BYTES)))
    for a in range(0, n, max(1, size)):
        some = slice(a, a + size)
        yield _pack(len(ids[some]), [ids[some], y[some], grp[some], B[:, some], Z[:, some]])


def _pack(n: int, arrays) -> pa.RecordBatch:
    cols = [pa.array([np.ascontiguousarray(x, t).tobytes()], pa.binary()) for x, t in zip(arrays, _KINDS)]
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *cols], names=["n", "ids", "label", "grp", "bins", "z"])


def _blocks(batches, d: int):
    """(ids, labels, groups, bins by feature, margins or probabilities by tree) of the rows, packed blocks joined within a bound."""
    held, rows = [], 0
    for one in _unpacked(batches, d):
        n, wide = len(one[0]), 8 * len(one[4])
        if held and (rows + n > BLOCK_ROWS or (rows + n) * wide > WORK_BYTES):
            yield _joined(held)
            held, rows = [], 0
        held.append(one)
        rows += n
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple:
    return held[0] if len(held) == 1 else tuple(np.concatenate(x, axis=-1) for x in zip(*held))


def _unpacked(batches, d: int):
    for b in batches:
        for i, n in enumerate(b.column(b.schema.names.index("n")).to_pylist()):
            ids, y, grp, B, Z = (np.frombuffer(b.column(b.schema.names.index(c))[i].as_buffer(), t)
                                 for c, t in zip(("ids", "label", "grp", "bins", "z"), _KINDS))
            yield ids, y, grp, B.reshape(d, n), Z.reshape(-1, n)


def _in_nodes(held, folds: list, samples: list, K: int, rnd: int, d: int, batches):
    """Of every block and tree that has open nodes: (tree, number of open nodes, their numbers, bins, place among the open nodes,
    probability, whether the row is of the tree's class) of the rows in them, and None after each block."""
    several = len(set(samples)) > 1  # else the rows hold the one sample only
    for ids, y, grp, B, P in _blocks(batches, d):
        drawn = {s: _row_sample(ids, s[0], rnd, s[1]) for s in set(samples)} if several else {}
        model = None
        for t, arrs, slots, numbers in held.value:
            m, k = divmod(t, K)
            if m != model:
                use = drawn[samples[m]] if several else np.ones(len(y), bool)
                use = use if folds[m] is None else use & (grp != folds[m])
                rows = None if use.all() else np.flatnonzero(use)
                model, own_B, own_y = m, B if rows is None else B[:, rows], y if rows is None else y[rows]
            p = P[t] if rows is None else P[t][rows]
            slot, own = slots[descend(arrs, own_B, True)], own_B
            inside = slot >= 0
            hit = own_y == k
            if not inside.all():
                inside = np.flatnonzero(inside)
                slot, own, p, hit = slot[inside], own[:, inside], p[inside], hit[inside]
            if len(slot):
                yield t, len(numbers), numbers, own, slot, p, hit
        yield None


def _send(data: DataFrame, trees: list[Tree], open_nodes: dict):
    """What tasks need of the trees with open nodes, by tree: nodes, place of every node among the open ones (or -1), their numbers."""
    sent = []
    for t in sorted(open_nodes):
        slots = np.full(len(trees[t].feat), -1)
        slots[open_nodes[t]] = np.arange(len(open_nodes[t]))
        sent.append((t, trees[t].arrays()[:4], slots, np.array(open_nodes[t])))
    return data.sparkSession.sparkContext.broadcast(sent)


def _level(data: DataFrame, trees: list[Tree], open_nodes: dict, d: int, nb: int, K: int, models: list[BoostParams], folds: list,
           rnd: int, colmask: np.ndarray) -> list:
    """Best splits of all open nodes: one pass over the round's rows, one exchange of sums. ``folds``: the fold that a model leaves out (None: none)."""
    held = _send(data, trees, open_nodes)
    held_cells, step = HELD_CELLS, max(1, SLOT_CELLS // (d * nb))
    limits, symmetric = _limits(models), models[0].growth == "symmetric"
    counts = not symmetric or bool((limits[:, 3] > 0).any())  # sizes say how a child goes on
    samples = [(p.seed, p.subsample) for p in models]

    def flush(sums: dict, numbers: dict):
        found = ((t, n, A[:, j].tobytes()) for t, A in sums.items() for j, n in enumerate(numbers[t].tolist()) if A[1, j, 0].any())
        while out := list(islice(found, max(1, SENT_BYTES // (8 * (3 if counts else 2) * d * nb)))):
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary()))],
                                             names=["tree", "node", "sums"])

    def count(batches):
        sums, named, size = {}, {}, 0
        for found in _in_nodes(held, folds, samples, K, rnd, d, batches):
            if found is None:
                continue
            t, m, numbers, B, slot, p, hit = found
            new = _histogram(B, slot, m, nb, *_slopes(p, hit), counts)
            if t in sums:
                sums[t] += new
            else:
                sums[t], named[t] = new, numbers
                size += new.size
            if size > held_cells:
                yield from flush(sums, named)
                sums, size = {}, 0
        if sums:
            yield from flush(sums, named)

    def choose(table: pa.Table) -> pa.Table:
        sums: dict = {}
        for n, s in zip(table.column("node").to_pylist(), table.column("sums")):
            A = np.frombuffer(s.as_buffer(), np.float64).reshape(-1, d, nb)
            sums[n] = sums[n] + A if n in sums else A
        t, nodes = table.column("tree")[0].as_py(), sorted(sums)

        def dense(a, z):
            A = np.stack([sums[n] for n in nodes[a:z]], axis=1)
            return A[0], A[1], A[2] if counts else None

        best = _best_splits(len(nodes), dense, colmask[t], limits[t // K], step, symmetric)
        return _split_table([(t, n, 0, -1, r) for n, r in zip(nodes, best)])

    by = ["tree"] if symmetric else ["tree", "node"]
    n = int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that small levels are not merged into one task
    found = data.mapInArrow(count, _SUMS).repartition(n, *by).groupBy(*by).applyInArrow(choose, _SPLITS).toArrow()
    held.destroy()
    return _split_rows(found)


def _subtrees(data: DataFrame, trees: list[Tree], open_nodes: dict, d: int, nb: int, K: int, models: list[BoostParams], folds: list,
              rnd: int, colmask: np.ndarray, total: int) -> list:
    """All nodes below the open ones: one pass over the round's rows, which go to the task of their (tree, node)."""
    held = _send(data, trees, open_nodes)
    depths = {t: {n: trees[t].depth[n] for n in nodes} for t, nodes in open_nodes.items()}
    samples, slot_cells, spare = [(p.seed, p.subsample) for p in models], SLOT_CELLS, SPARE_LEAVES

    def send(batches):
        for found in _in_nodes(held, folds, samples, K, rnd, d, batches):
            if found is None:
                continue
            t, m, numbers, B, slot, p, hit = found
            order = np.argsort(slot.astype(np.int16) if m < 32768 else slot, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(slot, minlength=m))).tolist()
            B, p, hit = B[:, order], p[order], hit[order]
            out = [(t, n, z - a, B[:, a:z].tobytes(), p[a:z].tobytes(), hit[a:z].tobytes())
                   for n, a, z in zip(numbers.tolist(), ends, ends[1:]) if z > a]
            kinds = [pa.int32()] * 3 + [pa.binary()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)],
                                             names=["tree", "node", "n", "bins", "p", "hit"])

    def grow(table: pa.Table) -> pa.Table:
        t, n = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        part = lambda c, kind: [np.frombuffer(x.as_buffer(), kind) for x in table.column(c)]
        B = np.concatenate([x.reshape(d, -1) for x in part("bins", np.uint8)], axis=1)
        g, h = _slopes(np.concatenate(part("p", np.float64)), np.concatenate(part("hit", bool)))
        p = models[t // K]
        # a part of a leaf-wise tree gets twice its share of the leaves, and some; if the choice wants more below it, a next pass goes on
        p = replace(p, num_leaves=min(p.num_leaves, spare + 2 * p.num_leaves * len(g) // total))
        return _split_table([(t, n, *r) for r in _grow(B, g, h, depths[t][n], p, colmask[t], nb, slot_cells)])

    n = max(int(data.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2000, total * len(open_nodes) * (d + 9) // EXCHANGE_BYTES))
    found = data.mapInArrow(send, _ROWS).repartition(n, "tree", "node").groupBy("tree", "node").applyInArrow(grow, _SPLITS).toArrow()
    held.destroy()
    return _split_rows(found)


def _split_table(rows: list) -> pa.Table:
    cols = list(zip(*[(t, n, at, left, *r) for t, n, at, left, r in rows]))
    return pa.table([pa.array(x, pa.int32() if i < 6 else pa.float64()) for i, x in enumerate(cols)], names=_SPLIT_NAMES)


def _split_rows(found: pa.Table) -> list:
    """(tree, node, number below it, left child below it or -1, ``Found``), in order."""
    found = found.sort_by([("tree", "ascending"), ("node", "ascending"), ("at", "ascending")])
    return [(*x[:4], Found(*x[4:])) for x in zip(*(found.column(c).to_pylist() for c in _SPLIT_NAMES))]


def _hold(df: DataFrame) -> DataFrame:
    """Cached, planned without adaptive execution: an adaptive plan holds its input twice, and as the blocks of a round are made from
    those of the last one, plans (and what the driver keeps of them) would double with every round."""
    with session_setting(df.sparkSession, "spark.sql.adaptive.enabled", "false"):
        return df.cache()


def _prepare(df: DataFrame, cols: list[str], binner: Binner, n_models: int, n_classes: int, label: str, grp: str | None, init: list) -> tuple:
    """The packed rows, cached, and their number; margins are those of the rounds in ``init``."""
    d, T = len(cols), n_models * n_classes
    held = cached(labelled(df, label).select("Id", F.col(label).cast("int").alias("label"), (F.col(grp).cast("int") if grp else F.lit(0)).alias("grp"),
                                             *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)]))
    sent = held.sparkSession.sparkContext.broadcast([m.arrays() for m in init])
    xcols = [f"x{i}" for i in range(d)]
    limit = max(1, min(BLOCK_ROWS, WORK_BYTES // (8 * T)))

    def run(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            B = binner.bins(arrow_matrix(b, xcols)).astype(np.uint8)
            given = [arrow_vector(b, c, t) for c, t in zip(("Id", "label", "grp"), _KINDS)]
            size = -(-n // -(-n // limit))
            for a in range(0, n, size):
                some = B[a:a + size]
                Z = np.zeros((T, len(some)))
                for m, arrays in enumerate(sent.value):
                    add_margins(arrays, some, Z[m * n_classes:(m + 1) * n_classes].T)
                yield from _packed(*(x[a:a + size] for x in given), some.T, Z)

    try:
        out = _hold(held.mapInArrow(run, _BLOCK))
        filled(out, 1)
        return out, int(out.agg(F.sum("n")).first()[0] or 0)
    finally:
        held.unpersist()


def _probabilities(data: DataFrame, d: int, K: int, rnd: int, models: list[BoostParams]) -> DataFrame:
    """Blocks of the rows that some model samples in the round, with class probabilities: what all its passes read."""
    samples = {(p.seed, p.subsample) for p in models}

    def run(batches):
        for ids, y, grp, B, Z in _blocks(batches, d):
            keep = np.logical_or.reduce([_row_sample(ids, seed, rnd, rate) for seed, rate in samples])
            if not keep.all():
                ids, y, grp, B, Z = (x[..., keep] for x in (ids, y, grp, B, Z))
            if len(ids):
                P = Z.reshape(-1, K, len(ids))
                P = np.exp(P - P.max(axis=1, keepdims=True))
                P /= P.sum(axis=1, keepdims=True)
                yield from _packed(ids, y, grp, B, P.reshape(-1, len(ids)))

    out = _hold(data.mapInArrow(run, _BLOCK))
    filled(out, 1)
    return out


def fit_boost(df: DataFrame, cols: list[str], n_classes: int, params: BoostParams, label: str = "label",
              grp: str | None = None, n_models: int = 1, binner: Binner | None = None,
              round_log: list | None = None, init: list[BoostModel] | None = None,
              trials: list[BoostParams] | None = None, keep: bool = True) -> list[BoostModel]:
    """Fit ``n_models`` boosters (one per fold when ``grp`` is given; model m skips rows with grp == m).

    ``round_log`` (if given) receives ``(model, round, holdout_loss)`` tuples (CV only). ``init``: models of the same
    settings whose rounds are kept and continued, up to ``n_rounds`` in all. ``trials``: several settings in place of
    ``params``, each with ``n_models`` models, ordered by trial and then fold; each ends by its own ``n_rounds`` and early stopping.
    ``keep=False``: the models come back without their rounds, for a caller that wants the ``round_log`` only (a search has
    trials x folds x classes trees a round).
    Returns the models, truncated to the best round of their setting when early stopping is on.
    """
    K, d, settings = n_classes, len(cols), trials or [params]
    shared = settings[0]
    if any((p.growth, p.max_bins, p.checkpoint_every) != (shared.growth, shared.max_bins, shared.checkpoint_every) for p in settings):
        raise ValueError("trials of one run share growth, max_bins and checkpoint_every")
    if shared.max_bins > 256:
        raise ValueError("a feature has 256 bins at most")
    if init and trials:
        raise ValueError("only a single setting can be continued")
    cv = grp is not None and n_models > 1
    own = [p for p in settings for _ in range(n_models)]
    folds = [f if cv else None for _ in settings for f in range(n_models)]
    init = init or []
    binner = init[0].binner if init else binner or Binner.fit(df, cols, shared.max_bins)
    nb = binner.n_bins
    ntree = len(own) * K
    data, total = _prepare(df, cols, binner, len(own), K, label, grp, init)
    symmetric, few = shared.growth == "symmetric", RAW_ROWS
    models = [BoostModel(list(cols), binner, K, p, [list(r) for r in m.rounds]) for m, p in zip(init, own)] or \
        [BoostModel(list(cols), binner, K, p) for p in own]
    best = [(math.inf, 0)] * len(settings)
    stopped = [False] * len(settings)
    sent: list = []  # trees that the blocks' lineage needs
    for rnd in range(len(models[0].rounds), max(p.n_rounds for p in settings)):
        live = [not stop and rnd < p.n_rounds for p, stop in zip(settings, stopped)]
        if not any(live):
            break
        colmask = np.ones((ntree, d), dtype=bool)
        for j, p in enumerate(settings):
            if p.colsample < 1.0:
                rng = np.random.RandomState((p.seed * 7919 + rnd) % (1 << 32))
                for t in range(j * n_models * K, (j + 1) * n_models * K):
                    keep = max(1, int(round(p.colsample * d)))
                    colmask[t] = False
                    colmask[t, rng.choice(d, keep, replace=False)] = True
        trees = [Tree() for _ in range(ntree)]
        info: list[dict] = [{} for _ in range(ntree)]    # best split of every node examined
        waiting: dict = {}                               # by tree: nodes whose rows go to one task
        open_nodes: dict = {}                            # by tree: nodes for the next level pass
        for t in range(ntree):
            if live[t // (n_models * K)]:
                (waiting if total <= few else open_nodes)[t] = [0]
        rows = _probabilities(data, d, K, rnd, own)
        while open_nodes or waiting:
            level = bool(open_nodes)
            if level:
                found, open_nodes = _level(rows, trees, open_nodes, d, nb, K, own, folds, rnd, colmask), {}
            else:
                found, waiting = _subtrees(rows, trees, waiting, d, nb, K, own, folds, rnd, colmask, total), {}
            fresh: dict = {}
            placed = {(t, top, 0): top for t, top, *_ in found}
            for t, top, at, left, r in sorted((x for x in found if x[3] >= 0), key=lambda x: (x[0], x[1], x[3])):  # oldest first
                placed[t, top, left], placed[t, top, left + 1] = _split(trees[t], placed[t, top, at], r, own[t // K])
            for t, top, at, left, r in found:
                n, p = placed[t, top, at], own[t // K]
                trees[t].value[n] = float(-p.eta * _soft(r.G, p.reg_alpha) / (r.H + p.reg_lambda))
                info[t][n] = r
                if left < 0:
                    fresh.setdefault(t, []).append(n)
            for t, nodes in fresh.items():
                tr, p = trees[t], own[t // K]
                for n in _to_split(tr, info[t], nodes, p):
                    r = info[t][n]
                    for child, size in zip(_split(tr, n, r, p), (r.CL, r.N - r.CL)):
                        if tr.depth[child] < p.max_depth:
                            (open_nodes if symmetric and level or not symmetric and size > few else waiting).setdefault(t, []).append(child)
        rows.unpersist()
        if shared.growth == "leafwise":
            for t, tr in enumerate(trees):
                tr.prune(set(best_first(tr, info[t], own[t // K].num_leaves, own[t // K].max_depth)))
        for m, model in enumerate(models):
            if keep and live[m // n_models]:
                model.rounds.append(trees[m * K:(m + 1) * K])
        data = _advance(data, d, trees, rnd, shared, sent)
        if cv:
            losses = _holdout_loss(data, d, K, folds)
            for j, p in enumerate(settings):
                if not live[j]:
                    continue
                mine = losses[j * n_models:(j + 1) * n_models]
                if round_log is not None:
                    round_log += [(j * n_models + f, rnd, float(loss)) for f, loss in enumerate(mine)]
                mean = float(np.mean(mine))
                if mean < best[j][0]:
                    best[j] = (mean, rnd)
                elif p.early_stopping_rounds and rnd - best[j][1] >= p.early_stopping_rounds:
                    stopped[j] = True
    data.unpersist()
    for s in sent:
        s.destroy()
    for m, model in enumerate(models):
        if cv and own[m].early_stopping_rounds:
            model.rounds = model.rounds[:best[m // n_models][1] + 1]
    return models


def _advance(data: DataFrame, d: int, trees: list[Tree], rnd: int, p: BoostParams, used: list) -> DataFrame:
    """The blocks with the round's trees added to their margins. ``used`` gets the trees as they were sent, until a checkpoint needs none."""
    sent = data.sparkSession.sparkContext.broadcast([t.arrays() for t in trees])
    used.append(sent)

    def run(batches):
        for ids, y, grp, B, Z in _blocks(batches, d):
            Z = Z.copy()
            for t, a in enumerate(sent.value):
                Z[t] += a[4][descend(a, B, True)] if len(a[0]) > 1 else a[4][0]
            yield from _packed(ids, y, grp, B, Z)

    new = data.mapInArrow(run, data.schema)
    if (rnd + 1) % p.checkpoint_every == 0:
        new = cut_lineage(new)
        while used:
            used.pop().destroy()
    else:
        new = _hold(new)
    filled(new, 1)
    data.unpersist()
    return new


def _holdout_loss(data: DataFrame, d: int, K: int, folds: list) -> np.ndarray:
    M = len(folds)

    def part(b):
        out = np.zeros(2 * M)
        for _, y, g, _, Z in _blocks([b], d):
            for m in range(M):
                rows = np.flatnonzero(g == folds[m])
                if len(rows):
                    P = softmax(Z[m * K:(m + 1) * K, rows].T)
                    out[m] += -np.log(np.clip(P[np.arange(len(rows)), y[rows]], 1e-15, 1)).sum()
                    out[M + m] += len(rows)
        return out

    v = partial_sums(data, 2 * M, part)
    return v[:M] / np.maximum(v[M:], 1)
