"""Hard negatives by Fagin's threshold algorithm, over shards of an index of sorted lists.

Vectors become integers, floor(256 x) a component; scores are exact integer inner products. An
anchor's positives are its ``K_POS`` best other rows of the same label. Each positive's score p opens a
window: rows of other labels that score from ``LOW`` to ``HIGH`` per cent of p. The window's
``K_NEG`` best rows are its hard negatives.

Rows are range-partitioned by (label, id hash) and held in shards of at most ``CELLS`` components. A
shard has one list per dimension, its rows sorted by that component. An anchor reads the lists
of its non-zero dimensions from the top where its own component is positive and from the bottom where it is negative,
in rounds of doubling depth. Rows met for the first time are scored at once by random access. The inner
product of the anchor with the last components read bounds every row not yet met (the
threshold). The anchor stops in this shard when the threshold is strictly below the kth score (the
window's lower end, while a window has fewer than k rows): an equal score
could still belong to a smaller id. If fewer rows are left than the next round would read, they are scored outright.

Anchors are the stated query set. They are dealt into blocks of ``BLOCK`` components by
an id hash; a block is sent to all shards, which return at most k rows for an anchor or window; the best k of those are
chosen by a window over (anchor, window) with Spark's group limit. A block's results are written to
the shared folder before the next block starts. No pair of rows leaves a shard but these.

Within a shard rows of one label and equal integers are one candidate with its smallest ids (as many as
a result can name): they have the same score for every anchor, so larger ids cannot be returned, and a
vector that a third of all rows share is scored once a shard.

Defined results: rows with a null id, a null label, a null vector or a null or non-finite component take no
part; so do rows whose squared norm of 256 x is 2^62 or more (their scores would not fit a long);
vectors of different lengths are compared as if filled up with zeros, an empty vector scores 0; "other" rows have another id;
equal rows (id, label, integers) count once as candidates; a repeated anchor row is one anchor, rows that share an id but
differ are anchors of their own, told apart by ``anchor_key``; an anchor without positives or a window without rows returns none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import checkpoint_dir, materialise, register, table

K_POS = 5
K_NEG = 3
LOW, HIGH = 50, 95  # per cent of the positive's score
SCALE = 256
CELLS = 1 << 22
MIN_CELLS = 1 << 16
BLOCK = 1 << 21
FIRST = 16  # entries of a list read in the first round
_EXACT = 1 << 53


def quantised(df: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """``id, label, v`` of the rows that take part."""
    big = F.transform(vector, lambda x: x.cast("double") * SCALE)
    norm = F.aggregate(big, F.lit(0.0), lambda s, x: s + x * x)  # null or not a number if a component is
    fits = F.coalesce(~F.isnan(norm) & (norm < float(1 << 62)), F.lit(False))
    kept = df.where(vec_id.isNotNull() & label.isNotNull() & vector.isNotNull() & fits)
    return kept.select(vec_id.cast("long").alias("id"), label.cast("long").alias("label"),
                       F.transform(big, lambda x: F.floor(x).cast("long")).alias("v"))


def matrix(vectors: list | pa.Array, width: int | None = None) -> np.ndarray:
    """Integer rows of one width, filled up with zeros."""
    col = vectors if isinstance(vectors, (pa.Array, pa.ChunkedArray)) else pa.array(vectors, pa.list_(pa.int64()))
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    sizes = np.asarray(col.value_lengths().fill_null(0)).astype(np.int64)
    out = np.zeros((len(sizes), max(width or 0, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = np.asarray(col.flatten())
    return out


class Lists:
    """Rows of one shard with a list per dimension, sorted by component."""

    def __init__(self, x: np.ndarray):
        self.n, self.width = x.shape
        self.rows = x
        self.order = np.argsort(x, axis=0, kind="stable").T.astype(np.int32).copy()
        self.norm = float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)))
        self.most = np.abs(x).max(axis=0, initial=0).astype(np.float64)
        self.real = x.astype(np.float64)

    def scores(self, at: np.ndarray, a: np.ndarray, exact: bool) -> np.ndarray:
        """Inner products of rows with an anchor; doubles hold them exactly where no sum can pass 2^53."""
        if exact:
            return (self.real[at] @ a).astype(np.int64)
        return self.rows[at] @ a.astype(np.int64)  # |score| and all partial sums < 2^62 by the norms

    def access(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Rounds: (rows met first, their scores, threshold of all rows not met; None: all met)."""
        anchor = anchor[:self.width]
        a = anchor.astype(np.float64)
        exact = float(np.sqrt((a * a).sum())) * self.norm < _EXACT and float(np.abs(a) @ self.most[:len(a)]) < _EXACT
        a = np.pad(a if exact else anchor, (0, self.width - len(a)))
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        met = np.zeros(self.n, bool)
        left, depth, step = self.n, 0, FIRST
        while left:
            if (len(up) + len(down)) * step >= left or depth + step >= self.n:
                new = np.flatnonzero(~met)
                yield new, self.scores(new, a, exact), None
                return
            to = depth + step
            read = np.zeros(self.n, bool)
            read[self.order[up, self.n - to:self.n - depth]] = True
            read[self.order[down, depth:to]] = True
            new = np.flatnonzero(read & ~met)
            met |= read
            left -= len(new)
            last = np.zeros(self.width, np.int64)
            last[up] = self.rows[self.order[up, self.n - to], up]
            last[down] = self.rows[self.order[down, to - 1], down]
            bound = int(a @ last) if exact else sum(int(x) * int(y) for x, y in zip(a, last))
            yield new, self.scores(new, a, exact), bound if left else None
            depth, step = to, 2 * step


class Shard:
    """Rows of a shard: equal rows of a label merged, ids ascending in each candidate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, most_ids: int):
        cells = np.ascontiguousarray(np.column_stack([labels, x]))
        _, at, code = np.unique(cells.view(np.dtype((np.void, cells.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
        order = np.lexsort((ids, code))
        code, ids = code[order], ids[order]
        new = np.append(True, (np.diff(code) != 0) | (np.diff(ids) != 0)) if len(ids) else np.zeros(0, bool)
        code, ids = code[new], ids[new]
        rank = np.arange(len(code)) - np.searchsorted(code, code)
        code, ids = code[rank < most_ids], ids[rank < most_ids]
        self.labels, rows = labels[at], x[at]
        by_label = np.argsort(self.labels, kind="stable")
        new_code = np.empty(len(at), np.int64)
        new_code[by_label] = np.arange(len(at))
        order = np.argsort(new_code[code], kind="stable")
        self.ids, self.labels, self.rows = ids[order], self.labels[by_label], rows[by_label]
        self.starts = np.searchsorted(new_code[code][order], np.arange(len(at) + 1))
        self.all = Lists(self.rows)
        self.of_label: dict[int, tuple[int, Lists]] = {}

    def own(self, label: int) -> tuple[int, Lists] | None:
        """First candidate and lists of one label's rows."""
        if label not in self.of_label:
            first, end = np.searchsorted(self.labels, [label, label + 1])
            self.of_label[label] = (int(first), Lists(self.rows[first:end])) if end > first else None
        return self.of_label[label]

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int, but: int | None = None) -> list[tuple[int, int]]:
        """(id, score) of the first k, higher scores first, ties by id; ``but``: an id left out."""
        if len(rows) > 4 * k + 16:  # what scores below the k-th candidate (one may be the one left out) is out
            cut = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
            rows, scores = rows[scores >= cut], scores[scores >= cut]
        found = [(-int(s), int(i)) for r, s in zip(rows, scores) for i in self.ids[self.starts[r]:self.starts[r + 1]] if i != but]
        return [(i, -s) for s, i in sorted(found)[:k]]

    def positives(self, anchor: np.ndarray, vec_id: int, label: int, k: int = K_POS) -> list[tuple[int, int]]:
        if (lists := self.own(label)) is None:
            return []
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        found: list = []
        for new, got, bound in lists[1].access(anchor):
            rows, scores = np.append(rows, new + lists[0]), np.append(scores, got)
            found = self.best(rows, scores, k, vec_id)
            if bound is None or len(found) == k and bound < found[-1][1]:
                break
        return found

    def negatives(self, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], k: int = K_NEG) -> list[list]:
        """For each window (lowest, highest score) its first k rows of other labels."""
        found: list = [[] for _ in windows]
        if not windows or self.labels[0] == label == self.labels[-1]:
            return found
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = min(w[0] for w in windows)
        for new, got, bound in self.all.access(anchor):
            use = (self.labels[new] != label) & (got >= least)
            rows, scores = np.append(rows, new[use]), np.append(scores, got[use])
            done = True
            for w, (low, high) in enumerate(windows):
                inside = (scores >= low) & (scores <= high)
                found[w] = self.best(rows[inside], scores[inside], k)
                done = done and (bound is None or bound < (found[w][-1][1] if len(found[w]) == k else low))
            if done:
                break
        return found


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _shards(batches, cells: int, most_ids: int) -> Iterator[Shard]:
    """The rows of a partition as shards of bounded size."""
    def built(parts):
        x = [matrix(p.column(2)) for p in parts]
        width = max(m.shape[1] for m in x)
        return Shard(np.concatenate([np.asarray(p.column(0)) for p in parts]), np.concatenate([np.asarray(p.column(1)) for p in parts]),
                     np.vstack([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in x]), most_ids)

    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        per = max(1, int(np.asarray(b.column(2).value_lengths()).max()))
        for at in range(0, b.num_rows, max(1, cells // per)):
            part = b.slice(at, max(1, cells // per))
            if held and size + part.num_rows * per > cells:
                yield built(held)
                held, size = [], 0
            held.append(part)
            size += part.num_rows * per
    if held:
        yield built(held)


_POS = "anchor int, positive_id long, positive_score long"
_NEG = "anchor int, positive_id long, positive_score long, negative_id long, negative_score long"


def mine(rows: DataFrame, anchors: DataFrame, k_pos: int = K_POS, k_neg: int = K_NEG, low: int = LOW, high: int = HIGH,
         cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, anchor_key`` for ``anchors``, a part
    of ``rows``; both as ``id, label, v``."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.size("v") + 1).alias("cells")).first()["cells"] or 0
    n_shards = max(1, -(-size // cells), min(2 * spark.sparkContext.defaultParallelism, -(-size // MIN_CELLS)))
    index = materialise(rows.repartitionByRange(n_shards, "label", F.xxhash64("id"), "id"))
    anchors = materialise(anchors.distinct().withColumn("key", F.xxhash64("id", "label", "v")))
    size = anchors.agg(F.sum(F.size("v") + 1).alias("cells")).first()["cells"] or 0
    n_blocks = max(1, -(-size // block))
    base = f"{checkpoint_dir(spark)}/hard-negatives-{uuid.uuid4().hex}"
    most_ids = max(k_pos + 1, k_neg)

    def first_of(found: DataFrame, k: int, by: list[str], score: str, vec_id: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(vec_id))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    for number in range(n_blocks):
        mine_now = anchors.where(F.pmod(F.xxhash64("key"), F.lit(n_blocks)) == number).toArrow()
        ids, labels, keys = (np.asarray(mine_now.column(c)) for c in ("id", "label", "key"))
        asked = spark.sparkContext.broadcast((ids.tolist(), labels.tolist(), matrix(mine_now.column("v"))))

        def positives(batches):
            ids, labels, x = asked.value
            by_label: dict = {}
            for n, y in enumerate(labels):
                by_label.setdefault(y, []).append(n)
            for shard in _shards(batches, cells, most_ids):
                out = [(n, i, s) for y in np.unique(shard.labels).tolist() for n in by_label.get(y, ())
                       for i, s in shard.positives(x[n], ids[n], y, k_pos)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                    names=["anchor", "positive_id", "positive_score"])

        best = first_of(index.mapInArrow(positives, _POS), k_pos, ["anchor"], "positive_score", "positive_id").toArrow()
        goals: dict = {}  # of this block's anchors, at most k_pos each
        for n, i, s in zip(*(best.column(c).to_pylist() for c in ("anchor", "positive_id", "positive_score"))):
            goals.setdefault(n, []).append((i, s))
        wanted = spark.sparkContext.broadcast(goals)

        def negatives(batches):
            _, labels, x = asked.value
            for shard in _shards(batches, cells, most_ids):
                out = []
                for n, of in wanted.value.items():
                    windows = list(dict.fromkeys(w for _, s in of if (w := window(s, low, high))[0] <= w[1]))
                    found = dict(zip(windows, shard.negatives(x[n], labels[n], windows, k_neg)))
                    out += [(n, i, s, j, t) for i, s in of for j, t in found.get(window(s, low, high), ())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int32(), *[pa.int64()] * 4))],
                    names=["anchor", "positive_id", "positive_score", "negative_id", "negative_score"])

        chosen = first_of(index.mapInArrow(negatives, _NEG), k_neg, ["anchor", "positive_id"], "negative_score", "negative_id")
        named = spark.createDataFrame(pa.table({"anchor": pa.array(np.arange(len(ids)), pa.int32()), "anchor_id": pa.array(ids, pa.int64()),
                                                "anchor_key": pa.array(keys, pa.int64())}), "anchor int, anchor_id long, anchor_key long")
        chosen.join(F.broadcast(named), "anchor").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score",
            "anchor_key").write.parquet(f"{base}/block-{number}")
        for b in (asked, wanted):
            b.unpersist()
    return spark.read.parquet(*[f"{base}/block-{n}" for n in range(n_blocks)])


OP11_SQL = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label AS label, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM e a, e b WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own = label AND id <> anchor_id
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {K_POS})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE own <> label AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= {K_NEG}
"""


@register("op11_hard_negatives", OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = quantised(given, F.col("vec_id"), label, F.col("embedding"))
    return mine(rows, rows.where(F.col("id") % 50 == 0)).drop("anchor_key")
