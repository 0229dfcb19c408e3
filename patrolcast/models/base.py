"""Shared machinery of the model fits.

* ``partial_sums``: one data pass that returns the element-wise sum of a numpy
  vector computed per Arrow batch (gradients, Hessians, moments). Each task
  emits its partition total in fixed-size blocks; ``groupBy(block)`` with a
  vector-sum aggregate reduces them with map-side partial aggregation, so the
  reduction is spread over reducers instead of one task, and the driver only
  receives the final vector.
* ``map_probabilities``: batch scoring with numpy inside ``mapInArrow`` (the
  model is a few small matrices shipped in the closure); output is one
  ``array<double>`` probability column per row.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BLOCK_BYTES, filled

BLOCK = 8192
# Direct collection of per-task partials is allowed up to this many doubles
# (partitions x vector length, 128 MB); above it the blocks are reduced by a
# shuffle and only the reduced vector reaches the driver.
DIRECT_LIMIT = 16_000_000


def arrow_matrix(batch: pa.RecordBatch, cols: list[str]) -> np.ndarray:
    """float64 matrix (rows x cols); NULL -> NaN."""
    if not cols:
        return np.zeros((batch.num_rows, 0))
    names = batch.schema.names
    out = np.empty((batch.num_rows, len(cols)), dtype=np.float64)
    for j, c in enumerate(cols):
        arr = batch.column(names.index(c))
        if pa.types.is_list(arr.type) or pa.types.is_fixed_size_list(arr.type):
            raise TypeError("use arrow_list_matrix for array columns")
        out[:, j] = arr.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return out


def arrow_list_matrix(batch: pa.RecordBatch, col: str) -> np.ndarray:
    """An ``array<double>`` column of equal-length rows as a 2-D matrix."""
    arr = batch.column(batch.schema.names.index(col))
    n = batch.num_rows
    if n == 0:
        return np.zeros((0, 0))
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, -1)


def arrow_vector(batch: pa.RecordBatch, col: str, dtype=np.float64) -> np.ndarray:
    return batch.column(batch.schema.names.index(col)).to_numpy(zero_copy_only=False).astype(dtype, copy=False)


def list_array(m: np.ndarray) -> pa.Array:
    """Rows of a 2-D matrix as an Arrow ``list<double>`` array."""
    n, k = m.shape
    offsets = pa.array(np.arange(0, (n + 1) * k, k, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(m.reshape(-1), pa.float64()))


def partial_sums(df: DataFrame, size: int, fn: Callable[[pa.RecordBatch], np.ndarray],
                 block: int = BLOCK, parts: int | None = None) -> np.ndarray:
    """Sum over all rows of ``fn(batch)`` (a length-``size`` vector per batch). ``parts``: the number of
    partitions, where the caller knows it (asking for it plans the scan once more)."""
    nblocks = max(1, -(-size // block))

    def run(batches: Iterable[pa.RecordBatch]):
        acc = np.zeros(size)
        for b in batches:
            if b.num_rows:
                acc += fn(b)
        for i in range(nblocks):
            chunk = acc[i * block:(i + 1) * block]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), list_array(chunk[None, :])],
                names=["block", "vec"])

    partials = df.mapInArrow(run, "block int, vec array<double>")
    out = np.zeros(size)
    if (df.rdd.getNumPartitions() if parts is None else parts) * size <= DIRECT_LIMIT:
        # few partitions: one stage, the driver adds at most DIRECT_LIMIT numbers
        tbl = partials.toArrow()
        blocks = tbl.column("block").to_numpy()
        vecs = tbl.column("vec").combine_chunks()
        for j, i in enumerate(blocks.tolist()):
            v = vecs[j].values.to_numpy()
            out[i * block:i * block + len(v)] += v
        return out
    rows = partials.groupBy("block").agg(Summarizer.sum(array_to_vector("vec")).alias("s")).collect()
    for r in rows:
        i = r["block"]
        v = r["s"].toArray()
        out[i * block:i * block + len(v)] = v
    return out


def map_probabilities(df: DataFrame, cols: list[str], keep: list[str],
                      predict: Callable[[np.ndarray], np.ndarray], output: str | tuple = "probability",
                      list_col: str | None = None) -> DataFrame:
    """Score with numpy per Arrow batch; keeps ``keep`` columns and adds ``output`` (several names: ``predict``
    returns as many matrices)."""
    src = df.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{c}`") for c in cols if c not in keep],
                    *([F.col(list_col)] if list_col else []))
    fields = [f for f in src.schema.fields if f.name in keep]
    names = [output] if isinstance(output, str) else list(output)
    schema = T.StructType(fields + [T.StructField(n, T.ArrayType(T.DoubleType())) for n in names])

    def run(batches):
        for b in batches:
            X = arrow_list_matrix(b, list_col) if list_col else arrow_matrix(b, cols)
            made = predict(X) if b.num_rows else np.zeros((0, 1)) if len(names) == 1 else [np.zeros((0, 1))] * len(names)
            arrays = [b.column(b.schema.names.index(k)) for k in keep]
            arrays += [list_array(np.asarray(P, dtype=np.float64)) for P in ([made] if isinstance(output, str) else made)]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(
                [pa.field(k, b.schema.field(k).type) for k in keep] + [pa.field(n, pa.list_(pa.float64())) for n in names]))

    return src.mapInArrow(run, schema)


def labelled(df: DataFrame, label: str = "label") -> DataFrame:
    """The rows a fit learns from: those with a class. NULL and unseen labels (code -1) are left out of
    every fit, and of the log loss; scoring keeps all rows."""
    return df.where(F.col(label) >= 0)


PACK_ROWS, PACK_STEP = 8192, 512  # rows of a packed block at most; fewer are a multiple of the step


@dataclass
class Packed:
    """Labelled rows packed for iterative passes: a cached table ``grp, whole, y, x`` whose rows are blocks of up to
    ``PACK_ROWS`` rows (or about ``BLOCK_BYTES``) of one group (labels as int32, features as float64 by row), so that a pass moves a few
    buffers and no single values. ``whole``: no NaN or infinity among the block's features."""
    df: DataFrame
    cols: list
    shift: np.ndarray   # mean of every column (0 where it has none)
    parts: int

    def sums(self, size: int, fn: Callable) -> np.ndarray:
        """Sum over the blocks of the vector that ``fn(group, labels, features, whole, out)`` adds to ``out``."""
        d = len(self.cols)

        def part(b):
            out = np.zeros(size)
            for g, y, X, whole in unpack(b, d):
                fn(g, y, X, whole, out)
            return out

        return partial_sums(self.df, size, part, parts=self.parts)

    def unpersist(self) -> None:
        self.df.unpersist()


def unpack(b: pa.RecordBatch, d: int):
    """(group, labels, features, whole) of every block of a batch."""
    grp, whole, y, x = (b.column(b.schema.names.index(c)) for c in ("grp", "whole", "y", "x"))
    for i in range(b.num_rows):
        ys = np.frombuffer(y[i].as_buffer(), np.int32)
        yield grp[i].as_py(), ys, np.frombuffer(x[i].as_buffer(), np.float64).reshape(len(ys), d), whole[i].as_py()


def packed_rows(df: DataFrame, cols: list[str], label: str = "label", grp: str = "grp", key: str = "Id") -> Packed:
    """The rows with a class, packed; the column form is let go."""
    from pyspark import StorageLevel

    d = len(cols)
    size = max(PACK_STEP, min(PACK_ROWS, BLOCK_BYTES // (8 * d + 4) // PACK_STEP * PACK_STEP))
    held = cached(labelled(df, label).select(*[F.col(f"`{c}`") for c in cols], F.col(label).cast("int").alias("label"),
                                             F.col(grp).cast("int").alias("grp"), *([key] if key in df.columns else [])), key)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            X, y, g = arrow_matrix(b, cols), arrow_vector(b, "label", np.int32), arrow_vector(b, "grp", np.int32)
            for one in np.unique(g):
                rows = np.flatnonzero(g == one)
                for at in range(0, len(rows), size):
                    some = np.ascontiguousarray(X[rows[at:at + size]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([one], pa.int32()), pa.array([bool(np.isfinite(some).all())]),
                         pa.array([y[rows[at:at + size]].tobytes()], pa.binary()), pa.array([some.tobytes()], pa.binary())],
                        names=["grp", "whole", "y", "x"])

    try:
        mean = held.agg(F.lit(0), *[F.avg(F.col(f"`{c}`").cast("double")) for c in cols]).first()[1:]
        shift = np.nan_to_num(np.array(mean, dtype=float)) if d else np.zeros(0)
        out = held.mapInArrow(run, "grp int, whole boolean, y binary, x binary").persist(StorageLevel.MEMORY_AND_DISK)
        filled(out, 1)
        return Packed(out, list(cols), shift, out.rdd.getNumPartitions())
    finally:
        held.unpersist()


def softmax(Z: np.ndarray) -> np.ndarray:
    Z = Z - Z.max(axis=1, keepdims=True)
    E = np.exp(Z)
    return E / E.sum(axis=1, keepdims=True)


def cached(df: DataFrame, key: str = "Id", max_factor: int = 4) -> DataFrame:
    """Materialised in memory (spilling to disk) for iterative passes, with
    between ``defaultParallelism`` and ``max_factor`` x that many partitions.

    Every pass of an iterative fit returns one partial (gradient, histogram) per
    task, so the per-pass traffic grows with the partition count: large inputs
    are merged down (narrow ``coalesce``, no shuffle) to a few tasks per core.

    Small inputs (few file splits, partitions coalesced by AQE) would otherwise
    keep most cores idle in every pass. The partition count is read from the
    materialised cache (asking an un-executed adaptive plan for it would run its
    shuffles); if it is too low the cache is re-spread by a hash of the key,
    which is deterministic, so a partition recomputed after executor loss holds
    the same rows."""
    from pyspark import StorageLevel

    want = df.sparkSession.sparkContext.defaultParallelism
    out = df.coalesce(max_factor * want).persist(StorageLevel.MEMORY_AND_DISK)
    filled(out)
    if key in out.columns and out.rdd.getNumPartitions() < want:
        wide = out.repartition(want, key).persist(StorageLevel.MEMORY_AND_DISK)
        filled(wide)
        out.unpersist()
        return wide
    return out
