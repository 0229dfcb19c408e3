"""SimHash near-dedup with multi-index hashing.

Fingerprint (64 bits): a bit is set if it is set in over half of the XXH64 values (seed 42)
of the text's word shingles, A-Z lowered, repeats included. Two texts link at
``MAX_BITS`` = 3 or fewer differing bits.

Search over the distinct fingerprints: each is cut into two 32-bit segments. Of two
fingerprints within 3 bits at least one segment differs in at most one bit, so each enters
the segment tables under its own segment values and probes, per segment, the Hamming ball
of radius 1: its own value and those with one more bit set (the pair's other member reaches
the rest). Rows of one key meet in one task, sorted, and full distances are verified there.
A key with over ``LIMIT`` rows is never gathered: its rows go to a second index that adds
16 of the other segment's bits (again exact or one bit off) to the key, which leaves 16 free
bits, hence at most 2^16 distinct fingerprints under an exact key. A bucket
returns a spanning forest of its links, never all pairs; components are then joined up by
star contraction on the cluster.

Defined results: a text without words (null included) has fingerprint zero and links like
any other; fewer words than a shingle: the whole sequence is the one shingle; a tie (exactly
half) leaves the bit unset; null doc_ids never become a component_id unless a component
has no other; repeated rows are returned as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, lower_ascii, materialise, register, table, unpacked
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
LIMIT = 8192
_CHUNK = 16_384


def fingerprint(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = lower_ascii(raw).split() if raw else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(start[at:to].tolist(), end[at + shingle - 1:to + shingle - 1].tolist())], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``fp``: the text's fingerprint, its bits as a signed long."""
    rest = [c for c in docs.columns if c != text]
    src = docs.select(*rest, F.col(text).cast("string").alias("_text"))
    fields = [src.schema[c] for c in rest] + [T.StructField("fp", T.LongType())]

    def run(batches):
        for b in batches:
            texts = b.column(len(rest)).cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(fp)], names=[*rest, "fp"])

    return src.mapInArrow(run, T.StructType(fields))


def forest(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among distinct fingerprints: (parents, children) pieces."""
    left, out = fps, []
    while left.size > 1:
        front, left = left[:1], left[1:]
        while front.size and left.size:
            parent = np.zeros(left.size, dtype=np.uint64)
            hit = np.zeros(left.size, dtype=bool)
            step = max(1, (1 << 22) // left.size)
            for at in range(0, front.size, step):
                part = front[at:at + step]
                near = np.bitwise_count(part[:, None] ^ left[None, :]) <= max_bits
                new = near.any(axis=0) & ~hit
                parent[new] = part[near[:, new].argmax(axis=0)]
                hit |= new
            if hit.any():
                out.append((parent[hit], left[hit]))
            front, left = left[hit], left[~hit]
    return out


def _ball(fp: np.ndarray, base: np.ndarray, shift: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) rows: the segment's own value and each value with one more bit set."""
    seg = (fp >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    masks = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    row, bit = np.nonzero((seg[:, None] & masks[None, :]) == 0)
    return (np.concatenate([base | seg, base[row] | seg[row] | masks[bit]]), np.concatenate([fp, fp[row]]))


_CAND = T.StructType([T.StructField(c, T.LongType()) for c in ("k1", "k2", "fp")])
_FOUND = T.StructType([T.StructField("deferred", T.BooleanType()),
                       *[T.StructField(c, T.LongType()) for c in ("k1", "k2", "a", "b")]])


def _batch(arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in arrays], names=names)


def segment_rows(fps: DataFrame) -> DataFrame:
    """Level 1: key (segment number, 32-bit value)."""
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fp), 50_000):
                part = fp[at:at + 50_000]
                for seg, shift in ((0, 0), (1, 32)):
                    key, f = _ball(part, np.full(len(part), seg << 32, dtype=np.uint64), shift, 32)
                    yield _batch([key, np.zeros(len(key), dtype=np.uint64), f], ["k1", "k2", "fp"])

    return fps.select("fp").mapInArrow(run, _CAND)


def refined_rows(deferred: DataFrame) -> DataFrame:
    """Level 2: the key of level 1 plus (half, 16-bit value) of the other segment."""
    def run(batches):
        for b in batches:
            key, fp = (b.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            low = (key >> np.uint64(32)) == 0  # the key holds the low segment: refine by the high one
            for other, mine in ((32, low), (0, ~low)):
                for half in (0, 16):
                    part = fp[mine]
                    sub, f = _ball(part, np.full(len(part), half << 16, dtype=np.uint64), other + half, 16)
                    k = key[mine]
                    seg_free = np.concatenate([k, np.repeat(k, np.bitwise_count(
                        ~(part >> np.uint64(other + half)) & np.uint64(0xFFFF)).astype(np.int64))])
                    yield _batch([seg_free, sub, f], ["k1", "k2", "fp"])

    return deferred.select("k1", F.col("a").alias("fp")).mapInArrow(run, _CAND)


def links(cand: DataFrame, limit: int | None, max_bits: int = MAX_BITS) -> DataFrame:
    """Verified links among the rows of each key; rows of keys over ``limit`` come back as deferred."""
    def run(batches):
        held_key, held = None, np.zeros(0, dtype=np.uint64)  # the group at the batch's end may go on
        over = False

        def found(fps):
            return forest(np.unique(fps), max_bits) if len(fps) > 1 else []

        def later(key, fps):
            n = len(fps)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(n, dtype=bool)), pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])),
                 pa.array(fps.view(np.int64)), pa.array(np.zeros(n, dtype=np.int64))], names=_FOUND.names)

        def edges(pieces):
            if pieces:
                a = np.concatenate([p[0] for p in pieces]).view(np.int64)
                c = np.concatenate([p[1] for p in pieces]).view(np.int64)
                z = np.zeros(len(a), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(z.astype(bool)), pa.array(z), pa.array(z), pa.array(a),
                                                  pa.array(c)], names=_FOUND.names)

        for b in batches:
            if not b.num_rows:
                continue
            k1, k2, fp = (b.column(i).to_numpy() for i in range(3))
            fp = fp.view(np.uint64)
            cut = np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1
            begin = np.concatenate([[0], cut])
            end = np.concatenate([cut, [len(fp)]])
            pieces = []
            multi = np.flatnonzero(end - begin > 1)
            for g in sorted({0, len(begin) - 1, *multi.tolist()}):
                s, e = begin[g], end[g]
                key, part = (int(k1[s]), int(k2[s])), fp[s:e]
                first, last = g == 0, g == len(begin) - 1
                if first and key == held_key:
                    if over:
                        yield later(key, part)
                        if not last:
                            held_key, over = None, False
                        continue
                    part = np.concatenate([held, part])
                    held_key = None
                elif first and held_key is not None:
                    pieces += found(held)
                    held_key, over = None, False
                if limit and len(part) > limit:
                    yield later(key, part)
                    if last:
                        held_key, held, over = key, part[:0], True
                elif last:
                    held_key, held, over = key, part, False
                else:
                    pieces += found(part)
            yield from edges(pieces)
        if held_key is not None and not over:
            yield from edges(found(held))

    together = cand.repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    return together.mapInArrow(run, _FOUND)


def link_components(fps: DataFrame, max_bits: int = MAX_BITS, limit: int = LIMIT) -> DataFrame:
    """(node, root) over distinct fingerprints ``fp`` that have a link."""
    if max_bits > 3:
        raise ValueError("two segments with balls of radius 1 find links of up to 3 bits")
    first = materialise(links(segment_rows(fps), limit, max_bits))
    second = links(refined_rows(first.where("deferred")), None, max_bits)
    pairs = first.where(~F.col("deferred")).select("a", "b").unionByName(second.select("a", "b"))
    return components(pairs)


def near_groups(marked: DataFrame, max_bits: int = MAX_BITS, limit: int = LIMIT) -> DataFrame:
    """(fp, first) for rows (fp, id): ``first`` is the smallest non-null ``id`` (any ordered type) of the
    component that holds ``fp``."""
    per = marked.groupBy("fp").agg(F.min("id").alias("id"))
    roots = link_components(per.select("fp"), max_bits, limit)
    rooted = per.join(roots, per.fp == roots.node, "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("id").alias("first"))
    return rooted.join(low, "root").select("fp", "first")


@register("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = materialise(with_fingerprint(docs))
    first = near_groups(marked.select("fp", F.col("doc_id").alias("id")))
    return marked.join(first, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component stays, the one with the smallest doc_id (of several
    rows with that doc_id the one with the smallest row hash, of equal rows one)."""
    text, doc_id = (next(c for c in docs.columns if c.lower() == n) for n in ("text", "doc_id"))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW),
                        F.xxhash64(*hashed).alias("r1"), F.xxhash64(F.lit("row"), *hashed).alias("r2"))
    rows = keyed.select(F.col(ROW)[doc_id].alias("doc_id"), "r1", "r2", F.col(ROW)[text].alias("text"))
    marked = materialise(with_fingerprint(rows))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2")
    kept = near_groups(marked.select("fp", order.alias("id"))).select("first.r1", "first.r2").distinct()
    found = keyed.join(kept, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"])
    return unpacked(found, docs.columns)
