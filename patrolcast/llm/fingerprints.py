"""Document fingerprints: a threshold-scaled sketch of a text's shingles.

A text is its set of ``SHINGLE``-word shingles (A-Z lowered; fewer words: the whole sequence), each
hashed to 64 bits. The sketch retains every hash below 2^64 / ``SCALE``: one in ``SCALE`` of all
shingles, always the same ones, whichever text they come from. So a sketch grows with its text, and
of two sketches

* the union, cut at the same threshold, is the sketch of both texts together (``merge``);
* the share of A's hashes that B holds estimates how much of A is contained in B, without bias and
  however unequal the two texts are (``containment``); with the union as the base it estimates
  their Jaccard index (``jaccard``).

A text whose shingles all lie above the threshold (a short one) keeps its smallest hash, so
that only a text without words has an empty sketch. The rule commutes with ``merge``.

``with_next`` sets each row beside its successor by (doc_id, text hash) without a global sort: ids
sampled by hash split the key range into buckets, a row goes to its bucket, and rows that
are a splitter also go to the bucket before, where they stand behind its last row (the first row
of all stands behind the last bucket). Texts are shuffled once; a bucket is sorted and read in a
stream, one row ahead.

Defined results: null counts as an empty text; an empty sketch is contained in another empty
one wholly (1.0) and not at all in or by any other (0.0); null doc_ids count as the largest; rows
sharing a doc_id follow each other by text hash, equal rows directly; a table of one row
is its own successor; texts are taken whole.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, binary_column, lower_ascii, packed, register, table, words

SHINGLE = 5
SCALE = 8
BUCKET_BYTES = 8 << 20
MAX_BUCKETS = 1 << 16  # beyond it buckets hold more; they are read in a stream
PER_BUCKET = 16  # sampled keys a bucket
_LAST = (1 << 63) - 1


class _Words(dict):
    """64-bit hashes of words, kept for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """One hash for each shingle of a UTF-8 text, repeats included."""
    said = words(lower_ascii(raw))
    if not said:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, said), np.uint64, len(said))
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(size, len(h)), np.uint64)
    for i in range(min(size, len(h))):
        out = _mixed(out + h[i:i + n] + np.uint64(0x9E3779B97F4A7C15))
    return out


def _retained(hashes: np.ndarray, scale: int) -> np.ndarray:
    """Of distinct sorted hashes: those below the threshold, or else the smallest."""
    return hashes[:max(1, np.searchsorted(hashes, np.uint64((1 << 64) // scale if scale > 1 else (1 << 64) - 1)))]


def sketch(raw: bytes, scale: int = SCALE, size: int = SHINGLE) -> np.ndarray:
    """The sketch of a UTF-8 text: sorted distinct hashes."""
    return _retained(np.unique(shingle_hashes(raw, size)), scale)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return _retained(np.union1d(a, b), scale)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of a's shingles that b has."""
    return _shared(a, b) / len(a) if len(a) else float(not len(b))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = _shared(a, b)
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def written(a: np.ndarray) -> str:
    """A sketch as text: 16 hex digits a hash."""
    return a.astype(">u8").tobytes().hex()


def read(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def with_next(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows (``_row``, ``text``, ``guard``) partitioned and sorted so that behind each row that is no guard stands
    its successor; guards are copies of a bucket's successor."""
    spark = docs.sparkSession
    src = packed(docs).select(ROW, F.coalesce(f"{ROW}.text", F.lit("")).alias("text"),
                              F.coalesce(F.col(f"{ROW}.doc_id").cast("long"), F.lit(_LAST)).alias("d"))
    src = src.withColumn("h", F.xxhash64("text"))
    key = F.struct("d", "h")
    all_of = src.agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + 64).alias("bytes"), F.min(key).alias("least")).first()
    n_buckets = max(1, min(MAX_BUCKETS, -(-(all_of["bytes"] or 0) // bucket_bytes)))
    one_in = max(1, all_of["n"] // (PER_BUCKET * n_buckets))
    splitters = []
    if n_buckets > 1:
        drawn = src.where(F.pmod(F.xxhash64("d", "h"), F.lit(one_in)) == 0).select("d", "h").distinct()
        drawn = sorted((r["d"], r["h"]) for r in drawn.collect())  # about PER_BUCKET a bucket
        splitters = drawn[PER_BUCKET::PER_BUCKET]
    if all_of["n"]:
        least = (all_of["least"]["d"], all_of["least"]["h"])
        splitters = [least, *(s for s in splitters if s > least)]
    held = spark.sparkContext.broadcast(splitters)

    @F.pandas_udf("array<struct<bucket:int,guard:boolean>>")
    def places(d: pd.Series, h: pd.Series) -> pd.Series:
        cuts = held.value
        out = []
        for k in zip(d.tolist(), h.tolist()):
            b = bisect_right(cuts, k) - 1
            own = [{"bucket": b, "guard": False}]
            out.append([*own, {"bucket": (b - 1) % len(cuts), "guard": True}] if cuts[b] == k else own)
        return pd.Series(out)

    at = src.select(ROW, "d", "h", F.explode(places("d", "h")).alias("place"))
    at = at.select(ROW, "d", "h", "place.bucket", "place.guard").repartitionById(max(1, len(splitters)), "bucket") \
        .sortWithinPartitions("bucket", "guard", "d", "h")
    return at.select(ROW, F.coalesce(f"{ROW}.text", F.lit("")).alias("text"), "guard")  # the text travels once


def half_edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


def fingerprint(docs: DataFrame, scale: int = SCALE, size: int = SHINGLE, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every row of ``docs`` (columns in ``_row``) with ``n_chars``, ``fingerprint``, the ``edited_text`` and its
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` (containment in the edited and the next text)
    and ``jaccard_edited``, ``jaccard_next``."""
    src = with_next(docs, bucket_bytes)
    out = T.StructType([
        src.schema[ROW], T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_text", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next", "jaccard_edited", "jaccard_next")]])
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]

    def compared(batches):
        before = None  # the last row, not yet compared: (row column, text, sketch)
        for b in batches:
            rows = b.column(0)
            done, picked = [], []
            carried = before
            for i, (raw, guard) in enumerate(zip(binary_column(b, "text"), b.column(2).to_pylist())):
                if guard and before is None:
                    continue
                text, own = raw.decode(), sketch(raw, scale, size)
                if before is not None:
                    _, said, mine = before
                    edited = half_edited(said, text)
                    theirs = sketch(edited.encode(), scale, size)
                    done.append((len(said), written(mine), edited, written(theirs), containment(mine, theirs),
                                 containment(mine, own), jaccard(mine, theirs), jaccard(mine, own)))
                    picked.append(before[0])
                before = None if guard else ((rows, i), text, own)
            if done:
                first = 0
                parts = []
                if carried is not None:
                    parts, first = [carried[0][0].slice(carried[0][1], 1)], 1
                if picked[first:]:
                    parts.append(rows.take(pa.array([i for _, i in picked[first:]], pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(parts), *[pa.array(c, k) for c, k in zip(zip(*done), kinds)]], names=out.names)

    return src.mapInArrow(compared, out)


def merged(sketches: DataFrame, by: str, hashes: str, scale: int = SCALE) -> DataFrame:
    """(``by``, hash) rows of the merged sketch of each group, from rows that hold a written sketch: a distinct
    over hashes, so a group is never gathered; a group's smallest hash stays where none is below the threshold."""
    one = sketches.select(F.col(by), F.explode(F.filter(F.split(F.col(hashes), "(?<=\\G.{16})"), lambda h: h != "")).alias("hash"))
    one = one.distinct()
    limit = f"{((1 << 64) // scale) - (scale == 1):016x}"
    least = one.groupBy(by).agg(F.min("hash").alias("least"))
    above = least.where(F.col("least") >= limit).select(by, F.col("least").alias("hash"))
    return one.where(F.col("hash") < limit).unionByName(above)


@register("op12_document_fingerprints")
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint(docs).select(
        F.col(ROW)["doc_id"].alias("doc_id"), "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next", "jaccard_edited", "jaccard_next")
