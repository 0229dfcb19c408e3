"""Exact substring dedup over sparse suffixes, range-partitioned and sorted in buckets.

A byte is removed if a ``LENGTH``-byte string that covers it also starts anywhere else in the
corpus. Not every suffix is sorted: a ``LENGTH``-byte string is represented by its anchor,
the leftmost ``GRAM``-byte gram in it with the smallest hash (equal strings have equal
anchors at equal offsets), so about one suffix in a hundred is enough and no string is
missed. Consecutive string starts with one anchor form a record: a stretch of text with all
those strings.

1. Anchors whose gram occurs once in the corpus end here (counts by gram, map-side combined).
2. Records with equal text are collapsed into one with a count: all strings of a record
   that occurs twice or more are repeated. Large groups of copies become one row per task.
3. What is left are different records around one gram. Their suffixes, from the anchor on, are
   range-partitioned by leading bytes (sampled splitters). A bucket sorts its suffixes by
   multikey sort, eight bytes at a time, and compares the strings of neighbours that share the
   gram. A gram with over ``GROUP`` different records (a passage in a third of all documents) is
   split by the records' hashes, so that it spreads over buckets, and its strings are compared
   across the bucket boundaries by their hashes, each once per bucket.
4. Repeated starts turn into byte ranges per text, and the texts are cut.

Grams, records and strings are compared by polynomial hashes over random byte values: two
independent ones of 64 bits each for records and strings, the gram's with its sorted bytes.
Texts are keyed by 128-bit hashes; equal texts share their records and their result.

Defined results: null counts as an empty text (0 bytes); texts under ``LENGTH`` bytes lose
nothing; repeated rows are copies of each other, so texts of ``LENGTH`` bytes or more that
occur twice are removed whole; texts are cut as bytes and may be cut inside a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, keep, key_bitmap, materialise, packed, register, table, text_key

LENGTH = 400
GRAM = 200
SHARD = 1 << 19  # bytes worked on together; longer texts are worked through in pieces of this size
GROUP = 10_000  # different records around one gram that a bucket takes; larger groups are split
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, size=(2, 256), dtype=np.uint64)


class Powers:
    """Powers of the two bases and of their inverses modulo 2^64, grown as needed."""

    _size = 0

    @classmethod
    def upto(cls, n: int):
        if cls._size < n:
            cls._size = max(n, 2 * cls._size)
            cls.up, cls.down = [], []
            for base in _BASES:
                inverse = np.uint64(pow(int(base), -1, 1 << 64))
                for held, b in ((cls.up, base), (cls.down, inverse)):
                    x = np.full(cls._size, b, dtype=np.uint64)
                    x[0] = 1
                    held.append(np.cumprod(x, dtype=np.uint64))
        return cls


def prefix_sums(data: np.ndarray, which: int) -> np.ndarray:
    p = Powers.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[which][data] * p.up[which][:len(data)], out=out[1:])
    return out


def string_hash(sums: np.ndarray, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[start]) * Powers.down[which][start]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours (block-wise prefix and suffix minima)."""
    n = len(x) - w + 1
    full = -(-len(x) // w) * w
    padded = np.full(full, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def records(data: np.ndarray, text_start: np.ndarray, text_end: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Records of concatenated texts of ``length`` bytes or more: text number, first start and number of starts, offset of the anchor
    from the first start (positions in ``data``), gram and record hash."""
    sums0, sums1 = prefix_sums(data, 0), prefix_sums(data, 1)
    at = np.arange(len(data) - gram + 1)
    grams = (sums0[gram:] - sums0[:-gram]) * Powers.down[0][:len(at)]
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchor = (sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, dtype=np.int8)  # starts whose string ends inside the text
    np.add.at(valid, text_start, 1)
    np.add.at(valid, text_end - length + 1, -1)
    start = np.flatnonzero(np.cumsum(valid[:-1]))
    a = anchor[start]
    cut = np.flatnonzero((np.diff(a) != 0) | (np.diff(start) != 1)) + 1
    lo = start[np.concatenate([[0], cut])]
    n = np.diff(np.concatenate([[0], cut, [len(start)]]))
    mid = a[np.concatenate([[0], cut])]
    text = np.searchsorted(text_start, lo, side="right") - 1
    return text, lo, n, mid - lo, grams[mid], string_hash(sums1, 1, lo, lo + n + length - 1)


def pieces(texts: list[bytes | None], length: int, shard: int = SHARD):
    """(buffer, row of each piece, its start in the buffer, its end, offset in its text) shards; pieces of one
    long text overlap so that every string lies in exactly one piece's starts."""
    held, size = [], 0
    for row, t in enumerate(texts):
        n = len(t) if t else 0
        if n < length:
            continue
        for off in range(0, n - length + 1, shard):
            part = t[off:off + shard + length - 1]
            held.append((row, off, part))
            size += len(part)
            if size >= shard:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held):
    end = np.cumsum([len(p) for _, _, p in held])
    start = end - [len(p) for _, _, p in held]
    return (np.frombuffer(b"".join(p for _, _, p in held), dtype=np.uint8), np.array([r for r, _, _ in held]),
            start, end, np.array([o for _, o, _ in held]))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64, copy=False))


def _schema(names: list[str], *more: T.StructField) -> T.StructType:
    return T.StructType([T.StructField(c, T.LongType()) for c in names] + list(more))


def gram_rows(src: DataFrame) -> DataFrame:
    """One row per record: the gram's hash."""
    def run(batches):
        for b in batches:
            for data, _, start, end, _ in pieces(b.column(0).cast(pa.binary()).to_pylist(), LENGTH):
                yield pa.RecordBatch.from_arrays([_long(records(data, start, end)[4])], names=["g"])

    return src.select("text").mapInArrow(run, _schema(["g"]))


def record_rows(src: DataFrame, bitmap, mask: int, with_bytes: bool) -> DataFrame:
    """Records whose gram (or, with bytes, whose place) may be among those of the bitmap."""
    names = ["k1", "k2", "lo"] if with_bytes else ["g", "off", "n", "c", "k1", "k2", "lo"]
    more = [T.StructField("bytes", T.BinaryType())] if with_bytes else []

    def run(batches):
        bits = np.frombuffer(bitmap.value, dtype=np.uint8)
        for b in batches:
            k1, k2 = b.column(1).to_numpy(), b.column(2).to_numpy()
            for data, row, start, end, base in pieces(b.column(0).cast(pa.binary()).to_pylist(), LENGTH):
                text, lo, n, off, g, c = records(data, start, end)
                place = lo - start[text] + base[text]
                r = row[text]
                key = place_key(k1[r], place) if with_bytes else g
                pos = (key & np.uint64(mask)).astype(np.int64)
                hit = (bits[pos >> 3] >> (pos & 7).astype(np.uint8) & 1).astype(bool)
                out = [_long(x[hit]) for x in ([k1[r], k2[r], place] if with_bytes else [g, off, n, c, k1[r], k2[r], place])]
                if with_bytes:
                    raw = data.tobytes()
                    out.append(pa.array([raw[a:a + m + LENGTH - 1] for a, m in zip(lo[hit].tolist(), n[hit].tolist())],
                                        pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=[*names, *[f.name for f in more]])

    return src.select("text", "k1", "k2").mapInArrow(run, _schema(names, *more))


def place_key(k1: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """A hash of a record's place; ``place_column`` is the same in Spark."""
    x = k1.view(np.uint64) ^ (lo.astype(np.uint64) * np.uint64(0x9E3779B1))
    return x ^ (x >> np.uint64(29))


def place_column():
    x = F.col("k1").bitwiseXOR(F.col("lo") * F.lit(0x9E3779B1))
    return x.bitwiseXOR(F.shiftrightunsigned(x, 29))


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a matrix of 8-byte words, most significant word first, refining ties word by
    word; and a flag for rows equal to the one before them in that order."""
    order = np.argsort(words[:, 0], kind="stable")
    lead = words[order, 0]
    same = np.concatenate([[False], lead[1:] == lead[:-1]])
    for j in range(1, words.shape[1]):
        tied = same | np.concatenate([same[1:], [False]])
        at = np.flatnonzero(tied)
        if not at.size:
            break
        group = np.cumsum(~same)[at]
        rows = order[at]
        fine = np.lexsort((words[rows, j], group))
        order[at] = rows[fine]
        w = words[order[at], j]
        equal = np.concatenate([[False], (w[1:] == w[:-1]) & (group[1:] == group[:-1])])
        same[at] &= equal
    return order, same


def start_hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray, part: np.ndarray, length: int) -> list[np.ndarray]:
    """Both hashes of every string of the records in ``part``, some records at a time (they do not depend on place)."""
    out: list[list] = [[], []]
    upto = np.cumsum(size[part])
    at = 0
    while at < len(part):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SHARD, side="right")))
        some = np.concatenate([data[begin[r]:begin[r] + size[r]] for r in part[at:to]])
        n = size[part[at:to]]
        ok = np.ones(len(some), dtype=bool)
        end = np.cumsum(n)
        ok[(end[:, None] - np.arange(1, length)).reshape(-1)] = False  # no string of ``length`` begins there
        p = np.flatnonzero(ok)
        for i in (0, 1):
            out[i].append(string_hash(prefix_sums(some, i), i, p, p + length))
        at = to
    return [np.concatenate(x) for x in out]


def repeated_starts(texts: list[bytes], split: np.ndarray, off: np.ndarray, n: np.ndarray, alone: np.ndarray,
                    length: int = LENGTH, gram: int = GRAM):
    """Bucket-local comparison. Returns (record, first, last) runs of repeated starts of the records that occur
    alone, and the strings of groups that go on in other buckets (``split``): (h0, h1, offset from anchor, record,
    start), record -1 where the string is settled already."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(size) - size
    words = np.empty((len(texts), gram // 8), dtype=np.uint64)
    lead = begin + off
    for j in range(gram // 8):
        words[:, j] = np.ascontiguousarray(data[lead[:, None] + np.arange(8 * j, 8 * j + 8)]).view(">u8")[:, 0]
    order, same = multikey_sort(words)
    group = np.empty(len(texts), dtype=np.int64)
    group[order] = np.cumsum(~same) - 1
    members = np.bincount(group)
    del words
    use = np.flatnonzero((members[group] > 1) | split)
    use = use[np.argsort(group[use], kind="stable")]
    runs, edges, at = [], [], 0
    upto = np.cumsum(n[use])
    while at < len(use):
        base = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, base + (1 << 19), side="right")))
        while to < len(use) and group[use[to]] == group[use[to - 1]]:  # a group stays whole
            to += 1
        part = use[at:to]
        at = to
        rec = np.repeat(part, n[part])
        s = np.arange(len(rec)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        h = start_hashes(data, begin, size, part, length)
        o = off[rec] - s
        by = np.lexsort((h[1], h[0], o, group[rec]))
        equal = np.zeros(len(rec), dtype=bool)
        pair = ((group[rec][by][1:] == group[rec][by][:-1]) & (o[by][1:] == o[by][:-1])
                & (h[0][by][1:] == h[0][by][:-1]) & (h[1][by][1:] == h[1][by][:-1]))
        equal[by[1:][pair]] = True
        first_of = np.ones(len(rec), dtype=bool)
        first_of[by[1:][pair]] = False
        equal[by[:-1][pair]] = True
        mark = np.flatnonzero(equal & alone[rec])
        if mark.size:
            gap = np.flatnonzero((np.diff(rec[mark]) != 0) | (np.diff(s[mark]) != 1)) + 1
            head, tail = np.concatenate([[0], gap]), np.concatenate([gap, [len(mark)]]) - 1
            runs.append((rec[mark[head]], s[mark[head]], s[mark[tail]]))
        far = np.flatnonzero(split[rec] & first_of)
        if far.size:
            edges.append((h[0][far], h[1][far], o[far], np.where(equal[far] | ~alone[rec[far]], -1, rec[far]), s[far]))
    join = lambda parts, k: [np.concatenate([p[i] for p in parts]) for i in range(k)] if parts else None
    return join(runs, 3), join(edges, 5)


_OUT = ["kind", "k1", "k2", "first", "last", "h0", "h1", "o"]


def bucket_rows(found: DataFrame) -> DataFrame:
    """Range-partitioned suffixes to runs of repeated starts (kind 0) and strings of split groups (kind 1)."""
    suffix = F.substring("bytes", F.col("off").cast("int") + 1, F.lit(16))
    tie = F.when(F.col("split"), F.col("c")).otherwise(F.lit(0))
    dealt = found.withColumn("lead", suffix).withColumn("tie", tie).repartitionByRange("lead", "g", "tie")

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        col = {c: t.column(c).to_numpy() for c in ("off", "n", "m", "k1", "k2", "lo")}
        col["split"] = t.column("split").to_numpy()
        runs, edges = repeated_starts(t.column("bytes").to_pylist(), col["split"], col["off"], col["n"], col["m"] == 1)
        if runs:
            r, a, z = runs
            zero = np.zeros(len(r), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([_long(x) for x in (
                zero, col["k1"][r], col["k2"][r], col["lo"][r] + a, col["lo"][r] + z, zero, zero, zero)], names=_OUT)
        if edges:
            h0, h1, o, r, a = edges
            own = r >= 0
            place = np.where(own, col["lo"][r] + a, -1)
            yield pa.RecordBatch.from_arrays([_long(x) for x in (
                np.ones(len(r), dtype=np.int64), np.where(own, col["k1"][r], 0), np.where(own, col["k2"][r], 0),
                place, place, h0, h1, o)], names=_OUT)

    return dealt.select("split", "off", "n", "m", "k1", "k2", "lo", "bytes").mapInArrow(run, _schema(_OUT))


def repeated_ranges(src: DataFrame) -> DataFrame:
    """(k1, k2, first, last): runs of starts of repeated strings, by text key, for (text, k1, k2) rows."""
    sc = src.sparkSession.sparkContext
    grams = gram_rows(src).groupBy("g").count().where(F.col("count") > 1).select("g")
    bitmap, mask = key_bitmap(materialise(grams), "g")
    rec = keep(record_rows(src, sc.broadcast(bitmap), mask, False))
    distinct = materialise(rec.groupBy("g", "off", "n", "c").agg(
        F.count("*").alias("m"), F.min(F.struct("k1", "k2", "lo")).alias("at")))
    whole = distinct.where(F.col("m") > 1).select("g", "off", "n", "c")
    full = rec.join(whole, ["g", "off", "n", "c"], "left_semi") \
        .select("k1", "k2", F.col("lo").alias("first"), (F.col("lo") + F.col("n") - 1).alias("last"))
    mixed = distinct.groupBy("g").agg(F.count("*").alias("kinds")).where(F.col("kinds") > 1) \
        .select("g", (F.col("kinds") > GROUP).alias("split"))
    wanted = materialise(distinct.join(mixed, "g").select("g", "split", "off", "n", "c", "m", "at.k1", "at.k2", "at.lo"))
    spots, spot_mask = key_bitmap(wanted.select(place_column().alias("place")), "place")
    got = record_rows(src, sc.broadcast(spots), spot_mask, True).dropDuplicates(["k1", "k2", "lo"])
    compared = materialise(bucket_rows(wanted.join(got, ["k1", "k2", "lo"])))
    edge = compared.where("kind = 1")
    across = edge.groupBy("h0", "h1", "o").count().where(F.col("count") > 1).select("h0", "h1", "o")
    near = compared.where("kind = 0").select("k1", "k2", "first", "last")
    far = edge.where("first >= 0").join(across, ["h0", "h1", "o"], "left_semi").select("k1", "k2", "first", "last")
    return full.unionByName(near).unionByName(far)


def cut(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` (in ``_row``) with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (removed byte
    ranges, end exclusive) and ``kept`` (the remaining bytes)."""
    row = packed(docs).select(ROW, F.col(ROW)[text].cast("string").alias("text"))
    keyed = row.select(ROW, "text", *text_key(F.col("text")))
    long_enough = keyed.where(F.octet_length("text") >= LENGTH).select("text", "k1", "k2")
    ranges = materialise(repeated_ranges(long_enough).distinct()).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("first", "last")).alias("runs"))  # bounded by one text's length
    joined = keyed.join(ranges, ["k1", "k2"], "left").select(ROW, "text", "runs")
    spans = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    out = T.StructType([row.schema[ROW], *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                        T.StructField("spans", spans), T.StructField("kept", T.BinaryType())])
    arrow_spans = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in batches:
            n_bytes, n_removed, gone, kept = [], [], [], []
            for t, runs in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2)):
                t = t or b""
                held = []
                if runs.is_valid:
                    first, last = (runs.values.field(i).to_numpy() for i in (0, 1))
                    by = np.argsort(first, kind="stable")
                    first, end = first[by], np.maximum.accumulate(last[by] + LENGTH)
                    new = np.concatenate([[True], first[1:] > end[:-1]])
                    at = np.flatnonzero(new)
                    held = list(zip(first[at].tolist(), end[np.concatenate([at[1:] - 1, [len(end) - 1]])].tolist()))
                left, pos = [], 0
                for a, z in held:
                    left.append(t[pos:a])
                    pos = z
                left.append(t[pos:])
                n_bytes.append(len(t))
                n_removed.append(sum(z - a for a, z in held))
                gone.append([{"first": a, "end": z} for a, z in held])
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([len(x) for x in gone], pa.int64()), pa.array(gone, arrow_spans), pa.array(kept, pa.binary())],
                names=out.names)

    return joined.mapInArrow(run, out)


@register("op10_suffix_array_dedup")
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut(docs).select(F.col(ROW)["doc_id"].alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                            F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_removed") > 0).alias("has_repeats"),
                            F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))

