"""Katz back-off language model: count, discount, normalise, store, score.

Model (order 2): tokens are a text's words (A-Z lowered) and one end; a text starts in a start
context. Every word pair seen in training (``MIN_COUNT`` = 1: none is pruned) has
``P(w | u) = d(c) c(u w) / (c(u) + PSEUDO)`` with Good-Turing discounts d for counts up to
``K`` (from the corpus-wide numbers of pairs by count; d = 1 where those do not give one
between 0 and 1). All other words share the rest of u's mass in proportion to the lower order:
``P(w | u) = a(u) p(w)``, with ``a(u)`` the mass left over divided by the lower-order mass of
the words not seen after u, so that every context sums to one exactly. ``PSEUDO`` keeps that
mass above zero. The lower order, where the recursion ends, is
``p(w) = (c + 0.5) / (N + 0.5 (V + 1))``; it keeps 0.5 counts for unknown words.

Execution: nothing that grows with the corpus reaches the driver or a broadcast.

* The number of parts follows the bytes of text (``PART_BYTES`` a part), so that a part, gathered in one Python
  group, does not grow with the corpus.
* Each task sorts the tokens of a block of texts and sends, per part, one packed run of distinct
  keys with counts; parts merge the runs (words first, then pairs).
* Parts of the pair table ask the parts of the word table for the counts of the second
  words and compute the weights. The model is written as tables partitioned by part: words with
  counts and back-off weights, pairs with their counts and the second word's, which give the gains.
* To score, a block sends each part the distinct words and pairs it holds with the documents
  they are in; the part returns one sum per document, and the block's sums are added up.
* Texts are scored in ``ROUNDS`` rounds and each step's shuffle files go when it ends (``tidy``): the
  disk holds the model, its shuffle and a share of the asks at once.
* Words and pairs with at least ``1 / HOT`` of all tokens (at most ``HOT`` of each, a proven
  bound) are broadcast and scored in the block, and pairs after a word that would fill a
  part by itself are dealt by pair: no key, however common, gathers its rows in one task.
* A bitmap of the pair table (``key_bitmap``, at most 16 MB) spares blocks from asking for most
  pairs that are not in it; parts decide.

Words are 56-bit hashes of their bytes, pairs two of them. Scores are sums of log10 values in
double precision; the order of summation is not fixed, so the last digits may differ.

Defined results: null and empty texts have one token, the end; with no training text every
count is zero and ``p`` is 1 for the one unknown type; equal rows score alike.
"""

from __future__ import annotations

import functools
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpoint_dir, key_bitmap, materialise, register, table, tidy
from .suffix_dedup import prefix_sums, string_hash

MIN_COUNT = 1
K = 5
PSEUDO = 0.5
HOT = 1 << 16
BLOCK_TOKENS = 1_200_000
BLOCK_DOCS = 60_000
PARTS_PER_TASK = 2
ROUNDS = 4
PART_BYTES = 4 << 20
CHUNK = 1 << 19
START, END = 0, 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
U = np.uint64


# ---- packed arrays -------------------------------------------------------------------------

def pack(*arrays) -> bytes:
    """Arrays as byte planes, zstd-compressed; ("sorted", a) is stored as differences."""
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        kind = 0
        if isinstance(a, tuple):
            kind, a = 1, np.diff(a[1].astype(U), prepend=U(0))
        elif a.dtype == np.float64:
            kind = 2
        a = np.ascontiguousarray(a if kind == 2 else a.astype(U))
        out += [struct.pack("<BQ", kind, len(a)), np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,), at, out = struct.unpack_from("<I", raw), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<BQ", raw, at)
        at += 9
        a = np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8, count=8 * size, offset=at).reshape(8, size).T).view(U).reshape(-1)
        at += 8 * size
        out.append(a.view(np.float64) if kind == 2 else np.cumsum(a, dtype=U) if kind == 1 else a)
    return out


# ---- tokens --------------------------------------------------------------------------------

def mixed(x: np.ndarray) -> np.ndarray:
    """A 56-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return (x ^ (x >> U(31))) >> U(8)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every word of one buffer."""
    data = _FOLD[np.frombuffer(raw, dtype=np.uint8)]
    blank = np.concatenate([[True], _SPACE[data], [True]])
    turn = np.flatnonzero(blank[1:] != blank[:-1])
    begin, end = turn[0::2], turn[1::2]
    out = np.empty(len(begin), dtype=U)
    at = 0
    while at < len(begin):  # chunks keep the table of powers small
        to = max(at + 1, int(np.searchsorted(end, begin[at] + CHUNK, side="right")))
        base = begin[at]
        sums = prefix_sums(data[base:end[to - 1]], 0)
        out[at:to] = mixed(string_hash(sums, 0, begin[at:to] - base, end[at:to] - base) + (end[at:to] - begin[at:to]).astype(U))
        at = to
    return out, begin


class Block:
    """Tokens of some texts: ``tok`` and the token before (``ctx``), with the text's number."""

    def __init__(self, texts: list[bytes | None]):
        texts = [t or b"" for t in texts]
        words, pos = word_hashes(b"\n".join(texts))
        start = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
        owner = np.searchsorted(start, pos, side="right") - 1
        self.n_docs = len(texts)
        self.n_words = np.bincount(owner, minlength=len(texts)).astype(np.int64)
        last = np.cumsum(self.n_words) + np.arange(len(texts))  # places of the ends
        self.tok = np.empty(len(words) + len(texts), dtype=U)
        self.tok[last] = END
        inside = np.ones(len(self.tok), dtype=bool)
        inside[last] = False
        self.tok[inside] = words
        self.doc = np.repeat(np.arange(len(texts)), self.n_words + 1)
        self.ctx = np.concatenate([[U(START)], self.tok[:-1]])
        self.ctx[self.ctx == END] = START


def blocks(batches, text: str = "text"):
    """(block number, Block, batch slice) of a task; bounded in tokens (about) and texts."""
    base = TaskContext.get().partitionId() << 24
    number, held = 0, []
    size = 0
    for whole in batches:
        sizes = pa.compute.binary_length(whole.column(whole.schema.get_field_index(text))).fill_null(0).to_numpy(zero_copy_only=False)
        cut = np.cumsum(sizes) // (CHUNK * 4)
        at = np.concatenate([[0], np.flatnonzero(np.diff(cut)) + 1, [len(sizes)]])
        for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
            held.append(whole.slice(a, z - a))
            size += int(sizes[a:z].sum())
            if size > BLOCK_TOKENS * 6 or sum(b.num_rows for b in held) >= BLOCK_DOCS - 10_000:
                yield base + number, *_joined(held, text)
                number, held, size = number + 1, [], 0
                pa.default_memory_pool().release_unused()
    if sum(b.num_rows for b in held):
        yield base + number, *_joined(held, text)


def _joined(held, text):
    t = pa.Table.from_batches(held)
    return Block(t.column(text).cast(pa.binary()).to_pylist()), t


def word_part(h: np.ndarray, n: int) -> np.ndarray:
    """Part of a word: ranges of the hash."""
    return ((h >> U(24)) * U(n)) >> U(32)


def pair_key(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mixed(u * U(0x9E3779B97F4A7C15) + v)


def pair_part(u: np.ndarray, v: np.ndarray, n: int, split: np.ndarray) -> np.ndarray:
    """Part of a pair: its first word's, or for the words in ``split`` one of its own."""
    part = word_part(u, n)
    own = member(u, split)
    part[own] = word_part(pair_key(u[own], v[own]), n)
    return part


def member(x: np.ndarray, table_: np.ndarray) -> np.ndarray:
    return look_up(x, table_)[1]


def look_up(x: np.ndarray, table_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in a sorted table, found)."""
    if not len(table_):
        return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(table_, x), len(table_) - 1)
    return at, table_[at] == x


def heads(*keys: np.ndarray) -> np.ndarray:
    """Places where a run of equal (sorted) keys begins."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(keys[0]) - 1, dtype=bool)
    for k in keys:
        new |= k[1:] != k[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def sums_of(values: np.ndarray, head: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, head) if len(head) else values[:0]


def by_part(part: np.ndarray):
    """(part, first, end) of each part in a sorted array."""
    head = heads(part)
    return zip(part[head].tolist(), head.tolist(), [*head[1:].tolist(), len(part)])


def pack_pairs(u: np.ndarray, v: np.ndarray, *more: np.ndarray) -> bytes:
    head = heads(u)
    return pack(("sorted", u[head]), np.diff(np.append(head, len(u))), v, *more)


def unpack_pairs(blob: bytes) -> list[np.ndarray]:
    u, n, *rest = unpack(blob)
    return [np.repeat(u, n.astype(np.int64)), *rest]


# ---- counting ------------------------------------------------------------------------------

_RUN = T.StructType([T.StructField("part", T.LongType()), T.StructField("kind", T.LongType()),
                     T.StructField("block", T.LongType()), T.StructField("blob", T.BinaryType())])
_WORDS, _PAIRS, _ASK, _DOCS, _HOT, _SUMS = range(6)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, block, blob = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(kind, pa.int64()), pa.array(block, pa.int64()),
                                       pa.array(blob, pa.binary())], names=_RUN.names)


def _blobs(t: pa.Table, kind: int | None = None) -> list[bytes]:
    if kind is not None:
        t = t.filter(pa.compute.equal(t.column("kind"), kind))
    return t.column("blob").to_pylist()


def _training(block: Block, t: pa.Table) -> np.ndarray:
    return ~np.asarray(t.column("held").to_pylist(), dtype=bool)[block.doc]


def count_words(docs: DataFrame, n: int) -> DataFrame:
    """One packed row per part: sorted words and counts; with their number and sum."""
    def send(batches):
        for number, block, t in blocks(batches):
            w, c = np.unique(block.tok[_training(block, t)], return_counts=True)
            rows = [(p, _WORDS, number, pack(("sorted", w[a:z]), c[a:z])) for p, a, z in by_part(word_part(w, n))]
            if rows:
                yield _rows(rows)

    def merge(t: pa.Table) -> pa.Table:
        w, c = (np.concatenate(x) for x in zip(*[unpack(b) for b in _blobs(t)]))
        order = np.argsort(w, kind="stable")
        w, c = w[order], c[order]
        head = heads(w)
        w, c = w[head], sums_of(c, head)
        return pa.table({"part": [t.column("part")[0].as_py()], "kind": [_WORDS], "block": [0],
                         "blob": pa.array([pack(("sorted", w), c)], pa.binary()), "types": [len(w)], "tokens": [int(c.sum())]})

    out = T.StructType([*_RUN.fields, T.StructField("types", T.LongType()), T.StructField("tokens", T.LongType())])
    return docs.mapInArrow(send, _RUN).groupBy("part").applyInArrow(merge, out)


def count_pairs(docs: DataFrame, n: int, split: np.ndarray) -> DataFrame:
    """One packed row per part: the pairs with ``MIN_COUNT`` or more; with the numbers of pairs by count."""
    def send(batches):
        for number, block, t in blocks(batches):
            own = _training(block, t)
            u, v = block.ctx[own], block.tok[own]
            if not len(u):
                continue
            order = np.lexsort((v, u))
            u, v = u[order], v[order]
            head = heads(u, v)
            c = np.diff(np.append(head, len(u)))
            u, v = u[head], v[head]
            part = pair_part(u, v, n, split)
            order = np.argsort(part, kind="stable")
            u, v, c, part = u[order], v[order], c[order], part[order]
            yield _rows([(p, _PAIRS, number, pack_pairs(u[a:z], v[a:z], c[a:z])) for p, a, z in by_part(part)])

    def merge(t: pa.Table) -> pa.Table:
        u, v, c = (np.concatenate(x) for x in zip(*[unpack_pairs(b) for b in _blobs(t)]))
        order = np.lexsort((v, u))
        u, v, c = u[order], v[order], c[order]
        head = heads(u, v)
        u, v, c = u[head], v[head], sums_of(c, head)
        seen = [int((c == r).sum()) for r in range(1, K + 2)]
        often = c >= MIN_COUNT
        return pa.table({"part": [t.column("part")[0].as_py()], "kind": [_PAIRS], "block": [0],
                         "blob": pa.array([pack_pairs(u[often], v[often], c[often])], pa.binary()),
                         "seen": pa.array([seen], pa.list_(pa.int64()))})

    out = T.StructType([*_RUN.fields, T.StructField("seen", T.ArrayType(T.LongType()))])
    return docs.mapInArrow(send, _RUN).groupBy("part").applyInArrow(merge, out)


def discounts(seen: list[int]) -> np.ndarray:
    """d[r] for r = 0..K (d[0] unused), from the numbers of pairs seen 1..K+1 times."""
    d = np.ones(K + 1)
    if seen[0]:
        common = (K + 1) * seen[K] / seen[0]
        for r in range(1, K + 1):
            if seen[r - 1] and common < 1:
                x = ((r + 1) * seen[r] / (r * seen[r - 1]) - common) / (1 - common)
                if 0 < x < 1:
                    d[r] = x
    return d


# ---- model ---------------------------------------------------------------------------------

class Totals:
    """Numbers that every task needs: sizes, discounts and the broadcast words."""

    def __init__(self, tokens: int, types: int, discount: np.ndarray, hot: np.ndarray, hot_count: np.ndarray, split: np.ndarray):
        self.tokens, self.types, self.discount = tokens, types, discount
        self.hot, self.hot_count, self.split = hot, hot_count, split

    def log_p(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def d(self, c: np.ndarray) -> np.ndarray:
        return np.where(c <= K, self.discount[np.minimum(c, K).astype(np.int64)], 1.0)


def _common(words: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with at least ``least`` tokens, sorted: few by choice of ``least``."""
    def run(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                w, c = unpack(blob)
                yield pa.RecordBatch.from_arrays([pa.array(x[c >= least].astype(np.int64)) for x in (w, c)], names=["w", "c"])

    rows = sorted((r["w"], r["c"]) for r in words.select("blob").mapInArrow(run, "w long, c long").collect())
    return np.array([r[0] for r in rows], dtype=U), np.array([r[1] for r in rows], dtype=np.float64)


def second_words(words: DataFrame, pairs: DataFrame, n: int, hot: np.ndarray) -> DataFrame:
    """For each part of the pairs, the counts of the second words it holds (those not broadcast)."""
    def ask(batches):
        for b in batches:
            for part, blob in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
                v = np.unique(unpack_pairs(blob)[1])
                v = v[~member(v, hot)]
                if rows := [(p, _ASK, part, pack(("sorted", v[a:z]))) for p, a, z in by_part(word_part(v, n))]:
                    yield _rows(rows)

    def answer(t: pa.Table) -> pa.Table:
        w, c = unpack(_blobs(t, _WORDS)[0])
        asked = t.filter(pa.compute.equal(t.column("kind"), _ASK))
        back, blob = asked.column("block").to_pylist(), []
        for x in _blobs(asked):
            (v,) = unpack(x)
            blob.append(pack(("sorted", v), c[look_up(v, w)[0]]))
        return pa.table({"part": pa.array(back, pa.int64()), "kind": pa.array([_ASK] * len(back), pa.int64()),
                         "block": pa.array(back, pa.int64()), "blob": pa.array(blob, pa.binary())})

    both = words.select(*_RUN.names).unionByName(pairs.select(*_RUN.names).mapInArrow(ask, _RUN))
    return both.groupBy("part").applyInArrow(answer, _RUN)


_MODEL = T.StructType([*_RUN.fields, T.StructField("u", T.LongType()), T.StructField("mass", T.DoubleType()),
                       T.StructField("lower", T.DoubleType())])


def probabilities(totals: Totals, w: np.ndarray, c: np.ndarray, u: np.ndarray, n: np.ndarray) -> np.ndarray:
    """P(v | u) of seen pairs with counts ``n``, from the words and counts of their part."""
    if not len(u):
        return np.zeros(0)
    start = totals.hot_count[look_up(np.array([END], dtype=U), totals.hot)[0]]  # a start for every end
    own = c[look_up(u, w)[0]].astype(np.float64) if len(c) else 0
    cu = np.where(u == START, start, np.where(member(u, totals.split), totals.hot_count[look_up(u, totals.hot)[0]], own))
    return totals.d(n) * n / (cu + PSEUDO)


def gains(totals: Totals, w: np.ndarray, c: np.ndarray, a: np.ndarray, u: np.ndarray, n: np.ndarray, cv: np.ndarray) -> np.ndarray:
    """log10 of seen pairs' probabilities over those of their back-off paths, without a(u) for split words; ``a``: log10 of
    the back-off weights of the part's words."""
    own = a[look_up(u, w)[0]] if len(a) else np.zeros(len(u))
    return np.log10(probabilities(totals, w, c, u, n)) - totals.log_p(cv) - np.where(member(u, totals.split), 0.0, own)


def weigh(words: DataFrame, pairs: DataFrame, answers: DataFrame, totals: Totals, least: int) -> DataFrame:
    """Per part a ``_WORDS`` row (word, count, log10 of the back-off weight) and a ``_PAIRS`` row (pair, count, count of its
    second word); rows (u, mass, lower) add up to the sums of the split words. Pairs with ``least`` or more also come as
    rows of their own, with their ``gains``."""
    def run(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        found = _blobs(t, _WORDS)
        w, c = unpack(found[0]) if found else (np.zeros(0, dtype=U), np.zeros(0, dtype=U))
        held = _blobs(t, _PAIRS)
        u, v, n = unpack_pairs(held[0]) if held else (np.zeros(0, dtype=U),) * 3
        known = [unpack(b) for b in _blobs(t, _ASK)]
        kv = np.concatenate([totals.hot, *[k[0] for k in known]])
        kc = np.concatenate([totals.hot_count, *[k[1].astype(np.float64) for k in known]])
        order = np.argsort(kv, kind="stable")
        at, _ = look_up(v, kv[order])
        cv = kc[order][at] if len(v) else np.zeros(0)
        is_split = member(u, totals.split)
        p = probabilities(totals, w, c, u, n)
        lower = 10.0 ** totals.log_p(cv)
        head = heads(u)
        mass, below = sums_of(p, head), sums_of(lower, head)
        alpha = np.log10((1 - mass) / (1 - below))
        alpha[is_split[head]] = 0.0
        log_alpha = np.zeros(len(w))
        mine = ~is_split[head]
        log_alpha[look_up(u[head][mine], w)[0]] = alpha[mine]
        s, often = np.flatnonzero(~mine), np.flatnonzero(n >= least)
        gain = gains(totals, w, c, log_alpha, u[often], n[often], cv[often])
        size = 2 + len(s) + len(often)
        own = lambda x: x.astype(np.int64).tolist()
        return pa.table({
            "part": [part] * size, "kind": [_WORDS, _PAIRS, *[_SUMS] * len(s), *[_HOT] * len(often)],
            "block": [0] * (2 + len(s)) + own(v[often]),
            "blob": pa.array([pack(("sorted", w), c, log_alpha), pack_pairs(u, v, n, cv.astype(U)), *[None] * (size - 2)], pa.binary()),
            "u": pa.array([None, None, *own(u[head][s]), *own(u[often])], pa.int64()),
            "mass": pa.array([None, None, *mass[s].tolist(), *gain.tolist()], pa.float64()),
            "lower": pa.array([None, None, *below[s].tolist(), *[None] * len(often)], pa.float64())})

    rows = words.select(*_RUN.names).unionByName(pairs.select(*_RUN.names)).unionByName(answers)
    return rows.groupBy("part").applyInArrow(run, _MODEL)


class Model:
    """A trained model: the path of its partitioned tables and what tasks get by broadcast."""

    def __init__(self, docs: DataFrame, path: str, parts: int):
        """``docs``: (text, held); rows with ``held`` are not learnt from."""
        self.parts, self.path = parts, path
        words = materialise(count_words(docs, parts))
        tokens, types = words.agg(F.sum("tokens"), F.sum("types")).first()
        tokens, types = tokens or 0, types or 0
        hot, hot_count = _common(words, max(1, -(-tokens // HOT)))
        split = np.union1d(hot[hot_count * 4 * parts > tokens], np.array([START, END], dtype=U))
        if END not in hot:  # the end counts as common: one per document
            end = np.array([END], dtype=U)
            n_end = _count_of(words, END)
            at = np.searchsorted(hot, end)
            hot, hot_count = np.insert(hot, at, end), np.insert(hot_count, at, n_end)
        pairs = materialise(count_pairs(docs, parts, split))
        seen = np.zeros(K + 1, dtype=np.int64)
        for r in pairs.groupBy().agg(*[F.sum(F.col("seen")[i]).alias(f"n{i}") for i in range(K + 1)]).collect():
            seen = [x or 0 for x in r]
        self.totals = Totals(tokens, types, discounts(list(seen)), hot, hot_count, split)
        spark = docs.sparkSession
        told = spark.sparkContext.broadcast(self.totals)
        weighed = weigh(words, pairs, second_words(words, pairs, parts, hot), _Told(told), max(1, -(-tokens // HOT)))
        weighed.write.partitionBy("part").parquet(path)
        model = spark.read.schema("kind long, block long, blob binary, u long, mass double, lower double, part long").parquet(path)
        sums = model.where(F.col("kind") == _SUMS).groupBy("u").agg(F.sum("mass").alias("m"), F.sum("lower").alias("l")).collect()
        self.tables = model.where(F.col("kind").isin(_WORDS, _PAIRS)).select(*_RUN.names)
        alpha = {r["u"]: np.log10((1 - r["m"]) / (1 - r["l"])) for r in sums}  # at most 4 parts + 2 words
        self.split_alpha = np.array([alpha.get(int(x), 0.0) for x in split])
        self.hot_alpha, self.hot_pairs, self.hot_gain = self._hot_rows(told, model.where(F.col("kind") == _HOT))
        self.bitmap, self.mask = key_bitmap(self._pair_keys(), "k")

    def _hot_rows(self, told, pairs: DataFrame):
        """Back-off weights of the hot words; the hot pairs and their gains (at most ``HOT``)."""
        def run(batches):
            t = told.value
            for b in batches:
                for blob in b.column(0).to_pylist():
                    w, _, a = unpack(blob)
                    own = member(w, t.hot)
                    yield pa.RecordBatch.from_arrays([pa.array(w[own].astype(np.int64)), pa.array(a[own])], names=["w", "x"])

        words = self.tables.where(F.col("kind") == _WORDS).select("blob").mapInArrow(run, "w long, x double")
        alpha = {r["w"]: r["x"] for r in words.collect()}
        pairs = sorted((r["u"], r["block"], r["mass"]) for r in pairs.select("u", "block", "mass").collect())
        hot_alpha = np.array([alpha.get(int(x), 0.0) for x in self.totals.hot])
        u, v = (np.array([p[i] for p in pairs], dtype=U) for i in (0, 1))
        key = pair_key(u, v)
        order = np.argsort(key)
        gain = np.array([p[2] for p in pairs], dtype=np.float64)
        return hot_alpha, key[order], (gain - self._split_of(u))[order]

    def _split_of(self, u: np.ndarray) -> np.ndarray:
        """log10 a(u) for split words, else 0."""
        at, own = look_up(u, self.totals.split)
        return np.where(own, self.split_alpha[at], 0.0)

    def _pair_keys(self) -> DataFrame:
        def run(batches):
            for b in batches:
                for blob in b.column(0).to_pylist():
                    u, v, *_ = unpack_pairs(blob)
                    yield pa.RecordBatch.from_arrays([pa.array(pair_key(u, v).astype(np.int64))], names=["k"])

        return self.tables.where(F.col("kind") == _PAIRS).select("blob").mapInArrow(run, "k long")


class _Told:
    """Totals by broadcast, with the same attributes."""

    def __init__(self, broadcast):
        self._b = broadcast

    def __getattr__(self, name):
        return getattr(self.__dict__["_b"].value, name)

    def __reduce__(self):
        return _Told, (self.__dict__["_b"],)


def _count_of(words: DataFrame, word: int) -> float:
    def run(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                w, c = unpack(blob)
                yield pa.RecordBatch.from_arrays([pa.array(c[w == U(word)].astype(np.int64))], names=["c"])

    return float(sum(r["c"] for r in words.select("blob").mapInArrow(run, "c long").collect()))


# ---- scoring -------------------------------------------------------------------------------

def _entries(keys: list[np.ndarray], doc: np.ndarray, part: np.ndarray):
    """Sorted distinct (part, keys, doc) with counts: per part (part, key columns, docs per key, doc, count)."""
    order = np.lexsort((doc, *reversed(keys), part))
    keys, doc, part = [k[order] for k in keys], doc[order], part[order]
    head = heads(part, *keys, doc)
    n = np.diff(np.append(head, len(doc)))
    keys, doc, part = [k[head] for k in keys], doc[head], part[head]
    for p, a, z in by_part(part):
        own = heads(*[k[a:z] for k in keys])
        yield p, [k[a:z][own] for k in keys], np.diff(np.append(own, z - a)), doc[a:z], n[a:z]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row (doc_id, text, held), in rounds
    dealt by a hash of the id; a round's tasks read the rows of several others', so that blocks stay large."""
    n = model.parts
    sc = docs.sparkSession.sparkContext
    told = sc.broadcast((model.totals, model.split_alpha, model.hot_alpha, model.hot_pairs, model.hot_gain, model.bitmap))
    mask = model.mask

    def send(batches):
        t, split_alpha, hot_alpha, hot_pairs, hot_gain, bitmap = told.value
        bits = np.frombuffer(bitmap, dtype=np.uint8)
        split_in_hot = member(t.hot, t.split)
        for number, block, rows in blocks(batches):
            tok, ctx, doc = block.tok, block.ctx, block.doc
            at, is_hot = look_up(tok, t.hot)
            base = np.bincount(doc[is_hot], weights=t.log_p(t.hot_count[at[is_hot]]), minlength=block.n_docs)
            known = np.bincount(doc[is_hot & (t.hot_count[at] > 0)], minlength=block.n_docs).astype(np.float64)
            at_s, is_split = look_up(ctx, t.split)
            extra = np.bincount(doc[is_split], weights=split_alpha[at_s[is_split]], minlength=block.n_docs)
            # a word's back-off weight counts where it is the context: as often as it is a token
            own = is_hot & ~split_in_hot[at]
            extra += np.bincount(doc[own], weights=hot_alpha[at[own]], minlength=block.n_docs)
            out = []
            w = ~is_hot
            for p, (key,), per, d, c in _entries([tok[w]], doc[w], word_part(tok[w], n)):
                out.append((p, _ASK, number, pack(np.array([block.n_docs]), ("sorted", key), per, d, c)))
            key = pair_key(ctx, tok)
            at, is_hot = look_up(key, hot_pairs)
            extra += np.bincount(doc[is_hot], weights=hot_gain[at[is_hot]], minlength=block.n_docs)
            place = (key & U(mask)).astype(np.int64)
            maybe = ~is_hot & ((bits[place >> 3] >> (place & 7).astype(np.uint8) & 1) > 0)
            for p, (key,), per, d, c in _entries([key[maybe]], doc[maybe], pair_part(ctx[maybe], tok[maybe], n, t.split)):
                out.append((p, _PAIRS + 10, number, pack(np.array([block.n_docs]), ("sorted", key), per, d, c)))
            ids = rows.column("doc_id")
            out.append((number % n, _DOCS, number, pack(
                ids.fill_null(0).to_numpy().astype(np.int64).view(U), ids.is_null().to_numpy().astype(U),
                np.asarray(rows.column("held").to_pylist(), dtype=bool).astype(U), (block.n_words + 1).astype(U), base, known, extra)))
            yield _rows(out)

    def resolve(t: pa.Table) -> pa.Table:
        totals, split_alpha = told.value[:2]
        found = {k: _blobs(t, k) for k in (_WORDS, _PAIRS)}
        w, c, a = unpack(found[_WORDS][0]) if found[_WORDS] else (np.zeros(0, dtype=U), np.zeros(0, dtype=U), np.zeros(0))
        u, v, seen, cv = unpack_pairs(found[_PAIRS][0]) if found[_PAIRS] else (np.zeros(0, dtype=U),) * 4
        g = gains(totals, w, c, a, u, seen, cv)
        key = pair_key(u, v)
        order = np.argsort(key)
        key, u, g = key[order], u[order], g[order]
        at, own = look_up(u, totals.split)
        g = g - np.where(own, split_alpha[at], 0.0)
        out = []
        for kind, block, blob in zip(t.column("kind").to_pylist(), t.column("block").to_pylist(), t.column("blob").to_pylist()):
            if kind == _DOCS:
                out.append((block, _DOCS, blob))
            elif kind == _ASK:
                n_docs, k, per, d, n_ = unpack(blob)
                at, hit = look_up(k, w)
                count = np.where(hit, c[at] if len(c) else 0, 0).astype(np.float64)
                per, d, n_ = per.astype(np.int64), d.astype(np.int64), n_.astype(np.float64)
                size = int(n_docs[0])
                out.append((block, _SUMS, _dense(size, d, [
                    n_ * np.repeat(totals.log_p(count), per), n_ * np.repeat(hit, per),
                    n_ * np.repeat(np.where(hit, a[at] if len(a) else 0.0, 0.0), per)])))
            elif kind == _PAIRS + 10:
                n_docs, k, per, d, n_ = unpack(blob)
                at, hit = look_up(k, key)
                gain = np.where(hit, g[at] if len(g) else 0.0, 0.0)
                zero = np.zeros(len(d))
                out.append((block, _SUMS, _dense(int(n_docs[0]), d.astype(np.int64), [
                    zero, zero, n_.astype(np.float64) * np.repeat(gain, per.astype(np.int64))])))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "kind": pa.array([x[1] for x in out], pa.int64()),
                         "blob": pa.array([x[2] for x in out], pa.binary())})

    def finish(t: pa.Table) -> pa.Table:
        ids, none, held, size, base, known, extra = unpack(_blobs(t, _DOCS)[0])
        base, known, extra = base.copy(), known.copy(), extra.copy()
        for blob in _blobs(t, _SUMS):
            d, b, k, e = unpack(blob)
            d = d.astype(np.int64)
            base[d] += b
            known[d] += k
            extra[d] += e
        return pa.table({
            "doc_id": pa.array(ids.view(np.int64), pa.int64(), mask=none.astype(bool)), "held_out": pa.array(held.astype(bool)),
            "n_tokens": pa.array(size.astype(np.int64)), "n_known": pa.array(np.rint(known).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(ids), told.value[0].tokens, dtype=np.int64)),
            "base_score": pa.array(base), "score": pa.array(base + extra)})

    def round_of(some: DataFrame) -> DataFrame:
        asked = some.mapInArrow(send, _RUN).unionByName(model.tables)
        sums = asked.groupBy("part").applyInArrow(resolve, "block long, kind long, blob binary")
        return sums.groupBy("block").applyInArrow(
            finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

    tasks = docs.rdd.getNumPartitions()
    fewer = min(tasks, max(sc.defaultParallelism, -(-tasks // ROUNDS)))
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS))
    rounds = [materialise(round_of(docs.where(dealt == r).coalesce(max(1, fewer)))) for r in range(ROUNDS)]
    return functools.reduce(DataFrame.unionByName, rounds)


def _dense(size: int, doc: np.ndarray, values: list[np.ndarray]) -> bytes:
    """Sums per document that has any."""
    sums = [np.bincount(doc, weights=v, minlength=size) for v in values]
    some = np.flatnonzero(np.bincount(doc, minlength=size))
    return pack(("sorted", some), *[s[some] for s in sums])


def parts_of(docs: DataFrame) -> int:
    """Number of parts: at most ``PART_BYTES`` of text each on average (a token takes two bytes or more, but for
    the ends), and ``PARTS_PER_TASK`` a reduce task where the input is small."""
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    tasks = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(PARTS_PER_TASK * tasks, -(-size // PART_BYTES))


def katz(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not ``held`` and score all, for (doc_id, text, held)."""
    spark = docs.sparkSession
    parts = parts_of(docs)
    path = f"{checkpoint_dir(spark)}/katz-{uuid.uuid4().hex}"
    with tidy(spark):
        return score(docs, Model(docs.select("text", "held"), path, parts))


@register("op8_katz_lm_scoring")
def op8_katz_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    return katz(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held")))
