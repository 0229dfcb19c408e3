"""Benchmark decontamination over a positional inverted index, sharded by document.

Every task indexes its own documents: for the terms of the test set, the positions at which
the shard's texts hold them (the postings). A phrase starts from the postings of its rarest
term in the shard, shifted to the phrase's start, and is intersected with the other terms'
postings from rare to frequent; a start survives if every term stands at its own offset
(phrase match), or within ``slop`` words of it (proximity match). No posting is shuffled.

The test set is the query side: it reaches every task as a broadcast in blocks of at most
``BLOCK_BYTES`` of text, each block one narrow map over the documents, so memory is bounded
by one block whatever the size of the benchmark, and every block meets every document.

Words: A-Z lowered, then runs of characters outside \\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F.
A window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window.

Defined results: null or wordless texts have 0 words and no hit; items without words (or
null) have no window; items with a null id hit but are not listed; repeated item ids are
listed once; an empty benchmark hits nothing.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, alnum_words, packed, register, table, unpacked

WINDOW = 10
SLOP = 2
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 8 << 20
_CANDIDATES = 1 << 21


class Phrases:
    """The distinct windows of one block of items, by length, over the block's vocabulary."""

    _cache: dict = {}

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.vocab: dict[bytes, int] = {}
        owners: dict[tuple, set] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in alnum_words(text)]
            n = min(window, len(ids))
            for a in range(len(ids) - n + 1 if ids else 0):
                held = owners.setdefault(tuple(ids[a:a + n]), set())
                if item is not None:
                    held.add(item)
        self.by_length = []
        for n in sorted({len(k) for k in owners}):
            keys = [k for k in owners if len(k) == n]
            self.by_length.append((np.array(keys, dtype=np.int32), [sorted(owners[k]) for k in keys]))

    @classmethod
    def of(cls, key: str, block, window: int) -> "Phrases":
        """The worker's index of one block; ``key`` names the block and window length."""
        if cls._cache.get("key") != key:
            cls._cache.update(key=key, value=cls(block.value, window))
        return cls._cache["value"]


class Shard:
    """Postings of the vocabulary's terms over some documents: -1 stands between texts, 0 for other words."""

    def __init__(self, docs: list[list[int]], pad: int):
        self.pad = pad
        gap = [-1] * pad
        flat: list[int] = list(gap)
        self.first = np.zeros(len(docs), dtype=np.int64)
        for i, d in enumerate(docs):
            self.first[i] = len(flat)
            flat += d
            flat += gap
        self.tok = np.array(flat, dtype=np.int32)
        self.postings = np.argsort(self.tok, kind="stable")
        self.ordered = self.tok[self.postings]

    def starts(self, phrases: np.ndarray, slop: int):
        """(phrase number, start, exact) of every match, in pieces."""
        n = phrases.shape[1]
        lo = np.searchsorted(self.ordered, phrases, side="left")
        count = np.searchsorted(self.ordered, phrases, side="right") - lo
        rare = np.argsort(count, axis=1, kind="stable")
        rows = np.arange(len(phrases))
        many = count[rows, rare[:, 0]]
        live = np.flatnonzero(many)
        upto = np.cumsum(many[live])
        at = 0
        while at < len(live):
            base = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, base + _CANDIDATES, side="right")))
            part = live[at:to]
            at = to
            w = np.repeat(part, many[part])
            inside = np.arange(len(w)) - np.repeat(np.cumsum(many[part]) - many[part], many[part])
            r0 = rare[part, 0]
            start = self.postings[np.repeat(lo[part, r0], many[part]) + inside] - np.repeat(r0, many[part])
            off = np.zeros(len(w), dtype=bool)  # some term stands beside its offset
            for j in range(1, n):
                pos = rare[w, j]
                want = phrases[w, pos]
                there = np.clip(start + pos, self.pad, len(self.tok) - self.pad - 1)
                exact = self.tok[there] == want
                ok = exact.copy()
                for d in range(1, slop + 1):
                    ok |= (self.tok[there - d] == want) | (self.tok[there + d] == want)
                off |= ~exact
                if not ok.all():
                    w, start, off = w[ok], start[ok], off[ok]
            yield w, start, ~off


def search(tokens: list[list[int]], phrases: Phrases, slop: int = 0):
    """Per document: sorted disjoint hit runs [(first, last)], item ids of phrase matches, of proximity matches."""
    longest = max((p.shape[1] for p, _ in phrases.by_length), default=1)
    shard = Shard(tokens, longest + slop + 1)
    edge = np.zeros(len(shard.tok) + 1, dtype=np.int32)
    exact_items: list[set] = [set() for _ in tokens]
    near_items: list[set] = [set() for _ in tokens]
    for windows, owners in phrases.by_length:
        n = windows.shape[1]
        for w, start, exact in shard.starts(windows, slop if n >= 5 else 0):
            np.add.at(edge, start[exact], 1)
            np.add.at(edge, start[exact] + n, -1)
            doc = np.searchsorted(shard.first, np.maximum(start, shard.first[0] if len(shard.first) else 0), side="right") - 1
            for d, k, e in np.unique(np.stack([doc, w, exact.astype(np.int64)]), axis=1).T.tolist():
                (exact_items if e else near_items)[d].update(owners[k])
    covered = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)])
    turn = np.flatnonzero(np.diff(covered))
    runs: list[list] = [[] for _ in tokens]
    if turn.size:
        begin, end = turn[0::2], turn[1::2]
        doc = np.searchsorted(shard.first, begin, side="right") - 1
        for d, a, z in zip(doc.tolist(), (begin - shard.first[doc]).tolist(), (end - shard.first[doc]).tolist()):
            runs[d].append((a, z - 1))
    return runs, exact_items, near_items


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
_FOUND = [T.StructField("n_words", T.LongType()), T.StructField("spans", _SPANS),
          T.StructField("items", T.ArrayType(T.StringType())), T.StructField("near", T.ArrayType(T.StringType()))]
_PA_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES):
    """The benchmark as lists of (id, UTF-8 text), each of about ``block_bytes`` at most."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text")) \
        .where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size * 2 // block_bytes)) if size > block_bytes else 1
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) if blocks > 1 else rows
        yield [(r["item"], r["text"].encode()) for r in part.collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` (in ``_row``) with ``n_words``, ``spans`` (hit word runs), ``items`` (ids with a
    phrase match) and ``near`` (ids with a proximity match only)."""
    sc = docs.sparkSession.sparkContext
    src = packed(docs).select(ROW, F.col(f"{ROW}.text").cast("string").alias("_text"))
    for number, items in enumerate(item_blocks(benchmark, block_bytes=block_bytes)):
        src = _search_block(src, sc.broadcast(items), window, slop, number > 0)
    return src.drop("_text")


def _search_block(src: DataFrame, block, window: int, slop: int, again: bool) -> DataFrame:
    out = T.StructType([src.schema[ROW], T.StructField("_text", T.StringType()), *_FOUND])

    key = uuid.uuid4().hex

    def run(batches):
        phrases = Phrases.of(key, block, window)
        get = phrases.vocab.get
        for whole in batches:
            sizes = pa.compute.binary_length(whole.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            shard = np.cumsum(sizes) // SHARD_BYTES
            for b in (whole.slice(int(a), int(z - a)) for a, z in zip(*_bounds(shard))):
                tokens = [[get(w, 0) for w in alnum_words(t)] if t else [] for t in
                          b.column(1).cast(pa.binary()).to_pylist()]
                runs, items, near = search(tokens, phrases, slop)
                if again:
                    old = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names) if i > 1}
                    runs = [_merged(r + [(s["first"], s["last"]) for s in o]) for r, o in zip(runs, old["spans"])]
                    items = [i | set(o) for i, o in zip(items, old["items"])]
                    near = [n | set(o) for n, o in zip(near, old["near"])]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array([len(t) for t in tokens], pa.int64()),
                    pa.array([[{"first": a, "last": z} for a, z in r] for r in runs], _PA_SPANS),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                    pa.array([sorted(n - i) for n, i in zip(near, items)], pa.list_(pa.string()))], names=out.names)

    return src.mapInArrow(run, out)


def _bounds(shard: np.ndarray):
    cut = np.flatnonzero(np.diff(shard)) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(shard)]])


_ITEM_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5_SQL = f"""
WITH item AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS n, array_to_string(w[a:a + least({WINDOW}, len(w)) - 1], ' ') AS phrase
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS a FROM item WHERE len(w) > 0)),
doc AS (SELECT rowid AS rid, doc_id, {_ITEM_WORDS} AS w
        FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
pos AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS a FROM doc WHERE w IS NOT NULL),
hit AS (SELECT p.rid, p.a, k.n, v.item_id
        FROM (SELECT DISTINCT n FROM win) k JOIN pos p ON p.a + k.n - 1 <= len(p.w)
        JOIN win v ON v.n = k.n AND v.phrase = array_to_string(p.w[p.a:p.a + k.n - 1], ' ')),
word AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(a, a + n)) AS q FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS said
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(coalesce(len(doc.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(said, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (rid) LEFT JOIN items USING (rid)
"""


@register("op5_benchmark_decontamination", OP5_SQL)
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"] + 1)
    return found.select(F.col(f"{ROW}.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a window of a benchmark item go; all columns stay."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), slop=0)
    return unpacked(found.where(F.size("spans") == 0), docs.columns)
