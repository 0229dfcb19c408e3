"""Language ID by cross-parsing entropy.

Model: for every language in the labelled rows, a bounded text sample and its suffix
automaton. A text is parsed greedily against each automaton: the longest prefix of what
remains that occurs in the sample is one phrase. With ``c`` phrases over ``n`` characters,
``c * log2(sample length) / n`` is the cross entropy in bits per character; the language
with the lowest value wins (ties: the smaller language name).

The only bounded part is the training sample (``DOCS_PER_LANG`` pieces per language, those
with the smallest hash among the different ones, a piece being the first ``CHARS_PER_DOC``
characters of a text; ``CHARS_PER_LANG`` in all). Copies count once. Every character of a
sample is a symbol of its automaton. Prediction reads every character of every text.

A parse restarts every ``LANE`` characters, so that long texts become many independent
lanes stepped together by numpy: one table look-up per character and language, whatever
the length of the text. The restarts add the same phrases for every language.

``strange`` sets a text's bits per character in its best language against what that language usually needs
(the second half of its sample under the first half's automaton); texts under ``STRANGE_CHARS`` characters and
languages with too small a sample are never strange (0).

Defined results: null text or text without any letter (Unicode) gives ``und``, score 0;
a training set without any labelled text gives ``und`` for all; ``score`` is
``1 - best / second`` of the two lowest cross entropies (1.0 with a single language).
Ties, repeated rows and extra columns need no care: each row is scored by its text alone.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, packed, register, table, unpacked

DOCS_PER_LANG = 200
CHARS_PER_DOC = 1_000
CHARS_PER_LANG = 48_000
DENSE = 254
LANE = 1_024
BLOCK_CHARS = 1_000_000
OWN_CHARS = 500  # half a sample must hold as many to tell what its language usually needs
STRANGE_CHARS = 200  # shorter texts are never strange
MAX_STRANGE = 2.2  # measured: 26 of 10,000 given texts (1 of 51,282 in a larger set) lie above, shouted or symbol-laden junk; other languages do
LETTER = re.compile(r"[^\W\d_]")
MISS = 1 << 30


class Automaton:
    """Suffix automaton of one sample as a dense (state x symbol) table.

    An entry holds the next state; where the sample has no such continuation it holds the
    state after restarting at the root with this symbol, plus the ``MISS`` flag (a new
    phrase). The table has columns for the sample's ``DENSE`` most frequent symbols (``column``
    maps the shared ones to them): column 0 is any other symbol, the last column is padding.
    The sample's remaining symbols (``rare`` numbers them) have their edges in a sorted list.
    """

    def __init__(self, shared: np.ndarray, n_shared: int):
        mine, n = np.unique(shared[shared > 0], return_counts=True)
        mine = mine[np.lexsort((mine, -n))]
        own = np.zeros(n_shared + 2, dtype=np.int32)
        own[mine] = np.arange(1, len(mine) + 1, dtype=np.int32)
        dense = min(len(mine), DENSE)
        self.width = width = dense + 2
        self.column = np.where(own <= dense, own, 0).astype(np.int32)
        self.column[n_shared + 1] = width - 1
        self.rare = np.maximum(own - dense, 0)
        self.n_rare = len(mine) - dense
        symbols = own[shared]
        nxt: list[dict] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols.tolist():
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.fresh = len(nxt)  # before a phrase: nothing matched yet, or an unknown character just passed
        root = np.full(width, MISS | self.fresh, dtype=np.int32)
        self.restart = np.zeros(self.n_rare + 1, dtype=np.int32)
        for c, s in nxt[0].items():
            if c <= dense:
                root[c] = s | MISS
            else:
                self.restart[c - dense] = s | MISS
        tab = np.tile(root, (len(nxt) + 1, 1))
        for s, edges in enumerate(nxt):
            if near := [c for c in edges if c <= dense]:
                tab[s, near] = [edges[c] for c in near]
        far = sorted((s * (self.n_rare + 1) + c - dense, to) for s, edges in enumerate(nxt) if self.n_rare
                     for c, to in edges.items() if c > dense)
        self.far, self.far_to = np.array([k for k, _ in far], dtype=np.int64), np.array([t for _, t in far], dtype=np.int32)
        tab[:, 0] = MISS | self.fresh  # an unknown character is a phrase of its own
        tab[:, width - 1] = np.arange(len(nxt) + 1, dtype=np.int32)
        self.flat = np.ascontiguousarray(tab.reshape(-1))
        self.bits = float(np.log2(len(symbols) + 2))

    def count(self, grid: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of every lane of a (step x lane) grid of shared symbols; ``active`` lanes reach a step."""
        state = np.full(grid.shape[1], self.fresh, dtype=np.int32)
        count = np.zeros(grid.shape[1], dtype=np.int32)
        for t, k in enumerate(active.tolist()):
            v = self.flat[state[:k] * self.width + self.column[grid[t, :k]]]
            if self.n_rare:
                r = self.rare[grid[t, :k]]
                lane = np.flatnonzero(r)
                r = r[lane]
                key = state[lane].astype(np.int64) * (self.n_rare + 1) + r
                at = np.minimum(np.searchsorted(self.far, key), len(self.far) - 1)
                v[lane] = np.where(self.far[at] == key, self.far_to[at], self.restart[r])
            count[:k] += v >> 30
            state[:k] = v & (MISS - 1)
        return count


class CrossParser:
    """All languages' automata over the characters of all samples, built once per Python worker."""

    _cache: dict = {}

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        text = fold(" ".join(samples.values()))
        pts = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
        self.lut = np.zeros(0x110000, dtype=np.uint32)
        self.lut[pts] = np.arange(1, len(pts) + 1, dtype=np.uint32)
        self.pad = len(pts) + 1
        self.automata = [Automaton(self.encode(samples[k]), len(pts)) for k in self.langs]
        self.usual = np.array([self.own_bits(self.encode(samples[k]), len(pts)) for k in self.langs])

    def own_bits(self, codes: np.ndarray, n_symbols: int) -> float:
        """Bits a character that a language's own text needs: the second half of the sample under the first."""
        half = len(codes) // 2
        if half < OWN_CHARS:
            return math.inf
        auto, rest = Automaton(codes[:half], n_symbols), codes[half:]
        grid = np.full((LANE, -(-len(rest) // LANE)), self.pad, dtype=np.uint32)
        for lane in range(grid.shape[1]):
            part = rest[lane * LANE:(lane + 1) * LANE]
            grid[:len(part), lane] = part
        sizes = np.minimum(LANE, len(rest) - np.arange(grid.shape[1]) * LANE)
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")
        return float(auto.count(grid[:int(sizes[0])], active).sum() * auto.bits / len(rest))

    @classmethod
    def of(cls, samples: dict[str, str]) -> "CrossParser":
        key = hash(tuple(sorted(samples.items())))
        if key not in cls._cache:
            cls._cache.clear()
            cls._cache[key] = cls(samples)
        return cls._cache[key]

    def encode(self, text: str) -> np.ndarray:
        return self.lut[np.frombuffer(fold(text).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]

    def phrases(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrase counts, texts x languages, of concatenated texts."""
        out = np.zeros((len(lengths), len(self.langs)), dtype=np.int64)
        if not codes.size:
            return out
        n_lanes = -(-lengths // LANE)
        owner = np.repeat(np.arange(len(lengths)), n_lanes)
        first = np.cumsum(n_lanes) - n_lanes
        offset = (np.arange(len(owner)) - first[owner]) * LANE
        start = (np.cumsum(lengths) - lengths)[owner] + offset
        size = np.minimum(LANE, lengths[owner] - offset)
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        steps = int(size[0])
        active = np.searchsorted(-size, -np.arange(steps), side="left")  # lanes longer than t
        grid = np.full((steps, len(owner)), self.pad, dtype=np.uint32)
        for lane, (a, n) in enumerate(zip(start.tolist(), size.tolist())):
            grid[:n, lane] = codes[a:a + n]
        for j, auto in enumerate(self.automata):
            np.add.at(out[:, j], owner, auto.count(grid, active))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, and strangeness: bits a character over those that the language's own text needs."""
        lang = ["und"] * len(texts)
        score, strange = np.zeros(len(texts)), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        at = 0
        while self.langs and at < len(rows):
            block, chars = [], 0
            while at < len(rows) and (not block or chars < BLOCK_CHARS):
                block.append(rows[at])
                chars += len(texts[rows[at]])
                at += 1
            codes = [self.encode(texts[i]) for i in block]
            lengths = np.array([len(c) for c in codes], dtype=np.int64)
            bits = self.phrases(np.concatenate(codes), lengths) * np.array([a.bits for a in self.automata])
            bits = bits / np.maximum(lengths, 1)[:, None]
            best = np.argmin(bits, axis=1)
            low = np.partition(bits, 1, axis=1) if len(self.langs) > 1 else None
            value = 1.0 - low[:, 0] / low[:, 1] if low is not None else np.ones(len(block))
            for k, i in enumerate(block):
                lang[i] = self.langs[best[k]]
                score[i] = value[k]
                strange[i] = bits[k, best[k]] / self.usual[best[k]] if lengths[k] >= STRANGE_CHARS else 0.0
        return lang, score, strange


def fold(text: str) -> str:
    return " ".join(text.lower().split())


def lowest_pieces(rows: DataFrame, wanted: int) -> dict[str, list[str]]:
    """Of ``rows`` (lang, h, piece): every language's pieces of its ``wanted`` smallest different hashes, in that order.

    A hash bound for a few times as many comes first, from an approximate count of a language's hashes, so what
    is ranked does not grow with the rows or the tasks; it is raised for languages in which too few passed, so the
    pieces are the same as without it."""
    share = {r["lang"]: min(1.0, 4 * wanted / max(1, r["n"])) for r in
             rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    found: dict[str, list[str]] = {}
    bound = T.StructType([rows.schema["lang"], T.StructField("bound", T.LongType())])
    w = Window.partitionBy("lang").orderBy("h")
    while share:
        bounds = rows.sparkSession.createDataFrame(
            [(k, (1 << 63) - 1 if v >= 1 else int(v * (1 << 64)) - (1 << 63)) for k, v in share.items()], bound)
        some = rows.join(F.broadcast(bounds), "lang").where(F.col("h") <= F.col("bound"))
        picked = some.groupBy("lang", "h").agg(F.min("piece").alias("piece")) \
            .withColumn("r", F.row_number().over(w)).where(F.col("r") <= wanted)
        got: dict[str, list[str]] = {}
        for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["r"])):
            got.setdefault(r["lang"], []).append(r["piece"])
        done = [k for k, v in share.items() if v >= 1 or len(got.get(k, [])) == wanted]
        found.update({k: got.get(k, []) for k in done})
        share = {k: min(1.0, 8 * v) for k, v in share.items() if k not in done}
    return dict(sorted(found.items()))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", docs_per_lang: int = DOCS_PER_LANG,
          chars_per_doc: int = CHARS_PER_DOC, chars_per_lang: int = CHARS_PER_LANG) -> dict[str, str]:
    """The bounded sample per language (at most ``chars_per_lang`` characters each reach the driver)."""
    piece = F.substring(F.col(text), 1, chars_per_doc)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(piece).alias("h"), piece.alias("piece"))
    samples = {k: " ".join(map(fold, v))[:chars_per_lang] for k, v in lowest_pieces(rows, docs_per_lang).items()}
    return {k: v for k, v in samples.items() if LETTER.search(v)}


def identify(df: DataFrame, samples: dict[str, str], text: Column) -> DataFrame:
    """``df`` (columns kept inside ``_row``) with ``lang_pred``, ``score`` and ``strange``."""
    src = packed(df).select(ROW, text.cast("string").alias("_text"))
    out = T.StructType([src.schema[ROW], T.StructField("lang_pred", T.StringType()),
                        T.StructField("score", T.DoubleType()), T.StructField("strange", T.DoubleType())])

    def run(batches):
        model = CrossParser.of(samples)
        for b in batches:
            names = b.schema.names
            lang, score, strange = model.judge(b.column(names.index("_text")).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(names.index(ROW)), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(strange, pa.float64())], names=[ROW, "lang_pred", "score", "strange"])

    return src.mapInArrow(run, out)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


@register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = train(docs.where(~held_out(F.col("doc_id"))))
    scored = identify(docs.select("doc_id", "text"), samples, F.col(f"{ROW}.text"))
    return scored.select(F.col(f"{ROW}.doc_id").alias("doc_id"), held_out(F.col(f"{ROW}.doc_id")).alias("held_out"),
                         "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every kept document gets a language; documents of none go; all columns stay.

    Learns from the given ``documents`` table (rows that are not held out), predicts for ``docs``. A document is rejected
    if it has no letter (``und``) or if it is strange: its best language's automaton needs over ``MAX_STRANGE`` times
    the bits that the language's own text needs (a language nobody labelled, another script, random characters).
    A null ``lang`` becomes the predicted one; labels are kept. Without any labelled text nothing can be
    told, and every row passes unchanged."""
    given = table(spark, sf_dir, "documents")
    samples = train(given.where(~held_out(F.col("doc_id"))))
    if not samples:
        return docs
    scored = identify(docs, samples, F.col(f"{ROW}.text")).where((F.col("lang_pred") != "und") & (F.col("strange") <= MAX_STRANGE))
    lang = next((c for c in docs.columns if c.lower() == "lang"), None)
    if lang is not None:
        filled = F.coalesce(F.col(ROW)[lang], F.col("lang_pred").cast(docs.schema[lang].dataType))
        scored = scored.withColumn(ROW, F.col(ROW).withField(f"`{lang}`", filled))
    return unpacked(scored, docs.columns)
