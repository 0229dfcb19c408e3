"""Periodic runs: stretches of words that repeat with a fixed lag, found on lag diagonals.

Word i and word i - q lie on diagonal q; the diagonal's match length at i is the number of
consecutive words up to i that equal the word q before them. A diagonal that ends with m
matches is a stretch of m + q words with period q, and is emitted at once if that is long
enough: ``max(MIN_LENGTH, MIN_POWER * q)`` words.

Which diagonals are kept is what makes it sparse. Lags fall into bands (g/2, g]; the first
one holds all lags up to g. A run whose lag is in a band has at least g matches, so its
diagonal is opened by its first g matches together, when the g words up to i have occurred
before, and grows by one match with every further word. A context of g >= q words inside a run
of smallest period q occurs there at multiples of q only (a primitive word differs from its
rotations). So of all earlier occurrences the nearest one is at lag q throughout the run:
every word extends one diagonal a band, multiples of q never open one, and what is emitted
has its smallest period. Work is n log n for n words, whatever repeats: a text of one word
a million times over costs no more than another of its length.

Contexts are told by ranks of pairs of shorter contexts (exact, no hashes); a band whose
contexts all differ ends the search, as longer ones differ too.

``detect`` returns every row with its runs and the text without the repeats: a word goes if a run
contains it behind the run's first period. Runs may overlap; each is reported.

Defined results: null and empty texts and texts without words have no runs and an empty
collapsed text; kept words are joined by one space, so a text without runs is only
respaced; a null doc_id changes nothing; repeated rows are treated alike, ties do not arise (a
start and a period name one run); texts are processed whole, one at a time, in memory
proportional to their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, binary_column, packed, register, table, words

MIN_LENGTH = 24
MIN_POWER = 3
_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def word_ids(said: list) -> np.ndarray:
    """Equal words, equal numbers."""
    known: dict = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in said), np.int64, len(said))


def _contexts(ids: np.ndarray, have: int, want: int) -> np.ndarray:
    """Ranks of all ``want``-word contexts by start, from those of ``have`` words (have < want <= 2 * have)."""
    ahead = want - have
    pairs = ids[:-ahead] * (len(ids) + 1) + ids[ahead:]
    return np.unique(pairs, return_inverse=True)[1]


def _nearest(ids: np.ndarray) -> np.ndarray:
    """Distance to the nearest earlier equal entry; 0 where there is none."""
    order = np.argsort(ids, kind="stable")
    same = np.flatnonzero(ids[order[1:]] == ids[order[:-1]])
    lag = np.zeros(len(ids), np.int64)
    lag[order[same + 1]] = order[same + 1] - order[same]
    return lag


def _diagonals(lag: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
    """(first, last, lag) of stretches of consecutive places with one lag in (low, high]."""
    at = np.flatnonzero((lag > low) & (lag <= high))
    if not len(at):
        return []
    ends = np.flatnonzero((np.diff(at) != 1) | (np.diff(lag[at]) != 0))
    first, last = np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(at) - 1]])
    return list(zip(at[first].tolist(), at[last].tolist(), lag[at[first]].tolist()))


def runs_of(ids: np.ndarray, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the word numbers, by start, then period."""
    if min_power < 3 or min_length < 3:
        raise ValueError("runs need a length and a power of 3 at least")
    n, have, out = len(ids), 1, []
    if n < min_length:
        return out
    low, g, top = 0, 2 * min_length // 3, n // min_power
    while low < top:
        while have < g:
            want = min(2 * have, g)
            ids, have = _contexts(ids, have, want), want
            if ids.max() == len(ids) - 1:  # no context occurs twice
                return sorted(out)
        for first, last, q in _diagonals(_nearest(ids), low, min(g, top)):
            matches = last - first + g
            if matches + q >= max(min_length, min_power * q):
                out.append((first - q, matches + q, q))
        low, g = g, 2 * g
        if g > n:
            break
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(said: list, runs: list[tuple[int, int, int]]) -> list:
    """The words outside all repeats."""
    if not runs:
        return said
    step = np.zeros(len(said) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    covered = np.cumsum(step[:-1]) > 0
    return [w for w, c in zip(said, covered.tolist()) if not c]


def detect(docs: DataFrame, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> DataFrame:
    """Every row of ``docs`` (columns in ``_row``) with its ``runs`` (start, length, period) and ``collapsed_text``."""
    src = packed(docs).select(ROW, F.col(f"{ROW}.text").alias("text"))
    out = T.StructType([src.schema[ROW], T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed_text", T.StringType())])

    def run(batches):
        for b in batches:
            found, left = [], []
            for raw in binary_column(b, "text"):
                said = words(raw or b"")
                runs = runs_of(word_ids(said), min_length, min_power)
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                left.append(b" ".join(collapsed(said, runs)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(found, pa.list_(_ARROW_RUN)), pa.array(left, pa.binary()).cast(pa.string())],
                names=out.names)

    return src.mapInArrow(run, out)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period (runs come in that order)."""
    none = F.lit(None).cast(_RUN)
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def _altered(doc_id: Column, text: Column) -> Column:
    """The text with a period put into one document of ten, as the query's contract lays down."""
    said = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    n = F.size(said)
    a = g % n
    p = F.floor((n - a) / (3 + g % 8)) + 1
    block = F.slice(said, a.cast("int") + 1, p.cast("int"))  # whole arrays, no lambda: that would split the text for every word
    turned = F.slice(F.concat(F.slice(said, F.lit(1), a.cast("int")), F.flatten(F.array_repeat(block, (4 + g % 8).cast("int")))), F.lit(1), n)
    return F.when((h % 10 == 0) & text.isNotNull() & (n > 0), F.array_join(turned, " ")).otherwise(text)


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _altered(F.col("doc_id"), F.col("text")).alias("text"))
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return detect(docs).withColumn("best", strongest(F.col("runs"))).select(
        F.col(ROW)["doc_id"].alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
