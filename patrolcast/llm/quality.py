"""Quality rules, line first.

Each line with a word is judged alone:

* punctuation: a line fails if symbols make up over ``MAX_SYMBOLS`` of its characters other
  than blanks, or if it has at least ``LONG_LINE`` words and no sentence mark at all;
* navigation: a line fails if at least ``MIN_SEPARATORS`` of its words are separators
  (``| > » · • / - :: ->``) and these are over ``MAX_SEPARATORS`` of its words;
* boilerplate: a line of at most ``BOILERPLATE_WORDS`` words fails if it holds one of the
  ``BOILERPLATE`` phrases (case ignored).

Failing lines are removed. A document is kept if it passes the base rules (at least
``MIN_WORDS`` words, at most 30 % of them in repeated 8-word windows) and its failing lines
hold at most ``MAX_LOST`` of its words.

Defined results: null counts as a text without words (kept_text null); a text without words
is not kept; lines without a word are neither judged nor removed; words, lines and
characters are those of the whole text, whatever its length.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, WORD, packed, register, table

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED = 30  # per cent
MAX_SYMBOLS = 0.10
MAX_SEPARATORS = 0.2
MIN_SEPARATORS = 3
LONG_LINE = 40
BOILERPLATE_WORDS = 25
MAX_LOST = 0.5
SYMBOLS = "#*$%&|<>"
# Phrases of licence, cookie, account and sharing boilerplate.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "accept cookies", "sign in", "sign up", "log in", "subscribe to our", "click here", "read more", "share this",
    "follow us", "back to top", "skip to content", "powered by", "copyright ©", "licensed under", "released under the",
    "alle rechte vorbehalten", "tous droits réservés", "todos los derechos reservados",
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
_SEPARATORS = frozenset(["|", ">", "»", "·", "•", "/", "-", "–", "::", "->", "||", ">>"])
_MARKS = frozenset(".!?…:;。！？")
_TO_SPACE = dict.fromkeys([9, 10, 11, 12, 13], " ")


def split_words(text: str) -> list[str]:
    """Words by the fixed rule (str.split() would also cut at other Unicode blanks)."""
    return [w for w in text.translate(_TO_SPACE).split(" ") if w]


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text (all their occurrences)."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    code: dict[str, int] = {}
    ids = np.array([code.setdefault(w, len(code)) for w in words], dtype=np.int64)
    span = 1
    while span < window:  # ranks of runs of 2, 4, 8 words: equal ranks are equal runs
        step = min(span, window - span)
        pair = ids[:len(ids) - step] * (int(ids.max()) + 1) + ids[step:]
        _, ids, count = np.unique(pair, return_inverse=True, return_counts=True)
        if count.max() < 2:
            return 0
        span += step
    hit = count[ids] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_fault(line: str, words: list[str]) -> str | None:
    """The rule that a line with words breaks, if any."""
    separators = sum(w in _SEPARATORS for w in words)
    if separators >= MIN_SEPARATORS and separators > MAX_SEPARATORS * len(words):
        return "navigation"
    n_symbols = sum(line.count(s) for s in SYMBOLS)
    if n_symbols > MAX_SYMBOLS * sum(map(len, words)):
        return "punctuation"
    if len(words) >= LONG_LINE and not _MARKS.intersection(line):
        return "punctuation"
    if len(words) <= BOILERPLATE_WORDS and _BOILERPLATE.search(line.lower()):
        return "boilerplate"
    return None


def judge(text: str | None) -> dict:
    """All measures of one text, its cleaned text and the verdict."""
    lines = [] if text is None else text.split("\n")
    by_line = [split_words(x) for x in lines]
    words = [w for ws in by_line for w in ws]
    faults = Counter()
    lost, left, seen, dup = 0, [], set(), 0
    for line, ws in zip(lines, by_line):
        if ws:
            if line in seen:
                dup += 1
            seen.add(line)
            if fault := line_fault(line, ws):
                faults[fault] += 1
                lost += len(ws)
                continue
        left.append(line)
    repeated = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED * len(words)
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(text.count(s) for s in SYMBOLS) if text else 0, "n_dup_lines": dup,
            "n_repeat_words": repeated, "base_failed": base_failed,
            "kept": not base_failed and lost <= MAX_LOST * len(words), "lost_words": lost,
            "bad_punctuation": faults["punctuation"], "bad_navigation": faults["navigation"],
            "bad_boilerplate": faults["boilerplate"], "kept_text": None if text is None else "\n".join(left)}


_FIELDS = ([(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
           + [("base_failed", T.BooleanType()), ("kept", T.BooleanType())]
           + [(c, T.LongType()) for c in ("lost_words", "bad_punctuation", "bad_navigation", "bad_boilerplate")]
           + [("kept_text", T.StringType())])
_ARROW = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` (in ``_row``) with the measures, the verdict and the cleaned text."""
    src = packed(docs).select(ROW, F.col(ROW)[text].cast("string").alias("_text"))
    out = T.StructType([src.schema[ROW], *[T.StructField(n, t) for n, t in _FIELDS]])

    def run(batches):
        for b in batches:
            found = [judge(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([f[n] for f in found], _ARROW[t.simpleString()]) for n, t in _FIELDS]],
                names=out.names)

    return src.mapInArrow(run, out)


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w FROM documents),
x AS (SELECT rid, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, string_split(text, chr(10)) AS parts FROM d WHERE text IS NOT NULL),
l AS (SELECT rid, i, parts[i] AS line, regexp_extract_all(parts[i], '{WORD}') AS w FROM x),
f AS (SELECT *, len(w) AS n, len(list_filter(w, lambda v: v IN ({_sql_list(sorted(_SEPARATORS))}))) AS seps,
             len(regexp_extract_all(line, '[{SYMBOLS}]')) AS syms, length(array_to_string(w, '')) AS chars FROM l),
r AS (SELECT *, CASE WHEN n = 0 THEN NULL WHEN seps >= {MIN_SEPARATORS} AND seps > {MAX_SEPARATORS} * n THEN 'navigation'
             WHEN syms > {MAX_SYMBOLS} * chars THEN 'punctuation'
             WHEN n >= {LONG_LINE} AND NOT regexp_matches(line, '[{"".join(sorted(_MARKS))}]') THEN 'punctuation'
             WHEN n <= {BOILERPLATE_WORDS} AND len(list_filter([{_sql_list(BOILERPLATE)}], lambda b: contains(lower(line), b))) > 0
             THEN 'boilerplate' END AS fault, row_number() OVER (PARTITION BY rid, line ORDER BY i) AS nth FROM f),
t AS (SELECT rid, count(*) FILTER (WHERE n > 0 AND nth > 1) AS dup, coalesce(sum(n) FILTER (WHERE fault IS NOT NULL), 0) AS lost,
             count(*) FILTER (WHERE fault = 'punctuation') AS p, count(*) FILTER (WHERE fault = 'navigation') AS v,
             count(*) FILTER (WHERE fault = 'boilerplate') AS b,
             sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE fault IS NULL), '')) AS sha FROM r GROUP BY rid),
g AS (SELECT rid, a, array_to_string(w[a:a + {WINDOW} - 1], ' ') AS gram
      FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS a FROM d WHERE len(w) >= {WINDOW})),
h AS (SELECT rid, a, count(*) OVER (PARTITION BY rid, gram) AS c FROM g),
k AS (SELECT rid, count(DISTINCT q) AS n_rep FROM (SELECT rid, unnest(range(a, a + {WINDOW})) AS q FROM h WHERE c > 1) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(length(array_to_string(d.w, '')) AS BIGINT) AS word_chars,
             CAST(coalesce(len(regexp_extract_all(text, '[{SYMBOLS}]')), 0) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS lost_words,
             coalesce(p, 0) AS bad_punctuation, coalesce(v, 0) AS bad_navigation, coalesce(b, 0) AS bad_boilerplate, sha AS kept_text_sha256
      FROM d LEFT JOIN t USING (rid) LEFT JOIN k USING (rid))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AND lost_words <= {MAX_LOST} * n_words AS kept
FROM m
"""


@register("op6_quality_rules", OP6_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = clean(docs)
    return done.select(F.col(ROW)["doc_id"].alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept", "lost_words", "bad_punctuation", "bad_navigation",
                       "bad_boilerplate", F.sha2(F.col("kept_text"), 256).alias("kept_text_sha256"))
