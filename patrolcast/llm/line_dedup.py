"""Line dedup with a log-template tree.

Every line with a word is parsed by a tree of fixed depth: its token count, then its first
``DEPTH`` tokens (tokens holding a digit count as the variable ``<*>`` everywhere). The
lines of one leaf generalise to the leaf's template: at each later position the token that
more than half of the leaf's line occurrences share, or ``<*>`` where no token does. A line
belongs to the template if at least ``SIMILARITY`` of all its tokens and half of those
behind the leading ones equal it.

A leaf has as many further templates as its lines support: of the (position, token) pairs that
``min_docs`` or more of the leaf's line occurrences hold, each line takes its most supported ones,
as many as the two shares above ask for, and lines that take the same pairs form a template. So a
template needs no majority in its leaf, however many other lines share its start. (A token that
differs within a template but is more frequent in the leaf than the template's own can divide it;
each piece then has to recur by itself.)

A template recurs if at least ``min_docs`` different texts hold one of its lines; so does a
masked line held by that many texts. A line that is the same in every token, digits included,
recurs from ``exact_docs`` texts (two in op2 and the pipeline, whatever its length): lines with
a digit are therefore counted masked and unmasked. Recurring lines are dropped everywhere but in the
first text that holds them (the one with the smallest doc_id), so nothing vanishes from the
corpus altogether. Exact copies of a text count once and lose the same lines.

All counting is by hash aggregation with map-side combine, so a line in a third of all
documents costs one row per task; no leaf is ever gathered. Lines and leaves are keyed by
64-bit hashes of their bytes, texts by 128-bit ones.

Defined results: null text stays null (no lines), empty text and lines without a word stay
as they are; a document whose lines are all dropped keeps an empty text (the pipeline stage
removes it unless it was empty before); null doc_ids count as the largest; rows sharing a
doc_id are told apart by text; repeated rows are treated alike.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, keep, key_bitmap, materialise, packed, register, table, text_key, unpacked

DEPTH = 3
SIMILARITY = 0.6
MIN_DOCS = 10
EXACT_DOCS = 2
_DIGIT = re.compile(rb"[0-9]")
_VARIABLE = re.compile(rb"[^\x20]*[0-9][^\x20]*")
_LAST = (1 << 63) - 1


def masked(line: bytes) -> bytes:
    """Tokens joined by one space, those with a digit replaced by ``<*>``; b"" without a token."""
    line = b" ".join(line.split())
    return _VARIABLE.sub(b"<*>", line) if _DIGIT.search(line) else line


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def line_hash(m: bytes) -> int:
    """Even for masked lines with a variable, odd for lines told by all their tokens."""
    h = signed(xxhash.xxh3_64_intdigest(m))
    return h & ~1 if b"<*>" in m else h | 1


def exact_hash(raw: bytes) -> int:
    """Of a line whose masked form has a variable: its unmasked tokens, odd."""
    return signed(xxhash.xxh3_64_intdigest(b" ".join(raw.split()), seed=1)) | 1


def leaf_hash(m: bytes) -> int:
    """Token count and leading tokens."""
    lead = m.split(b" ", DEPTH)[:DEPTH]
    return signed(xxhash.xxh3_64_intdigest(b" ".join([b"%d" % (m.count(b" ") + 1), *lead])))


def _utf8(col: pa.Array) -> list:
    return col.cast(pa.binary()).to_pylist()


def lines_of(docs: DataFrame, leaves: tuple | None = None, exact: bool = False) -> DataFrame:
    """The distinct masked lines of every text (``exact``: also the distinct unmasked ones of those with a variable):
    leaf and line hash with the text's keys, or, given a bitmap (a broadcast) and mask of leaves, with the line itself
    where its leaf may be among them."""
    with_text = leaves is not None
    src = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("d"),
                      F.col("text"), *text_key(F.col("text")))
    fields = [T.StructField(c, T.LongType()) for c in (["leaf", "line"] if with_text else ["leaf", "line", "k1", "k2", "d"])]
    if with_text:
        fields.append(T.StructField("words", T.StringType()))
    names = [f.name for f in fields]

    def run(batches):
        bitmap, mask = (leaves[0].value, leaves[1]) if with_text else (b"", 0)
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            leaf, line, row, said = [], [], [], []
            for i, text in enumerate(_utf8(col["text"])):
                if not text:
                    continue
                seen = set()
                for raw in text.split(b"\n"):
                    m = masked(raw)
                    if not m:
                        continue
                    if (h := line_hash(m)) not in seen:
                        seen.add(h)
                        at_leaf = leaf_hash(m)
                        if with_text:
                            pos = at_leaf & mask
                            if not bitmap[pos >> 3] >> (pos & 7) & 1:
                                continue
                            said.append(m)
                        leaf.append(at_leaf)
                        line.append(h)
                        row.append(i)
                    if exact and not h & 1 and (h := exact_hash(raw)) not in seen:
                        seen.add(h)
                        leaf.append(h)  # a leaf of its own
                        line.append(h)
                        row.append(i)
            out = [pa.array(leaf, pa.int64()), pa.array(line, pa.int64())]
            if with_text:
                out.append(pa.array(said, pa.binary()).cast(pa.string()))
            else:
                at = pa.array(row, pa.int64())
                out += [col[k].take(at) for k in ("k1", "k2", "d")]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return src.mapInArrow(run, T.StructType(fields))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, similarity: float = SIMILARITY,
              exact_docs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(occurrences, recurring): ``leaf, line, k1, k2, d`` of every distinct line of every distinct text;
    ``line, first`` of the recurring lines, ``first`` the smallest doc_id holding the template."""
    exact_docs = exact_docs or min_docs
    occ = keep(lines_of(docs, exact=exact_docs < min_docs).groupBy("leaf", "line", "k1", "k2").agg(F.min("d").alias("d")))
    per_line = keep(occ.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.min("d").alias("d")))
    leaves = materialise(per_line.groupBy("leaf").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
                         .where((F.col("kinds") > 1) & (F.col("total") >= min_docs)).select("leaf", "total"))
    bitmap, mask = key_bitmap(leaves, "leaf")
    said = lines_of(docs, (docs.sparkSession.sparkContext.broadcast(bitmap), mask)).dropDuplicates(["line"])
    tokens = materialise(said.join(leaves, "leaf").join(per_line, ["leaf", "line"])).select(
        "leaf", "line", "total", "n", "d", F.size(F.split("words", " ")).alias("size"),
        F.posexplode(F.split("words", " ")).alias("pos", "token")).where(F.col("pos") >= DEPTH)
    votes = tokens.groupBy("leaf", "pos", "token").agg(F.sum("n").alias("votes"), F.first("total").alias("total"))
    major = F.col("votes") * 2 > F.col("total")
    shared = votes.where(major | (F.col("votes") >= min_docs)).select(
        "leaf", "pos", "token", "votes", major.cast("int").alias("major"))
    pair = F.struct((-F.col("votes")).alias("v"), "pos", F.xxhash64("token").alias("t"))
    need = F.greatest(F.ceil(similarity * F.col("size")) - DEPTH, F.ceil((F.col("size") - DEPTH) / 2)).cast("int")
    member = materialise(
        tokens.join(shared, ["leaf", "pos", "token"]).groupBy("leaf", "line", "n", "d", "size")
        .agg(F.sum("major").alias("equal"),
             F.sort_array(F.collect_list(F.when(F.col("votes") >= min_docs, pair))).alias("pairs"))  # of one line
        .select("leaf", "line", "n", "d", (F.col("equal") >= need).alias("voted"),
                F.when(F.size("pairs") >= need, F.xxhash64(F.slice("pairs", F.lit(1), need))).alias("key"))
        .where(F.col("voted") | F.col("key").isNotNull()))
    total = [F.sum("n").alias("of_all"), F.min("d").alias("first")]
    voted, keyed = member.where("voted"), member.where(F.col("key").isNotNull())
    by_vote = voted.join(voted.groupBy("leaf").agg(*total).where(F.col("of_all") >= min_docs), "leaf")
    by_key = keyed.join(keyed.groupBy("leaf", "key").agg(*total).where(F.col("of_all") >= min_docs), ["leaf", "key"])
    by_template = by_vote.select("line", "first").unionByName(by_key.select("line", "first"))
    literal = F.col("line").bitwiseAND(F.lit(1)) == 1
    exact = per_line.where(F.col("n") >= F.when(literal, exact_docs).otherwise(min_docs)).select("line", F.col("d").alias("first"))
    return occ, materialise(by_template.unionByName(exact).groupBy("line").agg(F.min("first").alias("first")))


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, exact_docs: int | None = None) -> DataFrame:
    """Every row of ``docs`` (columns in ``_row``) with ``kept_text``, ``n_lines``, ``n_dropped``."""
    occ, rec = recurring(docs, min_docs, exact_docs=exact_docs)
    drop = occ.join(rec, "line").where(F.col("d") != F.col("first")).groupBy("k1", "k2") \
        .agg(F.collect_list("line").alias("drop"))  # at most the lines of one text
    src = packed(docs).select(ROW, *text_key(F.col(f"{ROW}.text"))).join(drop, ["k1", "k2"], "left") \
        .select(ROW, F.col(f"{ROW}.text").alias("text"), "drop")
    out = T.StructType([src.schema[ROW], T.StructField("kept_text", T.StringType()),
                        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches):
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            kept, n_lines, n_dropped = [], [], []
            for text, gone in zip(_utf8(col["text"]), col["drop"].to_pylist()):
                lines = [] if text is None else text.split(b"\n")
                n_lines.append(len(lines))
                if not gone:
                    kept.append(text)
                    n_dropped.append(0)
                    continue
                gone = set(gone)
                left = [x for x in lines if not ((m := masked(x)) and ((h := line_hash(m)) in gone or
                                                                       (not h & 1 and exact_hash(x) in gone)))]
                kept.append(b"\n".join(left))
                n_dropped.append(len(lines) - len(left))
            yield pa.RecordBatch.from_arrays(
                [col[ROW], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64())], names=[ROW, "kept_text", "n_lines", "n_dropped"])

    return src.mapInArrow(run, out)


@register("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs, exact_docs=EXACT_DOCS).select(F.col(f"{ROW}.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                              F.col("kept_text").alias("text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: recurring lines leave the texts; documents that lose every word go."""
    done = dedup(docs, exact_docs=EXACT_DOCS).where((F.col("n_dropped") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    row = F.col(ROW)
    lower = {c.lower(): c for c in docs.columns}
    done = done.withColumn(ROW, row.withField(f"`{lower['text']}`", F.col("kept_text")))
    if "n_chars" in lower:
        size = F.when(F.col("n_dropped") > 0, F.length("kept_text")).otherwise(row[lower["n_chars"]])
        done = done.withColumn(ROW, row.withField(f"`{lower['n_chars']}`", size.cast(docs.schema[lower["n_chars"]].dataType)))
    return unpacked(done, docs.columns)
