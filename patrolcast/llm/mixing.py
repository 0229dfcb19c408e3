"""Mixing sources to target weights along a time-varying curriculum (DataFrame operations only).

Targets: sources in code point order (null last) weigh 1, 2, 3, repeating, and share the sum
of all sizes; a target stops at ``MAX_EPOCHS`` times its source's size and the excess is
reshared by weight until none is above (solved at once: sources ordered by the level at
which they fill up).

Which documents: a source is a stream of its documents in the order of a seeded hash,
repeated; ``c`` words lie before a document. Copy ``k`` is taken if its middle,
``k * source_size + c + size / 2``, lies within the target, so each source ends within half
a document of its target.

When: a source's weight over training time ``t`` in [0, 1] is piecewise linear
(``SCHEDULES``, by weight class). Its integral is the source's cumulative token demand; a
copy whose middle is at fraction ``u`` of the target is due where the integral reaches
``u``. Copies (``curriculum``) and documents (``mix``, by their first copy) are range-sorted by that position.

Running sums of a source never need its rows in one task: rows fall into ranges of the
hash, sized by the row count alone; sums of ranges are added up on two levels, and only the
rows of one range are sorted together. The result does not depend on the number of ranges.

Defined results: size is 0 for null and wordless texts, which are never taken (taken 0, no
position); a source without words has target 0; rows that share hash, doc_id and size are
interchangeable; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, WORD, materialise, packed, register, table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 17
ROWS_PER_RANGE = 1000
#: (training time, weight) knots by weight class: early, steady and late sources.
SCHEDULES = {1: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 3: ((0.0, 0.25), (0.25, 1.0), (1.0, 1.5))}


def segments(knots) -> list[tuple[float, float, float, float, float, float]]:
    """(t0, t1, w0, w1, share before, area of the whole schedule) of each linear piece."""
    area = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    whole, before, out = sum(area), 0.0, []
    for (t0, w0), (t1, w1), a in zip(knots, knots[1:], area):
        out.append((t0, t1, w0, w1, before / whole, whole))
        before += a
    return out


def demand_inverse_sql(u: str, weight: str, schedules=SCHEDULES) -> str:
    """SQL (Spark and DuckDB) for the time at which a class's cumulative demand reaches ``u``."""
    cases = []
    for cls, knots in sorted(schedules.items()):
        for t0, t1, w0, w1, before, whole in reversed(segments(knots)):
            y = f"(({u} - {before!r}D) * {whole!r}D)"
            t = f"{t0!r}D + 2D * {y} / ({w0!r}D + sqrt({w0 * w0!r}D + 2D * {(w1 - w0) / (t1 - t0)!r}D * {y}))"
            cases.append(f"WHEN {weight} = {cls} AND {u} >= {before!r}D THEN {t}")
    return f"CASE {' '.join(cases)} END"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, weight, source_size, target) from (source, source_size): one row per source."""
    ranked = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int")))
    full = ranked.withColumn("cap", F.col("source_size") * max_epochs) \
        .withColumn("level", F.col("cap").cast("double") / F.col("weight"))
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lam = full.withColumn("lam", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0)))
                          .cast("double") / F.sum("weight").over(rest))
    final = lam.withColumn("level_all", F.min(F.when(F.col("lam") < F.col("level"), F.struct("level", "lam"))).over(everything)["lam"])
    return final.select("source", "weight", "source_size", F.when(F.col("lam") < F.col("level"),
                        F.col("level_all") * F.col("weight")).otherwise(F.col("cap").cast("double")).alias("target"))


def placed_copies(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, schedules=SCHEDULES,
        size: str | None = None) -> DataFrame:
    """Every row of ``docs`` (in ``_row``) with size, source_size, target and ``positions``: the training time
    of each copy taken (an empty array if none). ``size`` names a column that holds the sizes, so that rows need no text.

    Rows with a null doc_id share one hash, that of the empty id: they are placed one after the other in one hash range."""
    row = F.col(ROW)
    src = packed(docs).select(ROW, row["doc_id"].alias("_id"), row["source"].alias("source"),
                              (word_count(row["text"]) if size is None else row[size]).alias("size"))
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    src = src.withColumn("h", F.conv(F.substring(key, 1, 8), 16, 10).cast("long"))
    bits = min(32, max(0, math.ceil(math.log2(max(1, docs.count()) / ROWS_PER_RANGE))))
    src = src.withColumn("fine", F.shiftright("h", 32 - bits))
    sums = src.groupBy("source", "fine").agg(F.sum("size").alias("s")).withColumn(
        "coarse", F.shiftright("fine", bits - bits // 2))
    of_source = source_targets(sums.groupBy("source").agg(F.sum("s").alias("source_size")), weights, max_epochs)
    upper = Window.partitionBy("source").orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    lower = Window.partitionBy("source", "coarse").orderBy("fine").rowsBetween(Window.unboundedPreceding, -1)
    of_coarse = sums.groupBy("source", "coarse").agg(F.sum("s").alias("s1")).withColumn("before1", F.sum("s1").over(upper))
    zero = F.lit(0)
    of_range = sums.withColumn("before2", F.sum("s").over(lower)).alias("f").join(
        of_coarse.alias("c"), F.col("f.source").eqNullSafe(F.col("c.source")) & (F.col("f.coarse") == F.col("c.coarse"))) \
        .select("f.source", "f.fine", (F.coalesce("before1", zero) + F.coalesce("before2", zero)).alias("before"))
    at = of_range.alias("r").join(of_source.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))) \
        .select(F.col("r.source").alias("_source"), F.col("r.fine").alias("_fine"), "before", "weight", "source_size", "target")
    inside = Window.partitionBy("source", "fine").orderBy("h", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = src.withColumn("within", F.coalesce(F.sum("size").over(inside), zero)).join(
        at, F.col("source").eqNullSafe(F.col("_source")) & (F.col("fine") == F.col("_fine")))
    middle = [f"(2 * ({k} * source_size + before + within) + size)" for k in range(max_epochs)]
    copies = [F.expr(f"CASE WHEN size > 0 AND {m} <= 2 * target THEN "
                     f"{demand_inverse_sql(f'({m} / (2D * target))', 'weight', schedules)} END") for m in middle]
    return placed.select(ROW, "source", "size", "source_size", "target", F.array_compact(F.array(*copies)).alias("positions"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``placed_copies`` in training order: range-sorted by the position of the first copy, rows that are not
    taken last."""
    first = F.try_element_at("positions", F.lit(1))
    return placed_copies(docs, **settings).orderBy(first.asc_nulls_last(), F.col(ROW)["doc_id"])


def curriculum(docs: DataFrame, **settings) -> DataFrame:
    """The mix copy by copy (``_row``, copy, position), range-sorted by position."""
    flat = placed_copies(docs, **settings).select(ROW, F.posexplode("positions").alias("copy", "position"))
    return flat.orderBy("position", F.col(ROW)["doc_id"], "copy")


def _duck(sql: str) -> str:
    """The same expression with DuckDB's spelling of double literals."""
    return re.sub(r"(\d)D\b", r"\1::DOUBLE", sql)


OP9_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
                  CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
      FROM d GROUP BY source),
l AS (SELECT *, source_size * {MAX_EPOCHS} AS cap, CAST(source_size * {MAX_EPOCHS} AS DOUBLE) / weight AS level FROM s),
m AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY level, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
             / sum(weight) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam FROM l),
t AS (SELECT source, weight, source_size, CASE WHEN lam < level THEN
             (SELECT arg_min(lam, level) FROM m WHERE lam < level) * weight ELSE CAST(cap AS DOUBLE) END AS target FROM m),
c AS (SELECT d.doc_id, d.size, t.*, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * ({' + '.join(f'(size > 0 AND 2 * ({k} * source_size + before) + size <= 2 * target)::INT' for k in range(MAX_EPOCHS))}) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND 2 * before + size <= 2 * target THEN
            round({_duck(demand_inverse_sql('((2 * before + size) / (2D * target))', 'weight'))}, 6) END AS position
FROM c
"""


@register("op9_mixing", OP9_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(materialise(docs), size="size").select(  # words are counted once, no text is shuffled
        F.col(ROW)["doc_id"].alias("doc_id"), "size", "source_size", "target",
        (F.size("positions") * F.col("size")).cast("long").alias("taken"),
        F.round(F.try_element_at("positions", F.lit(1)), 6).alias("position"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the mix, one row per copy in training order, with the copy's number and position."""
    done = curriculum(docs)
    extra = {}
    for c in ("mix_copy", "mix_position"):
        while c.lower() in {x.lower() for x in docs.columns}:
            c = "_" + c
        extra[len(extra)] = c
    return done.select(*[F.col(ROW)[c].alias(c) for c in docs.columns], F.col("copy").alias(extra[0]),
                       F.col("position").alias(extra[1]))
