"""Encoders: label vocabulary (E6), standard scaler (I1), feature sets (C3),
column helpers (C1, C2, C7, C8), class weights (K16).

Fitted state is small (two numbers per feature, a vocabulary of at most ``MAX_LITERAL`` levels); applying it is a
projection with literal maps, so no join and no shuffle happens at transform time. A larger vocabulary is a table of
(level, code) in the shared folder and is applied by an equi-join, so neither the driver nor the plan grows with it.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import LINEAR_DROP, QUADRATIC_DROP
from ..session import checkpoint_dir

MAX_LITERAL = 4096  # levels; a larger vocabulary is a table


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """C1."""
    return df.drop(*cols)


def select_columns(df: DataFrame, cols) -> DataFrame:
    """C2."""
    return df.select(*cols)


def feature_set(all_features: list[str], name: str) -> list[str]:
    """``linear`` (25 of 37), ``quadratic`` (17 of 37) or ``all``."""
    if name == "all":
        return list(all_features)
    drop = {"linear": LINEAR_DROP, "quadratic": QUADRATIC_DROP}[name]
    return [c for c in all_features if c not in set(drop)]


def columns_by_type(df: DataFrame, exclude=("Id", "Category", "label")) -> list[int]:
    """Positions (among feature columns) of columns that are not double (the categorical ones)."""
    feats = [f for f in df.schema.fields if f.name not in exclude]
    return [i for i, f in enumerate(feats) if not isinstance(f.dataType, T.DoubleType)]


@dataclass
class Vocabulary:
    """Sorted distinct levels -> 0-based codes; NULL or unseen -> -1."""
    column: str
    levels: list | None              # None: they are in ``table``
    table: DataFrame | None = None   # level, code
    n: int = 0                       # levels of the table

    @classmethod
    def fit(cls, df: DataFrame, column: str, max_literal: int = MAX_LITERAL) -> "Vocabulary":
        distinct = df.select(F.col(f"`{column}`").alias("level")).where("level IS NOT NULL").distinct()
        rows = distinct.limit(max_literal + 1).collect()
        if len(rows) <= max_literal:
            return cls(column, sorted(r[0] for r in rows))
        # ranges of levels in order, each numbered by itself; what was written is what the offsets count
        path = os.path.join(checkpoint_dir(df.sparkSession), "staging", f"levels-{uuid.uuid4().hex[:12]}")
        part = F.spark_partition_id()
        distinct.repartitionByRange("level").sortWithinPartitions("level").select(
            "level", part.alias("part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("place")) \
            .write.parquet(path)
        written = df.sparkSession.read.parquet(path)
        begins, total = [], 0
        for r in sorted(written.groupBy("part").count().collect()):  # a row for each range, at most spark.sql.shuffle.partitions
            begins += [F.lit(r["part"]), F.lit(total)]
            total += r["count"]
        code = (F.create_map(*begins)[F.col("part")] + F.col("place")).cast("int")
        return cls(column, None, written.select("level", code.alias("code")), total)

    def code(self, col: str | None = None, base: int = 0) -> Column:
        """The code as an expression; only a vocabulary that is not a table has one."""
        if self.levels is None:
            raise ValueError(f"the {self.n} levels of {self.column} are a table: use transform")
        kv = []
        for i, v in enumerate(self.levels):
            kv += [F.lit(v), F.lit(i + base)]
        m = F.create_map(*kv) if kv else F.create_map().cast("map<string,int>")
        return F.coalesce(m[F.col(col or self.column)], F.lit(-1)).cast("int")

    def transform(self, df: DataFrame, output: str = "label", base: int = 0) -> DataFrame:
        if self.levels is not None:
            return df.withColumn(output, self.code(base=base))
        rows, table = df.alias("_rows"), self.table.select(F.col("level").alias("_level"), F.col("code").alias("_code"))
        kept = [F.col(f"_rows.`{c}`") for c in df.columns if c != output]
        return rows.join(table, F.col(f"_rows.`{self.column}`") == F.col("_level"), "left").select(
            *kept, F.coalesce(F.col("_code") + base, F.lit(-1)).cast("int").alias(output))

    @property
    def size(self) -> int:
        return self.n if self.levels is None else len(self.levels)


@dataclass
class StandardScaler:
    """(x - mean) / population std; a constant column maps to 0."""
    columns: list
    mean: list
    std: list
    n: int = 0          # rows seen by the fit

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> "StandardScaler":
        aggs = []
        for c in columns:
            aggs += [F.avg(F.col(f"`{c}`").cast("double")), F.stddev_pop(F.col(f"`{c}`").cast("double"))]
        row = df.agg(*aggs, F.count(F.lit(1))).first()
        mean = [row[2 * i] for i in range(len(columns))]
        std = [row[2 * i + 1] for i in range(len(columns))]
        return cls(list(columns), mean, std, int(row[-1]))

    def exprs(self) -> dict[str, Column]:
        out = {}
        for c, m, s in zip(self.columns, self.mean, self.std):
            scale = s if (s is not None and s > 0) else 1.0
            out[c] = (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(scale)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.exprs())


def insert_and_rename(df: DataFrame, vocab: list[str], prob_col: str = "probability") -> DataFrame:
    """``Id`` first, then one column per class named from the vocabulary."""
    return df.select("Id", *[F.col(prob_col)[i].alias(v) for i, v in enumerate(vocab)])


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    """Rows per class (bounded by the number of classes)."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def balanced_weight(counts: dict[int, int], label: str = "label") -> Column:
    """N / (K * n_k) as a literal map lookup."""
    n, k = sum(counts.values()), len(counts)
    kv = []
    for c, nk in sorted(counts.items()):
        kv += [F.lit(c), F.lit(n / (k * nk))]
    return F.create_map(*kv)[F.col(label)]
