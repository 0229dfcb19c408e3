"""Sinks: wide probability table (A3), trial log (A4), model persistence (A5).

Inside the library probabilities travel as one ``array<double>`` column per row
(ordered by the class vocabulary) or in long form ``(Id, Category, p)``; the
wide ``Id, <class...>`` layout is produced only here, at the sink, by a
projection (no pivot shuffle, since the vocabulary is known).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_wide(df: DataFrame, vocab: list[str], prob_col: str = "probability") -> DataFrame:
    """``Id`` first, one double column per class named from the vocabulary."""
    return df.select("Id", *[F.col(prob_col)[i].alias(v) for i, v in enumerate(vocab)])


def to_long(df: DataFrame, vocab: list[str], prob_col: str = "probability") -> DataFrame:
    """``(Id, Category, p)`` rows; each row of ``df`` yields one row per class."""
    names = F.array(*[F.lit(v) for v in vocab])
    return (df.select("Id", F.posexplode(prob_col).alias("k", "p"))
            .select("Id", names[F.col("k")].alias("Category"), "p"))


def long_to_wide(long: DataFrame, vocab: list[str]) -> DataFrame:
    """Long form back to wide with an explicit vocabulary (no extra distinct job)."""
    return long.groupBy("Id").pivot("Category", vocab).agg(F.first("p"))


def write_probabilities(wide: DataFrame, path: str) -> None:
    """A3: header CSV ``Id,<class...>``, no index column."""
    wide.write.mode("overwrite").option("header", "true").csv(path)


def read_probabilities(spark: SparkSession, path: str, vocab: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField("Id", T.LongType())] + [T.StructField(v, T.DoubleType()) for v in vocab])
    return spark.read.schema(schema).option("header", "true").csv(path)


TRIAL_SCHEMA = T.StructType([
    T.StructField("loss", T.DoubleType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("iteration", T.IntegerType()),
    T.StructField("estimators", T.IntegerType()),
])


def append_trial(spark: SparkSession, path: str, loss: float, params: dict, iteration: int,
                 estimators: int | None = None) -> None:
    """A4: append one trial row to a Parquet trial log."""
    append_trials(spark, path, [(loss, params, iteration, estimators)])


def append_trials(spark: SparkSession, path: str, trials: list[tuple]) -> None:
    """A4 for the trials of one run: ``(loss, params, iteration, estimators)`` each, appended together."""
    rows = [(float(loss), {k: json.dumps(v) for k, v in params.items()}, int(iteration),
             None if estimators is None else int(estimators)) for loss, params, iteration, estimators in trials]
    spark.createDataFrame(rows, TRIAL_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIAL_SCHEMA).parquet(path)
