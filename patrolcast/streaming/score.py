"""Scoring newly arriving incident files with Structured Streaming.

The studied scripts have no stream; the fitted plan (district means, feature
fit, model, class vocabulary) is fixed once trained, so scoring is the same
batch plan applied to each micro-batch. ``foreachBatch`` runs it; the output of
epoch e is written to ``<sink>/epoch=e`` with overwrite, so a retried epoch
replaces its own output (idempotent sink) and the checkpoint makes the source
offsets durable. Pass 1 of the repair (address matching) sees the rows of the
micro-batch, as the scripts apply it within the file being scored.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.features import FeatureFit, main_clean
from ..operators.repair import OutlierFit, handle_outliers
from ..sources.sinks import to_wide


@dataclass
class ScoringPlan:
    outliers: OutlierFit
    features: FeatureFit
    model: object          # anything with transform(df, keep=...) -> probability column
    vocabulary: list

    def score(self, df: DataFrame) -> DataFrame:
        repaired, _ = handle_outliers(df, self.outliers)
        feats, _ = main_clean(repaired, self.features)
        return to_wide(self.model.transform(feats, keep=("Id",)), self.vocabulary)


def score_stream(spark: SparkSession, source: str, schema: T.StructType, plan: ScoringPlan, sink: str,
                 checkpoint: str, fmt: str = "parquet", available_now: bool = True,
                 max_files_per_trigger: int | None = None):
    """Start the streaming query; returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source)

    def each(batch: DataFrame, epoch: int) -> None:
        plan.score(batch).write.mode("overwrite").parquet(os.path.join(sink, f"epoch={epoch}"))

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
