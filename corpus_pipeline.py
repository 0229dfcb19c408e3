"""A training corpus from raw documents: five stages, each one of the operators of ``patrolcast.llm``.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads; between stages
the documents are written as Parquet into the shared checkpoint folder. All but the last
return the columns of ``documents``; the mix adds the copy's number and training position.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from patrolcast.llm import decontaminate, language_id, line_dedup, mixing, simhash
from patrolcast.llm.common import LlmQuery, checkpoint_dir, released, table

STAGES = [
    ("language_id", language_id.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("mixing", mixing.stage),
]

#: Suffix automata, fingerprints and components have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, function) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        with released():  # a stage's cached tables end with it
            function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERY = LlmQuery("pipeline", run, ORACLE_SQL)
