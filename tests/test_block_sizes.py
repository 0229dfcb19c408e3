"""Packed blocks, cached batches and sent sums are bounded, and fits do not depend on how blocks are cut."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from patrolcast import session
from patrolcast.models import boost
from patrolcast.models.base import packed_rows
from patrolcast.models.boost import Binner, BoostParams, fit_boost

K, BATCH = 3, "spark.sql.inMemoryColumnarStorage.batchSize"


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(9000).select(F.col("id").alias("Id"), (F.col("id") % K).cast("int").alias("label"), F.lit(0).alias("grp"),
                                  *[F.rand(i).alias(f"x{i}") for i in range(40)]).coalesce(1).cache()
    df.count()
    return df


def test_blocks_of_a_linear_fit(spark, rows):
    cols, was = [f"x{i}" for i in range(40)], spark.conf.get(BATCH)
    data = packed_rows(rows, cols)
    sizes = [len(r["x"]) for r in data.df.collect()]
    data.unpersist()
    assert sum(sizes) == 9000 * 40 * 8 and max(sizes) <= session.BLOCK_BYTES
    assert spark.conf.get(BATCH) == was


def test_blocks_of_a_booster_with_many_trees(spark, rows):
    cols = ["x0", "x1"]
    data, n = boost._prepare(rows, cols, Binner.fit(rows, cols, 8), 50, K, "label", None, [])
    sizes = [(len(r["z"]), r["n"]) for r in data.collect()]
    joined = [len(ids) for ids, *_ in boost._blocks(data.toArrow().to_batches(), 2)]
    data.unpersist()
    assert n == sum(m for _, m in sizes) == sum(joined) == 9000
    assert max(z for z, _ in sizes) <= session.BLOCK_BYTES < max(joined) * 8 * 50 * K


def test_a_booster_does_not_depend_on_blocks(spark, rows, monkeypatch):
    cols, p = ["x0", "x1", "x2"], BoostParams(n_rounds=2, max_depth=3, max_bins=8)
    binner = Binner.fit(rows, cols, 8)
    whole = fit_boost(rows, cols, K, p, binner=binner)[0]
    for name, value in (("RAW_ROWS", 500), ("SENT_BYTES", 1000), ("BLOCK_BYTES", 4000), ("BLOCK_ROWS", 700)):
        monkeypatch.setattr(boost, name, value)
    cut = fit_boost(rows, cols, K, p, binner=binner)[0]
    X = np.random.RandomState(0).rand(50, 3)
    assert np.allclose(whole.predict_proba(X), cut.predict_proba(X), atol=1e-9)
