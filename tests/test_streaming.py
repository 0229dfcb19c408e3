"""A stream of incident files scored with a fitted plan equals the batch plan."""
import os
import tempfile


from patrolcast.models.boost import BoostParams, fit_boost
from patrolcast.operators.encode import Vocabulary
from patrolcast.operators.features import feature_columns, main_clean
from patrolcast.operators.repair import handle_outliers
from patrolcast.sources.incidents import incidents, train_rows
from patrolcast.sources.incidents import test_rows as holdout_rows
from patrolcast.streaming import ScoringPlan, score_stream

from conftest import SF_SMALL


def test_stream_scoring_matches_batch(spark):
    df = incidents(spark, SF_SMALL)
    tr, ofit = handle_outliers(train_rows(df).drop("Descript", "Resolution"))
    ftr, ffit = main_clean(tr)
    voc = Vocabulary.fit(ftr, "Category")
    model = fit_boost(voc.transform(ftr), feature_columns(ffit), voc.size, BoostParams(n_rounds=1, max_depth=3))[0]
    plan = ScoringPlan(ofit, ffit, model, voc.levels)
    base = tempfile.mkdtemp(prefix="pc-stream-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    test = holdout_rows(df)
    test.coalesce(1).write.parquet(src)
    q = score_stream(spark, src, test.schema, plan, sink, ckpt)
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink).drop("epoch")
    batch = plan.score(test)
    assert streamed.count() == batch.count() == test.count()
    diff = streamed.select(*batch.columns).exceptAll(batch)
    assert diff.count() == 0
