"""What the driver plans and keeps for a booster's rounds grows with the rounds, not as a power of two."""
import numpy as np

from patrolcast.models import boost
from patrolcast.models.boost import BoostParams, fit_boost

COLS, K = ["a", "b"], 2


def test_plans_do_not_double_with_every_round(spark, monkeypatch):
    rng = np.random.RandomState(3)
    X = rng.normal(size=(60, 2))
    df = spark.createDataFrame([(i, int(X[i, 0] + X[i, 1] > 0), *map(float, X[i])) for i in range(60)],
                               "Id long, label int, a double, b double").repartition(2)
    sizes, adaptive = [], spark.conf.get("spark.sql.adaptive.enabled")
    advance = boost._advance

    def watched(*a):
        out = advance(*a)
        sizes.append(len(out._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(boost, "_advance", watched)
    model = fit_boost(df, COLS, K, BoostParams(n_rounds=8, max_depth=2, growth="symmetric"))[0]
    assert len(model.rounds) == 8 and spark.conf.get("spark.sql.adaptive.enabled") == adaptive
    assert sizes[7] - sizes[6] < 2 * (sizes[2] - sizes[1])  # it was 32 times as much
