"""The code paths that only trigger on large data, forced on small data and
compared with the small-data paths."""
import tempfile
import numpy as np
import pytest
from pyspark.sql import functions as F

import patrolcast.models.base as base
from patrolcast.operators.profile import describe, exact_quantiles
from patrolcast.operators.selection import (P31, key_hash, key_hash_np, key_hash_sql, repeated_folds, stratified_folds,
                                            train_test_split, with_key_hashes)


def _folds_by_sorting(rows, n_splits, seed):
    """(class, Id) rows to folds by ranking each class in the order of (hash, Id)."""
    out, by = {}, {}
    for c, i in rows:
        by.setdefault(c, []).append(i)
    for c, ids in by.items():
        ids = np.array(ids)
        order = ids[np.lexsort((ids, key_hash_np(ids, seed)))]
        out.update({(c, int(i)): r * n_splits // len(ids) for r, i in enumerate(order)})
    return out


@pytest.mark.parametrize("n_splits", [2, 3, 7])
def test_folds_equal_ranking_for_every_bucket_setting(spark, n_splits):
    ids = [*range(3001), *range(P31 - 5, P31 + 5), *range(2 * P31, 2 * P31 + 40)]
    rows = [(None if i % 11 == 0 else str(i * 7 % 5), i) for i in ids] + [("rare", 10**12), ("pair", 5 * 10**12), ("pair", 6 * 10**12)]
    df = spark.createDataFrame(rows, "c string, Id long")
    want = _folds_by_sorting(rows, n_splits, 2019)
    for kw in ({}, {"buckets": 2, "collect_limit": 1}, {"buckets": 16, "collect_limit": 8}):
        got = {(r.c, r.Id): r.fold for r in stratified_folds(df, n_splits, 2019, "c", **kw).collect()}
        assert got == want


def test_folds_balanced_within_class(spark):
    df = spark.range(0, 3001).withColumnRenamed("id", "Id").withColumn("Category", (F.col("Id") % 7).cast("string"))
    by = {}
    for r in stratified_folds(df, 3).groupBy("Category", "fold").count().collect():
        by.setdefault(r.Category, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 and len(v) == 3 for v in by.values())
    plan = stratified_folds(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("kw", [{}, {"buckets": 2, "collect_limit": 1}])
def test_train_test_split_exact_size_and_rows(spark, kw):
    df = spark.range(0, 1234).withColumnRenamed("id", "Id")
    got = {r.Id for r in train_test_split(df, 0.2, **kw).filter("is_holdout").collect()}
    ids = np.arange(1234)
    assert got == set(ids[np.argsort(key_hash_np(ids, 2019))][:247].tolist())
    assert train_test_split(df.limit(0), 0.2).count() == 0


def test_null_keys_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a")], "Id long, Category string")
    with pytest.raises(ValueError, match="NULL Id"):
        stratified_folds(df)


def test_hash_forms_agree_and_permute(spark):
    duckdb = pytest.importorskip("duckdb")
    ids = np.array([0, 1, 2, 77, 10**6, P31 - 1, P31, P31 + 1, 3 * P31 + 9, 2**61], dtype=np.int64)
    df = spark.createDataFrame([(int(i),) for i in ids], "Id long")
    for seed in (0, 7, 2019, 10**7):
        want = key_hash_np(ids, seed).tolist()
        got = {r.Id: r.h for r in df.select("Id", key_hash("Id", seed).alias("h")).collect()}
        assert [got[int(i)] for i in ids] == want
        con = duckdb.connect()
        for form in (seed, f"{seed} + 0"):
            sql = f"SELECT {key_hash_sql('Id', form)} FROM (VALUES {','.join(f'({i}::BIGINT)' for i in ids)}) t(Id)"
            assert [r[0] for r in con.execute(sql).fetchall()] == want
    few = np.arange(200_000)
    assert len(np.unique(key_hash_np(few, 5))) == len(few)


def test_seeds_are_independent():
    ids = np.arange(20_000)
    split = [key_hash_np(ids, 2019 + 7919 * r) < P31 // 2 for r in range(5)]
    for a in range(5):
        for b in range(a):
            assert abs((split[a] == split[b]).mean() - 0.5) < 0.02
    from patrolcast.models.boost import _row_sample
    used = sum(_row_sample(ids, 2019, r, 0.75).astype(int) for r in range(50))
    assert used.min() > 0 and abs(used.mean() / 50 - 0.75) < 0.01
    from patrolcast.models.forest import bootstrap_seed
    votes = sum((key_hash_np(ids, bootstrap_seed(2019, t)) / P31 < np.exp(-1)).astype(int) for t in range(100))
    p = np.exp(-1)
    assert abs(votes.std() / np.sqrt(100 * p * (1 - p)) - 1) < 0.1 and abs(votes.mean() - 100 * p) < 0.5


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.RandomState(1)
    vals = np.concatenate([rng.randn(4000), np.full(500, 0.25), rng.exponential(size=500) * 100])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    for kw in ({}, {"buckets": 4, "collect_limit": 10}):
        q = exact_quantiles(df, ["v"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0], **kw)["v"]
        assert q == pytest.approx(list(np.quantile(vals, [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0])), rel=1e-12)
    d = describe(df).first()
    assert d["std"] == pytest.approx(vals.std(ddof=1))


def test_partial_sums_shuffle_path_equals_direct(spark, monkeypatch):
    df = spark.range(0, 10000, numPartitions=8).select(F.col("id").cast("double").alias("x"))

    def fn(b):
        x = base.arrow_vector(b, "x")
        return np.array([x.sum(), (x * x).sum(), len(x)] * 5000)

    direct = base.partial_sums(df, 15000, fn)
    monkeypatch.setattr(base, "DIRECT_LIMIT", 0)
    shuffled = base.partial_sums(df, 15000, fn, block=4096)
    assert np.allclose(direct, shuffled)
    assert direct[0] == pytest.approx(sum(range(10000)))


@pytest.mark.parametrize("growth", ["depthwise", "symmetric", "leafwise"])
def test_booster_forms_of_exchange_do_not_matter(spark, monkeypatch, growth):
    """Rows as they are, sums, small blocks and flushes give the same trees; a fit goes on from saved tables as if uncut."""
    import patrolcast.models.boost as boost
    rng = np.random.RandomState(3)
    X = rng.randn(600, 4)
    y = (X[:, 0] + 0.5 * X[:, 1] > 0).astype(int) + (X[:, 2] > 1).astype(int)
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(600)]
    df = spark.createDataFrame(rows, "Id long, label int, a double, b double, c double, d double").repartition(3)
    cols = ["a", "b", "c", "d"]
    p = boost.BoostParams(n_rounds=3, max_depth=4, eta=0.3, growth=growth, num_leaves=6, subsample=1.0 if growth == "leafwise" else 0.8, colsample=0.75)
    m1 = boost.fit_boost(df, cols, 3, p)[0]
    for name, value in (("RAW_ROWS", 0), ("RAW_ROWS", 10 ** 6), ("SLOT_CELLS", 1), ("HELD_CELLS", 1)):
        with monkeypatch.context() as mp:
            mp.setattr(boost, "RAW_ROWS", 20)
            mp.setattr(boost, name, value)
            m2 = boost.fit_boost(df, cols, 3, p, binner=m1.binner)[0]
        assert np.allclose(m1.predict_proba(X), m2.predict_proba(X), atol=1e-9)
    path = tempfile.mkdtemp(prefix="patrolcast-test-")
    first = boost.fit_boost(df, cols, 3, boost.BoostParams(**{**p.__dict__, "n_rounds": 1}), binner=m1.binner)[0]
    first.save(spark, path)
    again = boost.BoostModel.load(spark, path)
    assert [[t.arrays()[i].tolist() for t in r for i in range(5)] for r in again.rounds] == \
        [[t.arrays()[i].tolist() for t in r for i in range(5)] for r in first.rounds]
    (on,) = boost.fit_boost(df, cols, 3, p, init=[again])
    assert len(on.rounds) == 3 and np.allclose(on.predict_proba(X), m1.predict_proba(X), atol=1e-9)
    got = {r.Id: r.probability for r in m1.transform(df).collect()}
    assert np.allclose([got[i] for i in range(600)], m1.predict_proba(X))


def test_repair_without_address_broadcast_equals_default(spark, monkeypatch):
    import patrolcast.operators.repair as repair
    from patrolcast.sources.incidents import incidents, train_rows
    from conftest import SF_MID
    tr = train_rows(incidents(spark, SF_MID)).select("Id", "PdDistrict", "Address", "X", "Y")
    a = repair.repair_by_address(tr)
    monkeypatch.setattr(repair, "MAX_BROADCAST_ADDRESSES", 0)
    b = repair.repair_by_address(tr)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_landmarks_equal_global_ordered_limit(spark):
    from patrolcast.models.kernel import _smallest_by_hash
    df = spark.range(0, 20000).withColumnRenamed("id", "Id").withColumn("a", F.col("Id") * 0.5)
    got = [r["Id"] for r in _smallest_by_hash(df, ["a"], "Id", 2019, 300)]
    want = [r["Id"] for r in df.select("Id", key_hash("Id", 2019).alias("_h")).orderBy("_h", "Id").limit(300).collect()]
    assert got == want


def test_fold_hashes_are_computed_once(spark):
    """The plan holds each step of a key's hash a few times, not a copy for every use of a use."""
    df = spark.range(0, 500).withColumnRenamed("id", "Id").withColumn("Category", (F.col("Id") % 3).cast("string"))
    for got, seeds in ((stratified_folds(df, 3), 1), (repeated_folds(df, 2, 5), 5)):
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("2147483647") <= 20 * seeds
    one = df.select(key_hash().alias("h"))._jdf.queryExecution().optimizedPlan().toString()
    assert one.split("\n")[0].count("2147483647") <= 20
    keys = [0, 1, P31 - 1, P31, -1, -P31 - 3, 2**62, 2**63 - 1]
    near = spark.createDataFrame([(k,) for k in keys], "Id long")
    want = [key_hash_np(np.array(keys), s).tolist() for s in (3, 2019)]
    got = with_key_hashes(near, "Id", {"a": 3, "b": 2019}).collect()
    assert [[r.a for r in got], [r.b for r in got]] == want and [r[0] for r in near.select(key_hash("Id", 3)).collect()] == want[0]
