import math

import pytest
from pyspark.sql import functions as F

from cases import SF_SMALL, documents, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import mixing as M
from patrolcast.llm.common import ROW


def _targets(sizes, weights=(1, 2, 3), most=3):
    """Water filling, one source at a time."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {**full, **share}
        full.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 1, "d": 500, None: 3}, {"a": 1, "b": 1, "c": 1000}, {"x": 7},
                                   {None: 5, "a": 0}, {"a": 0}, {"s10": 50, "s2": 900, "s1": 40, "Z": 7, "é": 11}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    want = _targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


@pytest.mark.parametrize("weight", [1, 2, 3])
def test_inverse_of_the_integrated_schedule(spark, weight):
    knots = M.SCHEDULES[weight]
    sql = M.demand_inverse_sql("u", str(weight))
    rows = spark.range(101).select((F.col("id") / 100).alias("u")).selectExpr("u", f"{sql} AS t").collect()
    whole = sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:]))
    for r in rows:
        area = 0.0
        for (t0, a), (t1, b) in zip(knots, knots[1:]):
            x = min(max(r.t - t0, 0), t1 - t0)
            area += a * x + (b - a) / (t1 - t0) * x * x / 2
        assert math.isclose(area / whole, r.u, abs_tol=1e-9)


def test_near_targets_for_any_number_of_ranges(spark, monkeypatch):
    a = sorted(tuple(r) for r in M.op9_mixing(spark, SF_SMALL).collect())
    monkeypatch.setattr(M, "ROWS_PER_RANGE", 3)
    b = M.op9_mixing(spark, SF_SMALL)
    assert sorted(tuple(r) for r in b.collect()) == a
    per = b.groupBy("source_size", "target").agg(F.sum("taken").alias("t"), F.max("size").alias("m"))
    assert per.where("abs(t - target) > m").count() == 0
    assert b.where("taken > 3 * size").count() == 0


def test_curriculum_is_in_order(spark, odd_documents, table_dir):  # noqa: F811
    rows = M.curriculum(odd_documents).collect()
    at = [r.position for r in rows]
    assert at == sorted(at) and all(0 <= t <= 1 for t in at)
    assert {r[ROW].doc_id for r in rows} <= {1, 2, None, 6, 7, 8}
    out = M.stage(spark, odd_documents, None)
    assert out.columns == [*odd_documents.columns, "mix_copy", "_mix_position"]
    assert M.stage(spark, odd_documents.limit(0), None).count() == 0
    got = M.op9_mixing(spark, table_dir(documents=odd_documents)).collect()
    assert len(got) == odd_documents.count() and all(r.taken == 0 and r.position is None for r in got if r["size"] == 0)


def test_no_words_at_all(spark):
    assert [r.target for r in M.mix(documents(spark, [(1, None, None, "a"), (2, " ", None, None)])).collect()] == [0.0, 0.0]


def test_rows_without_an_id_follow_each_other(spark):
    """Null ids share one hash: the copies of one source still add up to its target."""
    df = spark.createDataFrame([(None, "w " * (i % 7 + 1), "a") for i in range(60)] + [(i, "x y z", "b") for i in range(60)],
                               "doc_id long, text string, source string")
    got = M.mix(df).select("source", "size", "target", (F.size("positions") * F.col("size")).alias("taken")).collect()
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) + 1
    sized = df.select("doc_id", "source", M.word_count(F.col("text")).alias("n"))
    assert sorted((r.source, r.size, r.taken) for r in got) == sorted(
        (r.source, r.size, r.taken) for r in M.mix(sized, size="n").select("source", "size", (F.size("positions") * F.col("size")).alias("taken")).collect())


def test_query_rows_come_in_training_order(spark, tmp_path):
    """The query takes the method's last step too: the mix is range-sorted by position."""
    from patrolcast.llm.mixing import op9_mixing

    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)) if i % 9 else None, f"s{i % 4}") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op9_mixing(spark, str(tmp_path))
    assert "rangepartitioning" in got._jdf.queryExecution().executedPlan().toString()
    at = [r.position for r in got.collect()]
    taken = [p for p in at if p is not None]
    assert len(at) == 400 and taken == sorted(taken) and at[:len(taken)] == taken
