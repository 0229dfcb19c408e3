import math
import random

import numpy as np
from pyspark.sql import functions as F

from cases import SF_MID, table_dir  # noqa: F401
from patrolcast.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k_pos=5, k_neg=3):
    """All pairs by Python integers, as the query's contract lays down."""
    part = {}
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i % 7 == 0 else y
        part[i, y, tuple(math.floor(256 * x) for x in v)] = None
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, y, v in part:
        if i % 50:
            continue
        pos = sorted((-dot(v, w), j) for j, z, w in part if z == y and j != i)[:k_pos]
        neg = sorted((-dot(v, w), j) for j, z, w in part if z != y)
        for p, j in pos:
            fit = [(-s, k) for s, k in neg if 50 * -p <= 100 * -s <= 95 * -p][:k_neg]
            out += [(i, j, r + 1, k, -p, s) for r, (s, k) in enumerate(fit)]
    return sorted(out)


def _run(spark, put, rows):
    df = H.op11_hard_negatives(spark, put(embeddings=spark.createDataFrame(rows, SCHEMA)))
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def _rows(rng, n, d, labels=4, levels=None):
    unit = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    return [(i, [float(np.float32((c + rng.gauss(0, 1)) / 8 if levels is None else rng.randint(-levels, levels) / 16)) for c in unit[y]], y)
            for i in range(n) for y in [rng.randrange(labels)]]


def test_given_vectors(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    assert sorted(map(tuple, H.op11_hard_negatives(spark, SF_MID).collect())) == plain(rows)


def test_ties_copies_nulls_and_odd_vectors(spark, table_dir):  # noqa: F811
    rng = random.Random(11)
    rows = _rows(rng, 260, 3, levels=2)  # few different vectors: ties and copies everywhere
    rows += [(1000 + i, [0.25, 0.5, -0.125], i % 3) for i in range(120)]  # one vector in a third of all rows
    rows += [(300, None, 1), (350, [1.0, None, 0.0], 1), (400, [math.nan, 1.0, 0.0], 1), (450, [math.inf, 0.0, 0.0], 1), (None, [1.0, 1.0, 1.0], 1),
             (500, [0.5, 0.5, 0.5], None), (-50, [0.5, 0.25, 0.1], 2), (550, [], 1), (600, [0.5], 2), (650, [0.5, 0.5, 0.5, 0.5], 2), (700, [0.0, 0.0, 0.0], 3)]
    rows += [rows[5], rows[50], rows[50]]
    got = _run(spark, table_dir, rows)
    assert got == plain(rows) and len(got) > 50


def test_empty_tables_single_rows_and_large_components(spark, table_dir, tmp_path):  # noqa: F811
    assert _run(spark, table_dir, []) == []
    one = spark.createDataFrame([(0, 1, [5, 5])], "id long, label long, v array<long>")
    assert H.mine(one, one).count() == 0
    big = [(50 * i, i % 2, [(1 << 27) + 3 * i, 7 - i, -(1 << 26) * (i % 3)]) for i in range(12)]
    df = spark.createDataFrame(big, "id long, label long, v array<long>")
    got = sorted(tuple(r)[:6] for r in H.mine(df, df).collect())
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, j, _, k, p, s in got:
        v = {r[0]: r[2] for r in big}
        assert (p, s) == (dot(v[i], v[j]), dot(v[i], v[k])) and 50 * p <= 100 * s <= 95 * p
    far = spark.createDataFrame([(1, [1e30, 0.0], 1), (2, [1.0, 0.0], 1)], SCHEMA)
    assert H.quantised(far, F.col("vec_id"), F.col("label"), F.col("embedding")).collect()[0].id == 2


def test_shards_and_blocks_do_not_change_the_result(spark):
    rng = random.Random(4)
    given = spark.createDataFrame(_rows(rng, 400, 6), SCHEMA)
    rows = H.quantised(given, F.col("vec_id"), F.col("label"), F.col("embedding"))
    anchors = rows.where("id % 20 = 0")
    whole = sorted(map(tuple, H.mine(rows, anchors).collect()))
    assert whole and whole == sorted(map(tuple, H.mine(rows, anchors, cells=300, block=60).collect()))


def test_sharing_an_id_or_a_key(spark):
    rows = [(50, 1, [3, 1]), (50, 2, [3, 2]), (1, 1, [4, 0]), (4, 1, [2, 1]), (2, 2, [2, 0]), (3, 2, [3, 0]), (50, 1, [3, 1])]
    df = spark.createDataFrame(rows, "id long, label long, v array<long>")
    got = H.mine(df, df.where("id = 50")).collect()
    pairs = sorted((r.positive_id, r.positive_score, r.negative_id, r.negative_score) for r in got)
    assert pairs == [(1, 12, 2, 6), (1, 12, 3, 9), (1, 12, 50, 11), (3, 9, 4, 8), (4, 7, 2, 6)]
    assert len({r.anchor_key for r in got}) == 2


def test_stops_early_and_never_too_early():
    rng = np.random.default_rng(7)
    x = np.floor(256 * rng.normal(size=(20_000, 8)) * 0.5 ** np.arange(8)).astype(np.int64)
    shard = H.Shard(np.arange(len(x)), rng.integers(0, 5, len(x)), x, 6)
    met = []
    inner = H.Lists.access

    def counted(self, a):
        for new, s, bound in inner(self, a):
            met.append(len(new))
            yield new, s, bound

    H.Lists.access = counted
    try:
        for i in range(0, 2000, 50):
            got = shard.negatives(x[i], 9, [(-10 ** 9, 10 ** 9)], 3)[0]
            s = x @ x[i]
            assert got == [(int(j), int(s[j])) for j in np.lexsort((np.arange(len(x)), -s))[:3]]
    finally:
        H.Lists.access = inner
    assert sum(met) < 0.5 * 40 * len(x)
