import random

import numpy as np
import pytest

import brute
from cases import SF_SMALL, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import simhash as S
from patrolcast.llm.common import table


def test_fingerprint():
    rng = random.Random(2)
    texts = ["", " \t", "One", "one TWO", "one two three", "Ärger ÄRGER ärger b", *(" ".join(rng.choice(["a", "B", "cc", "ü"]) for _ in range(n)) for n in (4, 40, 20_000))]
    for t in texts:
        assert S.fingerprint(t.encode()) == brute.fingerprint(t)
    assert S.fingerprint(None) == 0


@pytest.fixture(scope="module")
def clusters():
    rng = np.random.default_rng(1)
    fps = [0]
    for c in range(6):
        cur = [int(rng.integers(0, 1 << 63))]
        for _ in range(80):
            x = cur[rng.integers(len(cur))]
            for b in rng.choice(64 if c % 2 else 12, rng.integers(1, 5), replace=False):
                x ^= 1 << int(b)
            cur.append(x)
        fps += cur
    return sorted(set(fps) | {int(x) for x in rng.integers(0, 1 << 63, 100)})


@pytest.mark.parametrize("limit", [8192, 40, 3])
def test_components_whatever_the_bucket_limit(spark, clusters, limit):
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    f = spark.createDataFrame([(sign(x),) for x in clusters], "fp long")
    got = {r.node: r.root for r in S.link_components(f, limit=limit).collect()}
    want = brute.components(clusters)
    assert all(got.get(sign(x), sign(x)) == min(map(sign, want[x])) for x in clusters)


def test_query_and_stage(spark, odd_documents, table_dir):
    d = table_dir(documents=odd_documents)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    group = brute.components([brute.fingerprint(t) for _, t in rows])
    low = {}
    for i, t in rows:
        if i is not None:
            g = group[brute.fingerprint(t)]
            low[g] = min(low.get(g, i), i)
    want = sorted(((i, f"{brute.fingerprint(t):016x}", low.get(group[brute.fingerprint(t)])) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in S.op1_simhash_near_dedup(spark, d).collect()), key=repr) == want
    kept = S.stage(spark, odd_documents, d)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(low.values())
    assert S.stage(spark, odd_documents.limit(0), d).count() == 0


def test_given_documents(spark):
    rows = [(r.doc_id, brute.fingerprint(r.text)) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    group = brute.components([f for _, f in rows])
    low = {}
    for i, f in rows:
        low[group[f]] = min(low.get(group[f], i), i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.op1_simhash_near_dedup(spark, SF_SMALL).collect()}
    assert got == {i: (f"{f:016x}", low[group[f]]) for i, f in rows}
