import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import LOWER
from cases import SF_SMALL, documents, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import lm_score as K
from patrolcast.llm.common import materialise, table


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def tokens(text):
    return (text or "").encode().translate(LOWER).split() + [None]


def train(rows):
    uni, big, ctx = Counter(), Counter(), Counter()
    for i, t in rows:
        if not held(i):
            prev = "start"
            for w in tokens(t):
                uni[w] += 1
                big[prev, w] += 1
                ctx[prev] += 1
                prev = w
    n, v = sum(uni.values()), len(uni)
    p = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    by = Counter(big.values())
    d = K.discounts([by[r] for r in range(1, K.K + 2)])
    seen, mass, low = {}, defaultdict(float), defaultdict(float)
    for (u, w), c in big.items():
        if c >= K.MIN_COUNT:
            seen[u, w] = (d[c] if c <= K.K else 1) * c / (ctx[u] + K.PSEUDO)
            mass[u] += seen[u, w]
            low[u] += p(w)
    q = lambda u, w: seen[u, w] if (u, w) in seen else (1 - mass[u]) / (1 - low[u]) * p(w)
    return uni, n, p, q


def expected(rows):
    uni, n, p, q = train(rows)
    out = []
    for i, t in rows:
        prev, base, score, ts = "start", 0.0, 0.0, tokens(t)
        for w in ts:
            base, score, prev = base + math.log10(p(w)), score + math.log10(q(prev, w)), w
        out.append((i, held(i), len(ts), sum(uni[w] > 0 for w in ts), n, base, score))
    return sorted(out, key=repr)


def check(got, rows):
    got, want = sorted((tuple(r) for r in got.collect()), key=repr), expected(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


def run(spark, rows, parts=3):
    df = documents(spark, rows).repartition(parts)
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    return K.katz(materialise(df.select("doc_id", "text", h.alias("held"))))


@pytest.mark.parametrize("hot", [1 << 16, 40, 1])
def test_given_documents(spark, monkeypatch, hot):
    """With and without broadcast words; the other keys go through the parts."""
    monkeypatch.setattr(K, "HOT", hot)
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = K.op8_katz_lm_scoring(spark, SF_SMALL)
    check(got, rows)
    base, score = got.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base  # the pairs help on texts that were not learnt


def test_a_word_that_fills_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(K, "HOT", 8)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["the"] * 6 + ["Is", "on", "he."] * 2 + [f"w{rng.randint(0, 40)}"]) for _ in range(rng.randint(0, 80)))) for i in range(80)]
    check(run(spark, rows), rows)


def test_probabilities_sum_to_one():
    rows = [(i, t) for i, t in enumerate(["a b a b c", "a b", "b c a b", "", "a a a b"] * 3)]
    uni, n, p, q = train(rows)
    for u in [*uni, "start", "never"]:
        assert math.isclose(sum(q(u, w) for w in uni) + q(u, "unknown"), 1.0)


def test_odd_rows(spark, odd_documents, table_dir):  # noqa: F811
    d = table_dir(documents=odd_documents)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check(K.op8_katz_lm_scoring(spark, d), rows)
    assert run(spark, [(1, "x")]).count() == 1
    only = [i for i in range(50) if held(i)][:3]  # nothing to learn from
    check(run(spark, [(i, "a b") for i in only]), [(i, "a b") for i in only])
    empty = spark.createDataFrame([], "doc_id long, text string, held boolean")
    assert K.katz(empty).count() == 0


def test_words_of_one_buffer(monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 7)
    h, at = K.word_hashes(b"Aa bb\x0bAA  aa\n" + b"z" * 40 + b" bb")
    assert at.tolist() == [0, 3, 6, 10, 13, 54] and h[0] == h[2] == h[3] and h[1] == h[5] and len(set(h.tolist())) == 3
    assert len(K.word_hashes(b" \n")[0]) == 0
    x = [np.array([3, 5, 1 << 55], dtype=np.uint64), np.array([0.5, -2.0]), np.array([7])]
    assert all((a == b).all() for a, b in zip(K.unpack(K.pack(("sorted", x[0]), x[1], x[2])), x))


def test_pairs_seen_once_are_in_the_model(spark):
    i = next(i for i in range(50) if not held(i))
    (r,) = run(spark, [(i, "a b")]).collect()  # every pair seen once, no discount, each context seen once
    assert math.isclose(r.score, 3 * math.log10(1 / (1 + K.PSEUDO)))


def test_parts_follow_the_text(spark, monkeypatch):
    monkeypatch.setattr(K, "PART_BYTES", 100)
    rows = [(i, f"a b w{i} x{i % 7} a") for i in range(200)]
    made, before = [], K.Model.__init__
    monkeypatch.setattr(K.Model, "__init__", lambda self, docs, path, parts: (made.append(parts), before(self, docs, path, parts))[1])
    check(run(spark, rows), rows)
    assert made == [-(-sum(len(t) + 1 for _, t in rows) // 100)] and made[0] > 2 * 8  # not the session's setting


def test_rounds_leave_no_shuffles(spark, monkeypatch):
    """Equal scores for any number of rounds; within the query no shuffle file outlives its step."""
    rows = [(i, f"a{i % 7} b{i % 3} c{i} a{i % 5} b") for i in range(60)] + [(None, "a1 b2"), (3, None)]
    files, plain = [], K.materialise
    where = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    monkeypatch.setattr(K, "materialise", lambda df: (files.append(where.getAllFiles().size()), plain(df))[1])
    for n in (1, 4):
        monkeypatch.setattr(K, "ROUNDS", n)
        check(run(spark, rows), rows)
        assert len(files) == 2 + n and max(files) <= files[0]  # before, the counts' and the model's stayed
        files.clear()
