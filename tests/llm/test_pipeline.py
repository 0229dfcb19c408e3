import hashlib
import math

import brute
import corpus_pipeline
from cases import SF_SMALL, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import line_dedup, mixing
from patrolcast.llm.common import table
from test_mixing import _targets


def _time(u, knots):
    """The time at which the integrated schedule reaches share u, by bisection."""
    whole = sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:]))
    lo, hi = 0.0, 1.0
    for _ in range(60):
        t, area = (lo + hi) / 2, 0.0
        for (t0, a), (t1, b) in zip(knots, knots[1:]):
            x = min(max(t - t0, 0), t1 - t0)
            area += a * x + (b - a) / (t1 - t0) * x * x / 2
        lo, hi = (t, hi) if area < u * whole else (lo, t)
    return lo


def plain_pipeline(rows, items):
    """(doc_id, text, source) to sorted (doc_id, text, copy, position)."""
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    done = brute.line_dedup([r[:2] for r in rows], line_dedup.MIN_DOCS, exact_docs=line_dedup.EXACT_DOCS)
    rows = [(i, t, s) for (i, old, s), (_, t) in zip(rows, done) if t == old or t.split()]
    group = brute.components([brute.fingerprint(t) for _, t, _ in rows])
    first = {}
    for i, t, _ in rows:
        g = group[brute.fingerprint(t)]
        first[g] = min(first.get(g, i), i)
    rows = [(i, t, s) for i, t, s in rows if first[group[brute.fingerprint(t)]] == i]
    rows = [(i, t, s) for i, t, s in rows if not brute.hits(t, items)[0]]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    target = _targets(sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))}
    out = []
    for s in sizes:
        order = sorted((int(hashlib.md5(f"{mixing.SEED}|{i}".encode()).hexdigest()[:8], 16), i, len(t.split()), t) for i, t, x in rows if x == s)
        before = 0
        for _, i, n, t in order:
            mids = [k * sizes[s] + before + n / 2 for k in range(3)]
            for copy, m in enumerate(m for m in mids if n and m <= target[s]):
                out.append((i, t, copy, _time(m / target[s], mixing.SCHEDULES[weight[s]])))
            before += n
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_run_equals_plain_version(spark):
    rows = [(r.doc_id, r.text, r.source) for r in table(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_copy", "mix_position"]
    got = sorted(((r.doc_id, r.text, r.mix_copy, r.mix_position) for r in got.collect()), key=lambda r: (r[0], r[2]))
    want = plain_pipeline(rows, items)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(math.isclose(g[3], w[3], abs_tol=1e-9) for g, w in zip(got, want))


def test_stages_take_odd_and_empty_tables(spark, odd_documents, table_dir):  # noqa: F811
    bench = spark.createDataFrame([(1, "nothing of this is in any text at all, not even one window")], "item_id long, text string")
    d = table_dir(documents=odd_documents, benchmark=bench)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "mixing"]
    docs = odd_documents
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, d)
        assert out.columns[:len(docs.columns)] == docs.columns
        assert function(spark, docs.limit(0), d).count() == 0
        docs = out
    assert {r.doc_id for r in docs.collect()} <= {1, 2, 7, 8}


def test_registered(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert {q.split("_")[0] for q in entry.oracle_sql() if q.startswith("op")} >= {"op4", "op5", "op9"}


def test_a_stage_lets_go_of_what_it_cached(spark):
    held = lambda: set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    before = held()
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    assert held() <= before
