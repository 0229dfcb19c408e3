import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cases import SF_SMALL, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import periodic_runs as P
from patrolcast.llm.common import ROW, table


def plain_runs(said, min_length=24, power=3):
    """Every period by direct comparison; a stretch counts for its smallest period only."""
    n, out = len(said), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and said[j] == said[j + q]:
                j += 1
            if (j - i) + q >= max(min_length, power * q) and (i, j + q) not in out:  # smaller periods came first
                out[i, j + q] = q
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    said = (text or "").encode().split()
    n = len(said)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            said = [said[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(said)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(said) if i not in gone)).hexdigest())


def _found(said):
    return P.runs_of(P.word_ids(said))


def test_runs_equal_direct_comparison():
    rng = random.Random(13)
    for trial in range(400):
        said = []
        while len(said) < rng.choice([10, 60, 200]):
            block = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 12))]
            said += block * rng.choice([1, 1, 2, 3, 4, 9]) + block[:rng.randint(0, len(block))]
        assert _found(said) == plain_runs(said), said


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    for q in (7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 100, 333):
        block = [str(rng.randint(0, 4)) for _ in range(q)]
        for size in (3 * q - 1, 3 * q, 3 * q + 1, 5 * q + 2):
            said = ["x", *(block * 6)[:size], "y", *(block * 6)[:size]]
            assert _found(said) == plain_runs(said)
    inner = ["a", "b"] * 15 + ["c"]
    assert _found(inner * 4) == plain_runs(inner * 4)
    assert {q for _, _, q in _found(inner * 4)} == {2, 31}
    assert _found(["w"] * 23) == [] and _found(["w"] * 24) == [(0, 24, 1)]
    assert P.runs_of(P.word_ids(["a", "b"] * 3), min_length=5) == [(0, 6, 2)]
    with pytest.raises(ValueError):
        P.runs_of(np.arange(5), min_power=2)


def test_long_text_of_one_word_is_no_dearer():
    assert _found(["w"] * 300_000) == [(0, 300_000, 1)]
    line = "a line that stands in the text a hundred thousand times over with only a number between".split()
    said = [w for k in range(20_000) for w in [*line, str(k)]]
    assert _found(said) == []


def test_query_equals_plain_version(spark, odd_documents, table_dir):  # noqa: F811
    got = sorted((tuple(r) for r in P.op13_periodic_runs(spark, SF_SMALL).collect()))
    want = sorted(plain_row(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect())
    assert got == want and sum(r[1] > 0 for r in want) > 5
    assert all(v is not None for r in got for v in r[-2:])
    loop = spark.createDataFrame([(i, "p q r s " * 20 + "end") for i in range(30)] + [(None, "a " * 40)], "doc_id long, text string")
    docs = odd_documents.unionByName(loop, allowMissingColumns=True)
    df = P.op13_periodic_runs(spark, table_dir(documents=docs))
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in df.dtypes if not c.endswith(("id", "256"))} == {"bigint"}
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((plain_row(r.doc_id, r.text) for r in docs.collect()), key=repr)


def test_operator_keeps_rows_and_takes_empty_tables(spark, odd_documents):  # noqa: F811
    out = P.detect(odd_documents)
    assert out.select(f"{ROW}.*").columns == odd_documents.columns and out.count() == odd_documents.count()
    assert P.detect(odd_documents.limit(0)).count() == 0
    one = P.detect(spark.createDataFrame([(1, "u v w " * 12 + "x")], "doc_id long, text string")).first()
    assert [tuple(r) for r in one.runs] == [(0, 36, 3)] and one.collapsed_text == "u v w x"
