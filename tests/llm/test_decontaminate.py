import random

import pytest

import brute
from cases import odd_documents, table_dir  # noqa: F401
from patrolcast.llm import decontaminate as D
from patrolcast.llm.common import ROW, alnum_words


def _found(df):
    out = []
    for r in df.collect():
        spans = [(s["first"], s["last"]) for s in r.spans]
        out.append((r[ROW].doc_id, r.n_words, spans, r["items"]))
    return sorted(out, key=repr)


def _runs(places):
    out = []
    for p in sorted(places):
        if out and out[-1][1] == p - 1:
            out[-1] = (out[-1][0], p)
        else:
            out.append((p, p))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    word = lambda: rng.choice(["a", "b", "Cc", "dé", "ee", "9"])
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 9, 10, 11, 25])))) for i in range(40)]
    items += [(7, "repeated id of another item here"), (50, None), (51, "--"), (None, "no id but a b Cc dé hit")]
    docs = []
    for i in range(80):
        t = " ".join(word() for _ in range(rng.randint(0, 60)))
        if i % 3 == 0:
            t += "; " + rng.choice(items[:40])[1].upper().replace("É", "é") + "! " + rng.choice(items[:40])[1]
        docs.append((i, t))
    return docs + [(90, None), (91, ""), (92, "..."), (7, "NO ID, BUT A-B-cc dé hit")], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 600])
def test_matches_brute_force_in_one_or_many_blocks(spark, texts, block_bytes):
    docs, items = texts
    got = D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    want = []
    for i, t in docs:
        places, ids = brute.hits(t, [(x, s) for x, s in items if s])
        want.append((i, len(brute.alnum(t)), _runs(places), sorted(str(x) for x in ids if x is not None)))
    assert _found(got) == sorted(want, key=repr)
    assert any(w[2] for w in want)


def test_proximity():
    p = D.Phrases([("x", b"one two three four five six")], 10)
    docs = [b"one two three four five six", b"one two and three four five six", b"one two and so three and four five six seven",
            b"two one three four five six", b"one two three"]
    tokens = [[p.vocab.get(w, 0) for w in alnum_words(d)] for d in docs]
    runs, items, near = D.search(tokens, p, slop=1)
    assert [bool(r) for r in runs] == [True, False, False, False, False]
    assert items[0] == {"x"} and [n - i for n, i in zip(near, items)] == [set(), {"x"}, set(), {"x"}, set()]


def test_odd_rows_and_stage(spark, odd_documents, table_dir):  # noqa: F811
    bench = spark.createDataFrame([(1, "jumps over the lazy dog and runs away from it all day long")], "item_id long, text string")
    d = table_dir(documents=odd_documents, benchmark=bench)
    got = D.op5_benchmark_decontamination(spark, d).collect()
    assert len(got) == odd_documents.count()
    assert sorted((r.doc_id for r in got if r.contaminated), key=repr) == sorted([1, 1, 2, None, 7], key=repr)
    assert {r.items_sha256 for r in got if not r.contaminated} == {brute.sha(b"")}
    kept = D.stage(spark, odd_documents, d)
    assert kept.columns == odd_documents.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6, 8]
    none = bench.limit(0)
    assert D.decontaminate(odd_documents, none).where("size(spans) > 0").count() == 0
    assert D.decontaminate(odd_documents.limit(0), bench).count() == 0
