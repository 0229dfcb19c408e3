import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cases import SF_SMALL, documents, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import suffix_dedup as S
from patrolcast.llm.common import ROW, table

LENGTH = S.LENGTH


def removed(texts):
    """Masks of removed bytes by counting every string."""
    seen = {}
    for t in texts:
        for a in range(len(t) - LENGTH + 1):
            w = hash(t[a:a + LENGTH])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        m = np.zeros(len(t), dtype=bool)
        for a in range(len(t) - LENGTH + 1):
            if seen[hash(t[a:a + LENGTH])] > 1:
                m[a:a + LENGTH] = True
        out.append(m)
    return out


def expected(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    out = []
    for (i, t), m in zip(raw, removed([t for _, t in raw])):
        spans = int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())
        out.append((i, len(t), int(m.sum()), spans, brute.sha(bytes(np.frombuffer(t, dtype=np.uint8)[~m]))))
    return sorted(out, key=repr)


def digest(df):
    got = S.cut(df).select(F.col(ROW)["doc_id"], "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))
    passage, other, base = prose(140), prose(100), prose(900)
    out = []
    for i in range(60):
        t = prose(rng.randint(0, 400))
        if i % 3 == 0:
            t += passage + prose(50)
        if i % 4 == 0:
            t = other[rng.randint(0, 60):] + t
        if i % 7 == 0:
            t += t
        if i % 10 == 0:
            w = base.split()
            for _ in range(6):
                w[rng.randrange(len(w))] = f"zz{i}"
            t = " ".join(w)
        out.append((i, t))
    return out + [(100, None), (101, ""), (102, "a" * 1000), (103, "a" * 399), (104, "a" * 400), (105, out[3][1]),
                  (106, "ab" * 900), (107, out[10][1]), (107, out[10][1]), (None, "x" + "a" * 600)]


def test_matches_brute_force(spark, rows):
    assert digest(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


@pytest.mark.parametrize("group", [1, 5, 10_000])
def test_groups_over_many_buckets(spark, rows, monkeypatch, group):
    """Groups of one gram cross bucket boundaries."""
    monkeypatch.setattr(S, "GROUP", group)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == expected(rows)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_records_of_pieces_cover_each_start_once():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (399, 400, 401, 3000, 0, 5000)] + [None]
    for shard in (100, 1000, 1 << 19):
        seen = {}
        for data, row, start, end, base in S.pieces(texts, LENGTH, shard):
            text, lo, n, off, g, c = S.records(data, start, end)
            for t, a, k in zip(text.tolist(), lo.tolist(), n.tolist()):
                for s in range(a, a + k):
                    at = (int(row[t]), s - int(start[t]) + int(base[t]))
                    assert data[s:s + LENGTH].tobytes() == texts[at[0]][at[1]:at[1] + LENGTH]
                    seen[at] = seen.get(at, 0) + 1
        assert seen == {(i, s): 1 for i, t in enumerate(texts) for s in range(len(t or b"") - LENGTH + 1)}


def test_multikey_sort():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 3, (500, 6)).astype(np.uint64) << np.uint64(62)
    order, same = S.multikey_sort(words)
    got = [tuple(x) for x in words[order].tolist()]
    assert got == sorted(got) and same.tolist() == [False, *[a == b for a, b in zip(got, got[1:])]]


def test_given_and_odd_rows(spark, odd_documents, table_dir):  # noqa: F811
    given = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = S.op10_suffix_array_dedup(spark, SF_SMALL).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == expected(given)
    assert all(r.has_repeats == (r.n_removed > 0) == (r.n_spans > 0) for r in got) and any(r.has_repeats for r in got)
    text = dict(given)
    assert all(r.kept_text == text[r.doc_id] for r in got if not r.has_repeats)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    d = table_dir(documents=odd_documents)
    assert sorted((tuple(r)[:5] for r in S.op10_suffix_array_dedup(spark, d).collect()), key=repr) == expected(rows)
    assert S.cut(documents(spark, [(1, "short")]).limit(0)).count() == 0


def test_recall_of_passages_by_length(spark):
    """A passage of 400 bytes or more is cut from both texts whole, a shorter one (of over 50 words, too) stays: the
    string length decides, not the number of words."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    own = lambda: " ".join(word(6) for _ in range(80))
    rows, passages = [], {}
    for k, size in enumerate((300, 399, 400, 401, 500, 2000)):
        said = ""
        while len(said) < size:
            said += word(4) + " "
        passages[k] = said = said[:size - 1] + "."
        assert len(said.split()) > 50
        rows += [(10 * k, own() + "A" + said + "B" + own()), (10 * k + 1, own() + "C" + said + "D")]  # the neighbours differ
    got = {r[0]: r.n_removed for r in S.cut(documents(spark, rows)).select(F.col(ROW)["doc_id"], "n_removed").collect()}
    for k, said in passages.items():
        assert got[10 * k] == got[10 * k + 1] == (len(said) if len(said) >= S.LENGTH else 0)
