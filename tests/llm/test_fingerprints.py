import hashlib
import random

import numpy as np
import pytest

from cases import SF_SMALL, odd_documents, table_dir  # noqa: F401
from patrolcast.llm import fingerprints as D
from patrolcast.llm.common import ROW, table

LAST = (1 << 63) - 1


def plain_rows(spark, docs):
    """Rows in order with the edited text, by one sorted list."""
    from pyspark.sql import functions as F
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows = sorted(rows, key=lambda r: (LAST if r.doc_id is None else r.doc_id, r.h))
    out = []
    for i, r in enumerate(rows):
        after = rows[(i + 1) % len(rows)].text
        k = len(r.text) // 2
        edited = r.text[:len(r.text) - k] + after[:k]
        a, b, c = (D.sketch(t.encode()) for t in (r.text, edited, after))
        out.append((r.doc_id, len(r.text), hashlib.sha256(edited.encode()).hexdigest(), D.written(a), D.written(b),
                    D.containment(a, b), D.containment(a, c), D.jaccard(a, b), D.jaccard(a, c)))
    return out


def true_shingles(text):
    ws = text.lower().split()
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def test_query_equals_plain_version(spark, odd_documents, table_dir):  # noqa: F811
    df = D.op12_document_fingerprints(spark, SF_SMALL)
    assert df.columns[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, df.collect())) == sorted(plain_rows(spark, table(spark, SF_SMALL, "documents")))
    got = D.op12_document_fingerprints(spark, table_dir(documents=odd_documents)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_rows(spark, odd_documents), key=repr)


@pytest.mark.parametrize("bucket_bytes", [400, 5_000, 60_000])
def test_buckets_do_not_change_the_result(spark, bucket_bytes):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").repartition(5)
    cols = ["n_chars", "fingerprint", "edited_text", "edited_fingerprint", "near_edited", "near_next"]
    read = lambda b: sorted(map(tuple, D.fingerprint(docs, bucket_bytes=b).select(f"{ROW}.doc_id", *cols).collect()))
    assert read(bucket_bytes) == read(1 << 30)


def test_repeated_rows_one_row_and_empty_tables(spark, odd_documents):  # noqa: F811
    one = D.fingerprint(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one.edited_text == "abab" and one.near_next == 1.0
    same = spark.createDataFrame([(7, "one text of several words in it")] * 40 + [(None, "x")] * 40, "doc_id long, text string")
    assert D.fingerprint(same, bucket_bytes=50).count() == 80
    out = D.fingerprint(odd_documents)
    assert out.select(f"{ROW}.*").columns == odd_documents.columns and out.count() == odd_documents.count()
    assert D.fingerprint(odd_documents.limit(0)).count() == 0


def test_sketch_rules():
    assert len(D.sketch(b"")) == len(D.sketch(b" \n")) == 0 and len(D.sketch(b"one")) == 1
    assert D.written(D.sketch(b"A  b\tc")) == D.written(D.sketch(b"a B c "))
    assert (D.containment(D.sketch(b""), D.sketch(b"")), D.containment(D.sketch(b"a"), D.sketch(b""))) == (1.0, 0.0)
    rng = random.Random(1)
    for n in (1, 3, 5, 9, 40, 400, 3000):
        text = " ".join(str(rng.randint(0, 10 ** 6)) for _ in range(n)).encode()
        full, kept = np.unique(D.shingle_hashes(text)), D.sketch(text)
        below = full[full < np.uint64((1 << 64) // D.SCALE)]
        assert (kept == (below if len(below) else full[:1])).all() and (D.read(D.written(kept)) == kept).all()
        if n >= 400:
            assert abs(len(kept) * D.SCALE / len(full) - 1) < 0.4
        assert len(D.sketch(text, scale=1)) == len(full)


def test_merge_is_the_sketch_of_both(spark):
    rng = random.Random(2)
    parts = [" ".join(str(rng.randint(0, 300)) for _ in range(n)) for n in (2, 5, 5, 40, 700, 5)]
    for a in parts:
        for b in parts:
            both = np.unique(np.concatenate([D.shingle_hashes(a.encode()), D.shingle_hashes(b.encode())]))
            assert (D.merge(D.sketch(a.encode()), D.sketch(b.encode())) == D._retained(both, D.SCALE)).all()
    df = spark.createDataFrame([(i % 2, D.written(D.sketch(t.encode()))) for i, t in enumerate([*parts, ""])], "g int, f string")
    rows = D.merged(df, "g", "f").collect()
    for g in (0, 1):
        want = np.zeros(0, np.uint64)
        for t in [*parts, ""][g::2]:
            want = D.merge(want, D.sketch(t.encode()))
        assert sorted(r.hash for r in rows if r.g == g) == [f"{x:016x}" for x in want]


def test_estimates_are_near_the_truth_for_unequal_texts():
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 10 ** 9)}"
    for small, large, share in ((2000, 60_000, 0.5), (2000, 60_000, 0.9), (20_000, 2000, 0.05), (3000, 3000, 0.0)):
        a = [word() for _ in range(small)]
        b = a[:int(small * share)] + [word() for _ in range(large)]
        ta, tb = " ".join(a), " ".join(b)
        true = len(true_shingles(ta) & true_shingles(tb)) / len(true_shingles(ta))
        assert abs(D.containment(D.sketch(ta.encode()), D.sketch(tb.encode())) - true) < 0.1


def test_edited_halves_of_the_given_documents(spark):
    got = D.op12_document_fingerprints(spark, SF_SMALL).where("n_chars > 1000").toPandas()
    assert 0.4 < got.near_edited.mean() < 0.7 and (got.near_edited >= got.near_next).mean() > 0.9
