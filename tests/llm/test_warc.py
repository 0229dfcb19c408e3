import base64
import gzip
import glob
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cases import SF_SMALL
from patrolcast.llm import warc as W
from patrolcast.llm.common import table

PAGES = "page_id long, url string, html string, url_key string, run string"


@pytest.fixture
def pages(spark):
    rows = [(5, "http://www.A.example.com:80/p?x=1#frag", "<p>one</p>"), (2, "https://a.example.com", "<p>one</p>"),
            (9, "https://a.example.com/", "<p>one</p>"), (3, None, ""), (4, "no scheme", None), (6, "http://b.org/\r\nX: y", "a\r\n\r\nb\r\n\r\n"),
            (7, "http://b.org/ü", "größe"), (2, "https://a.example.com", "<p>one</p>"), (None, "http://b.org/n", "<p>one</p>"),
            (8, "http://b.org/2", "x" * 100_000), (10, "http://b.org/2", "WARC/1.1\r\nContent-Length: 5\r\n\r\n")]
    return spark.createDataFrame([(*r, "k", "r") for r in rows], PAGES)


def _want(rows, least=0):
    out = []
    for r in rows:
        raw = (r.html or "").encode()
        ids = [x.page_id for x in rows if (x.html or "") == (r.html or "") and x.page_id is not None]
        again = len(raw) >= least and ids and r.page_id != min(ids)
        out.append((r.page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("least", [0, 50])
def test_round_trip(spark, pages, tmp_path, least):
    path = str(tmp_path / "archives")
    W.write_archives(pages.repartition(3), path, min_bytes=least, records_per_file=2)
    assert _got(W.capture_index(spark, path)) == _want(pages.collect(), least)


def test_payloads_survive(spark, pages, tmp_path):
    path = str(tmp_path / "archives")
    W.write_archives(pages.coalesce(1), path, min_bytes=1 << 30)
    blocks = [b.split(b"\r\n\r\n", 1)[1] for f in glob.glob(f"{path}/*.gz") for _, _, b in W.parse(gzip.open(f).read())]
    assert sorted(blocks) == sorted((r.html or "").encode() for r in pages.collect())


def test_history_is_in_order(spark, pages, tmp_path):
    path = str(tmp_path / "archives")
    W.write_archives(pages.repartition(4), path)
    rows = W.capture_index(spark, path).collect()
    key = [(r.url_key, r.captured_at, 1 << 63 if r.page_id is None else r.page_id) for r in rows]
    assert key == sorted(key) and key[0][0] == ""
    assert W.url_key("http://www.A.example.com:80/p?x=1#frag") == "com:80,example,a)/p?x=1"
    assert W.url_key("https://a.example.com?q") == "com,example,a)/?q" and W.url_key("no scheme") == "no scheme"


def test_loser_tree():
    rng = random.Random(3)
    for k in range(1, 12):
        runs = [sorted((rng.randint(0, 20), i) for _ in range(rng.randint(0, 9))) for i in range(k)]
        assert list(W.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)
    assert list(W.LoserTree([], lambda x: x)) == []


def test_given_and_empty(spark, tmp_path):
    given = table(spark, SF_SMALL, "pages")
    assert _got(W.op4_warc(spark, SF_SMALL)) == _want(given.collect())
    given.limit(0).write.parquet(str(tmp_path / "pages.parquet"))
    assert W.op4_warc(spark, str(tmp_path)).count() == 0
    twice = given.unionByName(given.withColumn("page_id", F.col("page_id") + 100_000))
    W.write_archives(twice, str(tmp_path / "twice"))
    assert _got(W.capture_index(spark, str(tmp_path / "twice"))) == _want(twice.collect())
