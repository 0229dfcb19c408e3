"""WARC archives: write, read back, and merge their indexes into ordered capture histories.

Writing: one record per page. Of the pages with equal payloads (HTML as UTF-8, null: empty)
of at least ``min_bytes`` bytes, those with the smallest page_id become ``response`` records,
the others ``revisit`` records that refer to it and carry no payload. Spark's text sink
writes the records (its line separator is the blank line that ends a record), gzip per file,
``RECORDS_PER_FILE`` at most in each, so a reader holds one bounded file.

Reading: each file is cut at its ``Content-Length`` fields, payload sizes and digests are
taken from the payload bytes themselves, and the file's captures are sorted by URL key and
time: a sorted run. Revisits take size and digest from the response they share a digest with.

Merging: runs are dealt into ranges of (URL key, time, page_id); each range holds a slice of
every run, and a loser tree merges the k sorted slices, one comparison per level and capture.
Ranges follow each other, so the result is ordered as a whole. The ranges cut inside a URL's
history, so a URL (or host) with a third of all captures spreads over many tasks.

The pages table has no capture time: ``captured_at`` is ``EPOCH`` plus page_id seconds (modulo
a year). The URL key is the host's labels reversed (lower case, leading ``www.`` dropped),
``)``, then path and query without the fragment; an URL without a scheme is its own key.

Defined results: null html is an empty payload; null URLs have the empty key and sort first;
rows that tie on the smallest page_id of a payload (repeated rows) are all responses; a null
page_id is larger than any other; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpoint_dir, register, table

CRLF = "\r\n"
RECORDS_PER_FILE = 5_000
EPOCH = "2024-01-01"
YEAR = 365 * 86_400
_URL = re.compile(r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^#]*)")


def url_key(url: str) -> str:
    m = _URL.match(url)
    if not m:
        return url.split("#", 1)[0]
    host, rest = m.group(1).lower(), m.group(2)
    host = host[4:] if host.startswith("www.") else host
    return ",".join(reversed(host.split("."))) + ")" + (rest if rest.startswith("/") else "/" + rest)


def _date(page_id):
    s = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(YEAR))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    day = F.date_add(F.lit(EPOCH).cast("date"), F.floor(s / 86_400).cast("int")).cast("string")
    return F.concat(day, F.lit("T"), two(F.floor(s % 86_400 / 3_600)), F.lit(":"), two(F.floor(s % 3_600 / 60)),
                    F.lit(":"), two(s % 60), F.lit("Z"))


def _base32(sha1_hex):
    """Bare upper-case base32 of a 40-digit hex string: five hex digits are four base32 ones."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for i in range(8):
        v = F.conv(F.substring(sha1_hex, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(alphabet, F.shiftright(v, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for j in range(4)]
    return F.concat(*out)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` (page_id, url, html) as gzip WARC files under ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    equal = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(
        F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1").drop("n")
    rows = rows.join(equal, "sha1", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(again, F.lit("")).otherwise(F.concat(http, F.col("payload")))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        field("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", page(F.col("page_id"))),
        field("WARC-Date", _date(F.col("page_id"))),
        F.coalesce(field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")), F.lit("")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("sha1")))),
        F.when(again, F.concat(
            field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            field("WARC-Refers-To", page(F.col("first"))))).otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length("block").cast("string")))
    rows.withColumn("block", block).select(F.concat(head, F.lit(CRLF), F.col("block")).alias("value")) \
        .write.option("lineSep", CRLF + CRLF).option("compression", "gzip") \
        .option("maxRecordsPerFile", records_per_file).text(path)


def parse(content: bytes):
    """(offset, fields, block) of every record of an uncompressed WARC file."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        size = int(fields["Content-Length"])
        yield at, fields, content[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def _page(urn: str | None) -> int | None:
    said = urn[len("<urn:page:"):-1] if urn else "none"
    return None if said == "none" else int(said)


_CAPTURE = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("url_key", T.StringType()),
    T.StructField("captured_at", T.StringType()), T.StructField("page_id", T.LongType()),
    T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType())])
_ARROW = pa.schema([(f.name, pa.int64() if f.dataType == T.LongType() else pa.string()) for f in _CAPTURE.fields])
_LAST = 1 << 63


def captures(content: bytes) -> list[dict]:
    """A file's captures as one run, sorted by URL key, time and page."""
    out = []
    for _, f, block in parse(content):
        response = f["WARC-Type"] == "response"
        payload = block.split(b"\r\n\r\n", 1)[1] if response else b""
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else None
        said = f["WARC-Payload-Digest"].removeprefix("sha1:")
        if response and digest != said:
            raise ValueError(f"payload of {f['WARC-Record-ID']} does not match its digest")
        out.append({"url_key": url_key(f.get("WARC-Target-URI", "")), "captured_at": f["WARC-Date"],
                    "page_id": _page(f["WARC-Record-ID"]), "record_type": f["WARC-Type"],
                    "payload_bytes": len(payload) if response else None, "payload_digest": said,
                    "refers_to": _page(f.get("WARC-Refers-To"))})
    return sorted(out, key=_order)


def _order(c: dict) -> tuple:
    return (c["url_key"], c["captured_at"], _LAST if c["page_id"] is None else c["page_id"])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All captures under ``path``, one sorted run (``run``, ``seq``) per file."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = captures(gzip.decompress(content.as_py()))
                yield pa.RecordBatch.from_pylist([r | {"run": name, "seq": i} for i, r in enumerate(rows)], schema=_ARROW)

    return files.mapInArrow(run, _CAPTURE)


class LoserTree:
    """Merges k sorted sequences; an inner node keeps the loser of its last match, the root's winner is next."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.head = [key(r[0]) if r else None for r in runs]  # None: exhausted, loses to all
        self.loser = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        if self.head[a] is None or self.head[b] is None:
            return self.head[b] is None and self.head[a] is not None
        return (self.head[a], a) < (self.head[b], b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            if self.loser[node] == -1:  # first match here: wait for the opponent
                self.loser[node] = winner
                return
            if self._beats(self.loser[node], winner):
                winner, self.loser[node] = self.loser[node], winner
            node //= 2
        self.loser[0] = winner

    def __iter__(self):
        while self.k and self.head[w := self.loser[0]] is not None:
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.head[w] = self.key(self.runs[w][self.at[w]]) if self.at[w] < len(self.runs[w]) else None
            self._play(w)


def merged(runs: DataFrame) -> DataFrame:
    """The runs' captures in one global order of (url_key, captured_at, page_id)."""
    dealt = runs.repartitionByRange("url_key", "captured_at", "page_id").sortWithinPartitions("run", "seq")

    def run(batches):
        slices: dict[str, list] = {}  # one range's slice of every run
        for b in batches:
            for c in b.to_pylist():
                slices.setdefault(c["run"], []).append(c)
        out = []
        for c in LoserTree(list(slices.values()), _order):
            out.append(c)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=_ARROW)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return dealt.mapInArrow(run, _CAPTURE)


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """The merged index of the archives under ``path``; revisits get size from their response."""
    runs = read_runs(spark, path)
    sizes = runs.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("_size"))
    known = runs.join(sizes, "payload_digest", "left").withColumn("payload_bytes", F.coalesce("payload_bytes", "_size"))
    return merged(known.select(*_CAPTURE.names)).drop("run", "seq")


_NIBBLES = "CAST('0x' || substr(h, 5 * i + 1, 5) AS INTEGER)"
OP4_SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, url, payload, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first,
             coalesce(page_id, 0) % {YEAR} AS s,
             regexp_replace(regexp_replace(coalesce(url, ''), '[\\x00-\\x20\\x7F]', '%20', 'g'), '#.*$', '') AS u FROM p),
k AS (SELECT *, regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?]*)', 1)), '^www[.]', '') AS host,
             regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?]*', '') AS rest FROM d)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
           lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_NIBBLES} >> b) & 31) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to,
       CASE WHEN regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN
            array_to_string(list_reverse(string_split(host, '.')), ',') || ')' ||
            CASE WHEN starts_with(rest, '/') THEN rest ELSE '/' || rest END ELSE u END AS url_key,
       strftime(TIMESTAMP '{EPOCH}' + to_seconds(s), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
FROM k
"""


@register("op4_warc", OP4_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return capture_index(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                             "url_key", "captured_at")
