"""Helpers shared by the training-data operators: registry, row packing, tokens.

Fixed word rules used by the operators:

* ``WORD``: a word is a run of characters other than space and \\x09-\\x0D;
* ``ALNUM``: after lower-casing A-Z, a run of characters outside
  ``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F`` (digits, a-z, everything non-ASCII).
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, prepare

WORD = r"[^\x20\x09-\x0D]+"
ROW = "_row"


@dataclass
class LlmQuery:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, LlmQuery] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = LlmQuery(name, fn, sql)
        return fn
    return deco


#: Rows reach Python in batches of at most this size, however long the texts (a session setting).
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark (any file system it can open)."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """One struct column holding the whole row, so helper columns can never clash with the caller's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(ROW)[c].alias(c) for c in names])


def text_key(text: Column) -> list[Column]:
    """A 128-bit key of a text: two hashes of it under different salts (null counts as empty)."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("pc"), t, F.length(t)).alias("k2")]


def materialise(df: DataFrame) -> DataFrame:
    """A table in the shared checkpoint folder, read again: cuts lineage, survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def tidy(spark: SparkSession):
    """Within, the shuffle files of a query go as soon as it ends: for steps whose results are written or materialised."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


BITMAP_BITS = 27


def key_bitmap(keys: DataFrame, key: str) -> tuple[bytes, int]:
    """A bitmap of the lowest bits of a long key, to skip rows early; exact joins follow.

    About 16 bits a key, at most 2^27 (16 MB) whatever the number of keys: beyond that it only lets
    more rows pass. Returns the bytes and the mask to apply to a key."""
    n = keys.count()
    bits = min(BITMAP_BITS, max(15, (16 * n).bit_length()))
    mask = (1 << bits) - 1
    pos = F.col(key).bitwiseAND(F.lit(mask))
    rows = keys.groupBy(F.shiftright(pos, 15).alias("page")).agg(
        F.bitmap_construct_agg(pos.bitwiseAND(F.lit(32767))).alias("bits")).collect()
    out = bytearray(1 << (bits - 3))
    for r in rows:
        out[r["page"] * 4096:r["page"] * 4096 + 4096] = r["bits"]
    return bytes(out), mask


def keep(df: DataFrame) -> DataFrame:
    """Kept on executors' memory and disk while one query uses it more than once; recomputable."""
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    if _SCOPES:
        _SCOPES[-1].append(out)
    return out


_SCOPES: list[list[DataFrame]] = []


@contextmanager
def released():
    """Lets go, at its end, of all that was kept within."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for df in _SCOPES.pop():
            df.unpersist()


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ALNUM = bytes((c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20)
               for c in range(256))


def words(raw: bytes) -> list[bytes]:
    """Words by the ``WORD`` rule of a UTF-8 text."""
    return raw.split()


def lower_ascii(raw: bytes) -> bytes:
    return raw.translate(_LOWER)


def alnum_words(raw: bytes) -> list[bytes]:
    """Words by the ``ALNUM`` rule, A-Z lowered."""
    return raw.translate(_ALNUM).split()


def binary_column(batch, name: str) -> list[bytes]:
    """A string column of an Arrow batch as UTF-8 bytes (null: None)."""
    import pyarrow as pa

    col = batch.column(batch.schema.names.index(name))
    return col.cast(pa.binary()).to_pylist() if pa.types.is_string(col.type) else col.cast(pa.large_binary()).to_pylist()

