"""CSV members of zip archives as a Spark data source (``zipcsv``), read and written.

Reading: only the archives' directories are listed beforehand; a partition is one member, whose bytes are
fetched and inflated as they are parsed, so a task holds one block of the CSV and one Arrow batch, however large
the archive. Columns are found by the header line; columns that a file lacks are NULL, columns that the schema
lacks are skipped; an empty unquoted field is NULL; a value that does not fit its type fails the scan. Deflate has
no entry points, so a single member cannot be split: large data belongs in many members.

Writing: a task writes one archive with one member under ``_temporary``; the commit moves the archives of the
tasks that succeeded into place, so a lost or repeated task leaves nothing behind.

Paths are opened by Arrow's file systems (local or mounted folders, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import fnmatch
import posixpath
import uuid
import zipfile
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pc
import pyarrow.fs as pf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK_BYTES = 1 << 20  # CSV bytes parsed at a time; a line must fit in one block
_TEMPORARY = "_temporary"


def _open(path: str) -> tuple[pf.FileSystem, str]:
    """The file system of a path or URI, and the path in it. The last part may be a name pattern."""
    folder, name = posixpath.split(path.rstrip("/"))
    if ":" not in path.split("/")[0]:
        return pf.LocalFileSystem(), posixpath.join(folder, name)
    fs, at = pf.FileSystem.from_uri(folder)
    return fs, posixpath.join(at, name)


def _archives(fs: pf.FileSystem, at: str) -> list[str]:
    """The archives of a folder (its direct children), of a name pattern in a folder, or one archive; by name."""
    named = any(c in posixpath.basename(at) for c in "*?[")
    if not named and fs.get_file_info(at).type == pf.FileType.File:
        return [at]
    folder, pattern = posixpath.split(at) if named else (at, "*.zip")
    return sorted(f.path for f in fs.get_file_info(pf.FileSelector(folder))
                  if f.type == pf.FileType.File and fnmatch.fnmatchcase(f.base_name, pattern))


@dataclass
class Member(InputPartition):
    archive: str
    member: str


class ZipCsvReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.member = options.get("member", "*.csv")
        self.block = int(options.get("blockBytes", BLOCK_BYTES))

    def partitions(self) -> list[Member]:
        out = []
        fs, at = _open(self.path)
        for archive in _archives(fs, at):
            with fs.open_input_file(archive) as raw, zipfile.ZipFile(raw) as z:
                out += [Member(archive, i.filename) for i in z.infolist()
                        if i.file_size and not i.is_dir() and fnmatch.fnmatchcase(i.filename, self.member)]
        return out or [Member("", "")]

    def read(self, partition: Member):
        if not partition.archive:
            return
        schema = to_arrow_schema(self.schema)
        fs, _ = _open(self.path)
        with fs.open_input_file(partition.archive) as raw, zipfile.ZipFile(raw) as z, z.open(partition.member) as plain:
            batches = pc.open_csv(
                pa.PythonFile(plain, mode="r"), read_options=pc.ReadOptions(block_size=self.block, use_threads=False),
                parse_options=pc.ParseOptions(newlines_in_values=True),
                convert_options=pc.ConvertOptions(
                    column_types=schema, include_columns=schema.names, include_missing_columns=True, null_values=[""],
                    strings_can_be_null=True, quoted_strings_can_be_null=False))
            for batch in batches:
                if batch.num_rows:
                    yield batch


@dataclass
class Written(WriterCommitMessage):
    archive: str | None
    name: str


class ZipCsvWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.member = options.get("member", "part.csv")

    def write(self, batches) -> Written:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, folder = _open(self.path)
        first = next((b for b in batches if b.num_rows), None)
        name = f"part-{part:05d}-{self.job}.zip"
        if first is None:
            return Written(None, name)
        at = f"{folder}/{_TEMPORARY}/{self.job}/{uuid.uuid4().hex}.zip"
        fs.create_dir(posixpath.dirname(at), recursive=True)
        with fs.open_output_stream(at) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z, \
                z.open(self.member, "w", force_zip64=True) as plain:
            with pc.CSVWriter(pa.PythonFile(plain, mode="w"), first.schema) as out:
                out.write_batch(first)
                for batch in batches:
                    out.write_batch(batch)
        return Written(at, name)

    def commit(self, messages: list) -> None:
        fs, folder = _open(self.path)
        fs.create_dir(folder, recursive=True)
        if self.overwrite:
            for archive in _archives(fs, folder):
                fs.delete_file(archive)
        for m in messages:
            if m is not None and m.archive:
                fs.move(m.archive, f"{folder}/{m.name}")
        self._clear(fs, folder)

    def abort(self, messages: list) -> None:
        self._clear(*_open(self.path))

    def _clear(self, fs: pf.FileSystem, folder: str) -> None:
        """Removes this job's own temporary files (those of failed or repeated tasks too)."""
        mine = f"{folder}/{_TEMPORARY}/{self.job}"
        if fs.get_file_info(mine).type == pf.FileType.Directory:
            fs.delete_dir(mine)


class ZipCsvSource(DataSource):
    """Options: ``path`` (a folder, a name pattern in a folder, or an archive), ``member`` (name pattern when read,
    name when written), ``blockBytes``."""

    @classmethod
    def name(cls) -> str:
        return "zipcsv"

    def reader(self, schema: T.StructType) -> ZipCsvReader:
        return ZipCsvReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> ZipCsvWriter:
        return ZipCsvWriter(schema, dict(self.options), overwrite)


def read_zip_csv(spark: SparkSession, path: str, schema: T.StructType, member: str = "*.csv") -> DataFrame:
    spark.dataSource.register(ZipCsvSource)
    return spark.read.format("zipcsv").schema(schema).option("member", member).load(path)


def write_zip_csv(df: DataFrame, path: str, member: str = "part.csv", mode: str = "append") -> None:
    """One archive for each non-empty partition."""
    df.sparkSession.dataSource.register(ZipCsvSource)
    df.write.format("zipcsv").mode(mode).option("member", member).save(path)
