"""A1/A2 typed scans: CSV or Parquet with an explicit schema (never inferred),
and CSV members of zip archives through the ``zipcsv`` data source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .incidents import nan_to_null
from .zips import read_zip_csv

INCIDENT_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType()),
    T.StructField("Dates", T.TimestampNTZType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Descript", T.StringType()),
    T.StructField("DayOfWeek", T.StringType()),
    T.StructField("PdDistrict", T.StringType()),
    T.StructField("Resolution", T.StringType()),
    T.StructField("Address", T.StringType()),
    T.StructField("X", T.DoubleType()),
    T.StructField("Y", T.DoubleType()),
])

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
_CSV_OPTS = {"header": "true", "timestampNTZFormat": TS_FORMAT, "escape": '"', "mode": "FAILFAST"}


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV with full-precision timestamps (the scan below reads it back typed)."""
    (df.write.mode("overwrite").option("header", "true").option("escape", '"')
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def header_schema(spark: SparkSession, path: str, schema: T.StructType = INCIDENT_SCHEMA) -> T.StructType:
    """The columns a CSV's header line names, in their order, with the schema's types (others as strings).

    Only the header is read; every file under ``path`` must have this layout (a file with another one
    fails the typed scan)."""
    known = {f.name: f.dataType for f in schema.fields}
    names = spark.read.option("header", "true").option("escape", '"').csv(path).columns
    return T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])


def read_incidents(spark: SparkSession, path: str, fmt: str = "csv",
                   schema: T.StructType = INCIDENT_SCHEMA) -> DataFrame:
    """A1: typed scan of incident files; CSV columns are found by their header names. Columns missing
    from a file (train files have no Id, test files no Category, Descript and Resolution) come back
    NULL; NaN coordinates become NULL. Rows without a key go through ``stage_incidents`` first."""
    if fmt == "csv":
        df = spark.read.schema(header_schema(spark, path, schema)).options(**_CSV_OPTS, enforceSchema="false").csv(path)
        df = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in schema.fields])
    elif fmt == "parquet":
        df = spark.read.schema(schema).parquet(path)
    else:
        raise ValueError(fmt)
    return nan_to_null(df)


def stage_incidents(spark: SparkSession, path: str, out: str, fmt: str = "csv") -> DataFrame:
    """Read incident files once, give rows without an Id a key, store them as Parquet and read them back.

    The key (partition and row number of the scan) is unique and is assigned once: every later job
    reads the stored one. Files with keys keep them; a file in which some rows lack theirs is refused."""
    df = read_incidents(spark, path, fmt)
    if fmt == "csv" and "Id" not in header_schema(spark, path).names:
        df = df.withColumn("Id", F.monotonically_increasing_id())
    df.write.mode("overwrite").parquet(out)
    stored = read_incidents(spark, out, "parquet")
    if not stored.where(F.col("Id").isNull()).isEmpty():
        raise ValueError("some incidents have no Id")
    return stored


def read_features(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A2: the finished feature table (Parquet preferred; CSV needs the schema)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError("a CSV feature table needs an explicit schema")
    return spark.read.schema(schema).options(**_CSV_OPTS).csv(path)


def read_zipped_csv(spark: SparkSession, path: str, member: str,
                    schema: T.StructType = INCIDENT_SCHEMA) -> DataFrame:
    """A1 over zip archives (a folder, a name pattern in a folder, or one archive): one partition per CSV member,
    streamed (``zips.py``). Columns are found by their header names; NaN coordinates become NULL."""
    return nan_to_null(read_zip_csv(spark, path, schema, member))
