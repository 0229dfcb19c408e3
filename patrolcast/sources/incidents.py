"""The ``incidents`` input, derived by Spark from the driver's ``events`` table.

The studied scripts ship no data, so the incident table (time, place,
category) is derived row by row from ``events``: one incident per event, so the
work grows with the table. The same template runs on Spark and on DuckDB (the
oracle); only the interval arithmetic and the weekday function differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

# One template, two dialects. ``{back}`` moves the event time back 8 to 20.7
# years, ``{wd}`` is the Monday=0 weekday.
_TEMPLATE = """
WITH b AS (SELECT *, (event_id * 31) % 1999 AS a, 4200000 + (event_id * 104729) % 6700000 AS m FROM {events}),
k AS (SELECT event_id AS Id, {back} AS Dates, a, event_type, props FROM b)
SELECT Id, Dates,
  concat('CAT_', lpad(CAST(CASE WHEN Id % 7 = 0 THEN (Id * 17) % 39
    ELSE ((a % 10) * 4 + CAST(floor(hour(Dates) / 6) AS INT)) % 39 END AS VARCHAR(2)), 2, '0')) AS Category,
  props AS Descript,
  CASE {wd} WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday'
    WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END AS DayOfWeek,
  CASE a % 10 WHEN 0 THEN 'BAYVIEW' WHEN 1 THEN 'CENTRAL' WHEN 2 THEN 'INGLESIDE' WHEN 3 THEN 'MISSION' WHEN 4 THEN 'NORTHERN'
    WHEN 5 THEN 'PARK' WHEN 6 THEN 'RICHMOND' WHEN 7 THEN 'SOUTHERN' WHEN 8 THEN 'TARAVAL' ELSE 'TENDERLOIN' END AS PdDistrict,
  event_type AS Resolution,
  CASE WHEN Id % 194 = 0 THEN concat('UNKNOWN ', CAST(Id AS VARCHAR(20)))
    WHEN a % 3 = 0 THEN concat('ST', CAST(a AS VARCHAR(20)), ' / AV', CAST(a % 37 AS VARCHAR(20)))
    ELSE concat(CAST(a AS VARCHAR(20)), ' Block of ST', CAST(a % 53 AS VARCHAR(20))) END AS Address,
  CASE WHEN Id % 97 = 0 THEN CAST(-120.5 AS DOUBLE)
    ELSE CAST(-122.51 AS DOUBLE) + ((a * 7919) % 100003) / CAST(100003 AS DOUBLE) * CAST(0.15 AS DOUBLE) END AS X,
  CASE WHEN Id % 97 = 0 THEN CAST(90 AS DOUBLE)
    ELSE CAST(37.71 AS DOUBLE) + ((a * 6007) % 100019) / CAST(100019 AS DOUBLE) * CAST(0.12 AS DOUBLE) END AS Y
FROM k
"""

_SPARK = {"back": "ts - make_dt_interval(0, 0, CAST(m AS INT), 0)", "wd": "weekday(Dates)"}
_DUCKDB = {"back": "ts - to_minutes(m)", "wd": "(isodow(Dates) - 1)"}

RAW_COLUMNS = ["Id", "Dates", "Category", "Descript", "DayOfWeek", "PdDistrict", "Resolution", "Address", "X", "Y"]


def nan_to_null(df: DataFrame, cols=("X", "Y")) -> DataFrame:
    """NaN coordinates become NULL so that masks and means skip them."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All incidents (train and test rows) derived from ``events``."""
    events = spark.read.parquet(table_path(sf_dir, "events")).select("event_id", "ts", "event_type", "props")
    sql = _TEMPLATE.format(events="{events}", **_SPARK)
    return nan_to_null(spark.sql(sql, events=events))


def is_test(col="Id"):
    """Fixture split: every fifth incident is a test row (test rows carry no label)."""
    return F.col(col) % 5 == 0


def train_rows(df: DataFrame) -> DataFrame:
    return df.filter(~is_test())


def test_rows(df: DataFrame) -> DataFrame:
    return df.filter(is_test()).drop("Category", "Descript", "Resolution")


def duckdb_cte() -> str:
    """``incidents AS (...)`` for the DuckDB oracle (raw tables are views there)."""
    body = _TEMPLATE.format(events="events", **_DUCKDB).strip()
    head, _, select = body.partition("\nSELECT ")
    # head is "WITH b AS (...),\nk AS (...)"; keep those CTEs and add ours.
    return f"{head},\nincidents AS (SELECT {select})"


def duckdb_with(*extra_ctes: str) -> str:
    """A full leading ``WITH`` clause: the fixture, the train/test views, then ``extra_ctes``."""
    parts = [duckdb_cte(),
             "train AS (SELECT * FROM incidents WHERE Id % 5 <> 0)",
             "test AS (SELECT Id, Dates, DayOfWeek, PdDistrict, Address, X, Y FROM incidents WHERE Id % 5 = 0)"]
    parts.extend(extra_ctes)
    return ",\n".join(parts) + "\n"
