"""Typed scans and sinks: CSV round trip, zip staging, wide probabilities, trial log."""
import glob
import io
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import types as T

from patrolcast.sources.files import read_incidents, read_zipped_csv, stage_incidents, write_csv
from patrolcast.sources.incidents import incidents
from patrolcast.sources.sinks import append_trial, long_to_wide, read_trials, to_long, to_wide
from patrolcast.sources.zips import ZipCsvReader, read_zip_csv, write_zip_csv

from conftest import SF_SMALL


def test_csv_round_trip_keeps_values(spark):
    df = incidents(spark, SF_SMALL)
    path = os.path.join(tempfile.mkdtemp(prefix="pc-test-"), "csv")
    write_csv(df, path)
    back = read_incidents(spark, path)
    assert back.schema == df.schema or [f.name for f in back.schema] == df.columns
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


TRAIN_FILE = ("Dates,Category,Descript,DayOfWeek,PdDistrict,Resolution,Address,X,Y\n"
              '2015-05-13 23:53:00,WARRANTS,"WARRANT, ""ARREST""",Wednesday,NORTHERN,"ARREST, BOOKED",OAK ST / LAGUNA ST,-122.4258,37.7745\n')
TEST_FILE = ("Id,Dates,DayOfWeek,PdDistrict,Address,X,Y\n"
             "0,2015-05-10 23:59:00,Sunday,BAYVIEW,2000 Block of THOMAS AV,-122.399588,37.735051\n"
             "7,2015-05-10 23:51:00,Sunday,BAYVIEW,3RD ST / REVERE AV,NaN,37.732432\n")


def test_studied_layouts_are_read_by_name(spark, tmp_path):
    (tmp_path / "train.csv").write_text(TRAIN_FILE)
    (tmp_path / "test.csv").write_text(TEST_FILE)
    (tmp_path / "odd.csv").write_text("Y,Id,extra,X,Dates\n1.5,3,zzz,2.5,2015-01-02 03:04:05\n")
    (tr,) = read_incidents(spark, str(tmp_path / "train.csv")).collect()
    assert (tr.Id, tr.Category, tr.Descript, tr.Resolution, tr.X, tr.Y) == (None, "WARRANTS", 'WARRANT, "ARREST"', "ARREST, BOOKED", -122.4258, 37.7745)
    te = read_incidents(spark, str(tmp_path / "test.csv")).orderBy("Id").collect()
    assert [(r.Id, r.Category, r.DayOfWeek, r.PdDistrict, r.X, r.Y) for r in te] == [
        (0, None, "Sunday", "BAYVIEW", -122.399588, 37.735051), (7, None, "Sunday", "BAYVIEW", None, 37.732432)]
    (odd,) = read_incidents(spark, str(tmp_path / "odd.csv")).collect()
    assert (odd.Id, odd.X, odd.Y, odd.Address, odd.Dates.isoformat()) == (3, 2.5, 1.5, None, "2015-01-02T03:04:05")


def test_staged_keys_are_assigned_once(spark, tmp_path):
    head, row = TRAIN_FILE.split("\n")[:2]
    (tmp_path / "train").mkdir()
    for part in range(3):
        (tmp_path / "train" / f"{part}.csv").write_text("\n".join([head] + [row] * 4) + "\n")
    df = stage_incidents(spark, str(tmp_path / "train"), str(tmp_path / "out"))
    ids = sorted(r.Id for r in df.collect())
    assert len(set(ids)) == 12 and None not in ids
    assert ids == sorted(r.Id for r in spark.read.parquet(str(tmp_path / "out")).repartition(2).collect())
    (tmp_path / "test.csv").write_text(TEST_FILE)
    assert sorted(r.Id for r in stage_incidents(spark, str(tmp_path / "test.csv"), str(tmp_path / "out2")).collect()) == [0, 7]
    (tmp_path / "gap.csv").write_text(TEST_FILE + ",2015-05-10 23:51:00,Sunday,BAYVIEW,X,1,2\n")
    with pytest.raises(ValueError, match="no Id"):
        stage_incidents(spark, str(tmp_path / "gap.csv"), str(tmp_path / "out3"))


def test_zip_member_is_read_by_a_spark_job(spark):
    d = tempfile.mkdtemp(prefix="pc-zip-")
    buf = io.StringIO()
    buf.write("Dates,Category,Descript,DayOfWeek,PdDistrict,Resolution,Address,X,Y\n")
    buf.write("2015-05-13 23:53:00,WARRANTS,WARRANT ARREST,Wednesday,NORTHERN,ARREST,OAK ST / LAGUNA ST,-122.425891,37.774599\n")
    buf.write("2015-05-13 23:33:00,OTHER,TRAFFIC,Wednesday,PARK,NONE,,nan,37.77\n")
    with zipfile.ZipFile(os.path.join(d, "a.zip"), "w") as z:
        z.writestr("train.csv", buf.getvalue())
    df = read_zipped_csv(spark, os.path.join(d, "*.zip"), "train.csv")
    rows = df.orderBy("Dates").collect()
    assert len(rows) == 2
    assert rows[1].Category == "WARRANTS" and rows[1].X == -122.425891
    assert rows[0].X is None and rows[0].Address is None


def zip_of(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(f"{name}.csv", text)


def test_zip_source_layouts(spark, tmp_path):
    zip_of(tmp_path / "a.zip", one="k,v,when\n1,x,2015-01-02 03:04:05.25\n2,,\n", two='extra,v,k\nzzz,"line\nbreak, ""q""",3\n', three="k,v\n", four="")
    zip_of(tmp_path / "b.zip", one='v,k\n"",4\n')
    (tmp_path / "c.txt").write_text("no archive")
    schema = T.StructType.fromDDL("k long, v string, when timestamp_ntz")
    df = read_zip_csv(spark, str(tmp_path), schema)
    assert df.rdd.getNumPartitions() == 4  # every member with bytes is a task of its own
    rows = {r.k: (r.v, r.when and r.when.isoformat()) for r in df.collect()}
    assert rows == {1: ("x", "2015-01-02T03:04:05.250000"), 2: (None, None), 3: ('line\nbreak, "q"', None), 4: ("", None)}
    assert sorted(r.k for r in read_zip_csv(spark, f"file:{tmp_path}/*.zip", schema, "one.csv").collect()) == [1, 2, 4]
    assert [r.k for r in read_zip_csv(spark, str(tmp_path / "b.zip"), schema).collect()] == [4]
    (tmp_path / "none").mkdir()
    assert read_zip_csv(spark, str(tmp_path / "none"), schema).count() == 0
    zip_of(tmp_path / "none" / "bad.zip", one="k\nseven\n")
    with pytest.raises(Exception, match="seven"):
        read_zip_csv(spark, str(tmp_path / "none"), schema).collect()


def test_zip_member_is_streamed(tmp_path):
    text = "k,v\n" + "".join(f"{i},{'x' * 50}\n" for i in range(40_000))
    zip_of(tmp_path / "a.zip", one=text)
    reader = ZipCsvReader(T.StructType.fromDDL("k long, v string"), {"path": str(tmp_path), "blockBytes": str(1 << 16)})
    (part,) = reader.partitions()
    sizes, keys = [], []
    for batch in reader.read(part):
        sizes.append(batch.nbytes)
        keys += batch.column(0).to_pylist()
    assert keys == list(range(40_000)) and len(sizes) > 20 and max(sizes) < 1 << 18


def test_zip_sink_commits_whole_jobs(spark, tmp_path):
    path = f"{tmp_path}/out"
    df = spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, concat('a \"', id, '\",\n')) AS v", "id / 8 AS x", "timestamp_ntz'2020-01-01' AS t")
    write_zip_csv(df.repartition(3), path)
    back = read_zip_csv(spark, path, df.schema)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    write_zip_csv(df.where("id < 10").coalesce(1), path, mode="overwrite")
    back = read_zip_csv(spark, path, df.schema)
    assert back.count() == 10 and len(glob.glob(f"{path}/*.zip")) == 1
    with pytest.raises(Exception, match="USER_RAISED"):
        write_zip_csv(df.coalesce(1).selectExpr("id", "if(id = 500, raise_error('stop'), 'y') AS v"), path)
    assert back.count() == 10 and not glob.glob(f"{path}/_temporary/*")


def test_long_and_wide_round_trip(spark):
    df = spark.createDataFrame([(1, [0.2, 0.8]), (2, [0.5, 0.5])], "Id long, probability array<double>")
    wide = to_wide(df, ["A", "B"])
    again = long_to_wide(to_long(df, ["A", "B"]), ["A", "B"])
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, again.collect()))


def test_trial_log_appends(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pc-trials-"), "log")
    append_trial(spark, path, 2.5, {"max_depth": 3}, 1, 10)
    append_trial(spark, path, 2.4, {"max_depth": 4}, 2, None)
    rows = read_trials(spark, path).orderBy("iteration").collect()
    assert [r.iteration for r in rows] == [1, 2] and rows[0].params["max_depth"] == "3"
