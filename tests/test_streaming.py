"""Streams over files, taken in what has come so far."""

import datetime

from transitloom.streaming import arrivals


def test_catalogue_files_as_they_come(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("A,50.1,15.1,R,CZ\n a ,50.10001,15.1,R,CZ\nB,0,0,,\n")

    def run():
        query = arrivals.append(arrivals.first_seen(arrivals.catalogue_stream(spark, str(folder))), str(tmp_path / "out"), str(tmp_path / "ck"))
        query.awaitTermination()
        return sorted(r["name"].strip().upper() for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == ["A"]
    (folder / "b.csv").write_text("A,50.1,15.1,R,CZ\nC,50.2,15.1,R,D\n")
    assert run() == ["A", "C"]


def test_calls_by_window(spark, tmp_path):
    at = lambda h, m: datetime.datetime(2024, 1, 1, h, m)
    spark.createDataFrame([("x", at(1, 5)), ("x", at(1, 50)), ("y", at(1, 7)), ("x", at(5, 0))], "place string, ts timestamp").write.parquet(str(tmp_path / "calls"))
    calls = spark.readStream.schema("place string, ts timestamp").parquet(str(tmp_path / "calls"))
    arrivals.append(arrivals.calls_by_window(calls), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {(r["place"], r["calls"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert ("x", 2) in got and ("y", 1) in got
