"""Readers and writers on small files."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from transitloom.operators import registry, rules
from transitloom.sources import files, sinks, snapshots


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_geodata_width_is_checked(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('﻿"A ""x"", b",50.1,14.0,,CZ\n\nB,49,15,OL,\n', encoding="utf-8")
    bad.write_text("A,50.1,14.0,,CZ\nB,1,2\n", encoding="utf-8")
    assert rows(files.geodata(spark, str(good)), "name") == [('A "x", b', "50.1", "14.0", "", "CZ"), ("B", "49", "15", "OL", "")]
    with pytest.raises(Exception, match="not five columns"):
        files.geodata(spark, str(bad)).collect()


def test_catalogues_keep_order_and_skip_other_widths(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "2.csv").write_text("B,1,2,x,CZ,more\nshort,1\n", encoding="utf-8")
    (tmp_path / "1.csv").write_text('"A, a",1,2,x,CZ\nC,1,2,x,CZ\n', encoding="utf-8")
    assert [r[0] for r in rows(files.catalogues(spark, str(tmp_path)), "ord")] == ["A, a", "C", "B"]


def test_fixed_table(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,reason\n 1 ,\n", encoding="utf-8")
    assert rows(files.fixed_table(spark, str(path), ["id", "reason"], trim=True)) == [("1", "")]
    assert files.fixed_table(spark, str(tmp_path / "none.csv"), ["id"]).count() == 0
    with pytest.raises(ValueError, match="expected columns"):
        files.fixed_table(spark, str(path), ["id"])


def test_review_can_be_read_again(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('stop_ids,name,municipality,region,country,current_latitude,route_contexts\n7,"Brno,hl.n.",Brno,BM,CZ,,"[{""sample_trip_id"":""t"",""occurrences"":2}]"\n', encoding="utf-8")
    first = files.stop_queries(spark, str(path)).cache()
    left = first.withColumns({"reason": F.lit("not_found"), "candidates": F.lit(0)})
    sinks.write_results(left.limit(0), left, str(tmp_path / "found"), str(tmp_path / "left"))
    assert rows(files.stop_queries(spark, str(tmp_path / "left"))) == rows(first)
    assert first.first()["route_contexts"][0]["occurrences"] == 2 and first.first()["latitude"] is None


def test_metadata_last_wins(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "gtfs_stop_id string, v int").coalesce(1).write.parquet(str(tmp_path / "m"))
    assert rows(files.stop_metadata(spark, str(tmp_path / "m")), "gtfs_stop_id") == [("a", 3), ("b", 2)]


def test_timetable_archive(spark, tmp_path):
    call = lambda km, arr, dep: f'"1","2","0","9","","","","","","{km}","{arr}","{dep}","","","1";\r\n'
    with zipfile.ZipFile(tmp_path / "j.zip", "w") as z:
        z.writestr("Zasspoje.txt", (call("1.5", "", "0800") + call("2", "", "|") + call("", "0900", "") + call("3", "", "")).encode("cp1250"))
        z.writestr("Zastavky.txt", '"9","Žďár","","nám.","","CZ";\r\n'.encode("cp1250"))
    assert rows(files.timetable(spark, str(tmp_path / "j.zip"), "Zastavky.txt").drop("archive")) == [(0, "9", "Žďár", "", "nám.", "", "CZ")]
    active = spark.createDataFrame([("1", "1", "2")], "route string, distinction string, trip string")
    calls = files.timetable_calls(spark, str(tmp_path / "j.zip"), active)
    assert [None if r["km"] is None else float(r["km"]) for r in calls.orderBy("line").collect()] == [1.5, None]
    assert calls.schema["km"].dataType.simpleString() == "decimal(18,6)"


def test_workbook(spark, tmp_path):
    heads = list(files.RAILWAY.values())
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    line = lambda n, values: f'<row r="{n}">' + "".join(cell(f"{chr(65 + i)}{n}", v) for i, v in enumerate(values)) + "</row>"
    body = line(1, heads) + line(2, ["12345", " Brno ", "Brno", "N49,19°", "E16,61°", "1"]) + '<row r="3"><c r="A3"/></row>' + line(4, ["1234567", "X", "X", "1", "1", "1"])
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
    points = files.railway_points(files.workbook(spark, str(tmp_path / "w.xlsx")))
    assert rows(points, "line") == [(2, "012345", "Brno", "Brno", 49.19, 16.61, 1, None), (4, None, "X", "X", 1.0, 1.0, 1, "invalid identifier")]
    sound = points.filter("problem is null")
    assert rows(sinks.listing(sound)) == [("012345", "Brno", "49.19", "16.61")]
    assert rows(files.code_collisions(sound.union(sound)), "kind") == [("beginning", "01234", 2), ("identifier", "012345", 2)]


def test_feature_points(spark):
    lines = ['{"attributes": {"a": " x ", "b": null}, "geometry": {"x": 14.0, "y": 50.0}}', '{"attributes": {"a": "m", "b": "n"}, "geometry": {"points": [[1.0, 2.0], [3.0, 4.0]]}}']
    df = spark.createDataFrame([(v,) for v in lines], "v string").select(F.from_json("v", snapshots.FEATURE).alias("f")).select("f.*")
    assert rows(snapshots.feature_points(df, ["a", "b"]), "latitude") == [("m,n", 2.0, 1.0), ("m,n", 4.0, 3.0), ("x,", 50.0, 14.0)]


def test_service_readers(spark):
    boards = spark.createDataFrame([("Ústí n.L.,Mírové", 50.0, 14.0), ("A", None, 1.0)], "Name string, Latitude double, Longitude double")
    assert [r[0] for r in rows(snapshots.board_stops(boards), "name")] == ["Ústí n.L.,Mírové", "Ústí nad Labem,Mírové"]
    kind = "array<struct<type: string>>"
    groups = spark.createDataFrame([("Most", "Zlín", "ZL", [(1.0, 2.0, [("train",)]), (3.0, 4.0, [("bus",), ("train",)])])], f"name string, municipality string, districtCode string, stops array<struct<lat: double, lon: double, lines: {kind}>>")
    assert rows(snapshots.group_stops(groups), "name") == [("Most", 3.0, 4.0, "ZL"), ("Zlín,Most", 3.0, 4.0, "ZL")]
    packed = spark.createDataFrame([([["1", "", "Nádraží [x]", "15900000", "49500000"]],)], "stops array<array<string>>")
    assert rows(snapshots.packed_stops(packed)) == [("Žďár n.Sáz.,Nádraží", 49.5, 15.9)]
    stations = spark.createDataFrame([("a", 1.0, 2.0, [("V",)]), ("b", 1.0, 2.0, [("V",), ("A",)]), ("c", None, 2.0, [("A",)]), ("d", 1.0, 2.0, [])], "name string, lat double, lon double, serviceTypes array<struct<vehicleType: string>>")
    assert [r[0] for r in rows(snapshots.station_stops(stations))] == ["b"]


def test_shapes(spark):
    square = "[[[10, 50], [12, 50], [12, 52], [10, 52], [10, 50]]]"
    df = spark.createDataFrame([("s", ("Polygon", square)), ("p", ("Point", "[1.5, 2.5]"))], "n string, geometry struct<type: string, coordinates: string>")
    assert rows(snapshots.shape_points(df, F.col("n")), "name") == [("p", 2.5, 1.5), ("s", 51.0, 11.0)]


def test_candidates(spark):
    elements = spark.createDataFrame([(1, None, None, (50.0, 14.0), {"name": "A", "alt_name": "B; ;C", "is_in": "Town"}), (2, 1.0, 2.0, None, {"ref": "x"})], snapshots.ELEMENT)
    found = snapshots.map_elements(elements, F.lit("Other"), F.lit("CZ"))
    assert rows(found) == [(1, ["A", "B", "C"], 50.0, 14.0, "Town", "CZ", "stop", "osm")]
    items = spark.createDataFrame([("N", "Stop, Brno, CZ", "highway", "bus_stop", "49.1", "16.6", {"country_code": "cz"}, {"a": "N", "b": "M"}, "Brno", "SK")], snapshots.PLACE + ", municipality string, country string")
    assert rows(snapshots.search_places(items, F.col("type") == "bus_stop")) == [(["N", "M"], 49.1, 16.6, "Brno", "cz", "stop", "nominatim-search")]
    entities = [{"name": "A", "label": "Zastávka", "position": {"lat": 1.0, "lon": 2.0}, "regionalStructure": [{"name": "Brno", "type": "regional.municipality"}, {"type": "regional.country", "isoCode": "CZ"}]}, {"name": "B", "label": "Shop"}, {"name": "C", "label": "Shop", "position": {"lat": 3.0, "lon": 4.0}}]
    answers = spark.createDataFrame([("q", json.dumps({"items": entities}))], "query string, v string").select("query", F.from_json("v", snapshots.ENTITIES)["items"].alias("items"))
    assert rows(snapshots.ranked_entities(answers), "rank") == [("q", 0, ["A"], 1.0, 2.0, "Brno", "CZ", "stop", "mapy"), ("q", 2, ["C"], 3.0, 4.0, "", "", "poi", "mapy")]


def test_small_readers(spark):
    results = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "town string, v int")
    assert rows(snapshots.sole_answers(results, ["town"])) == [("a", 1)]
    links = spark.createDataFrame([("9.12.2024 10:00:00", "old"), ("10.1.2025 09:00:00", "new")], "published string, href string")
    assert rows(snapshots.latest_edition(links)) == [("new",)]


def test_write_stops(spark, tmp_path):
    shape = "name string, latitude double, longitude double, region string, country string"
    stops = spark.createDataFrame([("A", 50.0, 14.0, "", "CZ"), (" ", 50.0, 14.0, "", ""), ("Z", 0.0, 0.0, "", "")], shape)
    assert sinks.write_stops(stops, str(tmp_path / "s")) == 1
    assert rows(files.geodata(spark, str(tmp_path / "s"))) == [("A", "50.0", "14.0", "", "CZ")]
    with pytest.raises(ValueError, match="no stops"):
        sinks.write_stops(stops.limit(0), str(tmp_path / "none"))
    with pytest.raises(RuntimeError, match="bad"):
        sinks.write_all({"bad": lambda: stops.limit(0), "good": lambda: stops}, str(tmp_path / "all"))
    assert files.geodata(spark, str(tmp_path / "all" / "good")).count() == 1


def test_write_pair(spark, tmp_path):
    points = spark.createDataFrame([("000002", "B", "b", 50.61737, 14.0, 1), ("000001", "A", "a", 49.5, 15.25, 2)], "code string, name string, name20 string, latitude double, longitude double, qualifier int")
    sinks.write_pair(points, str(tmp_path), "one")
    assert rows(spark.read.csv(str(tmp_path / "one" / "names"))) == [("A", "49.5", "15.25"), ("B", "50.61737", "14")]
    with pytest.raises(Exception, match="already exists"):
        sinks.write_pair(points, str(tmp_path), "one")


def test_rule_errors(spark):
    shape = "id int, agency_id string, licence string, public_line string, expected_mode string, effective_mode string, reason string"
    data = [(1, "", "1*", "1-5", "A", "E", "r"), (2, "", "12*", "6", "A", "E", "r"), (3, "", "13*", "5-9", "A", "E", ""), (4, "x", "14*", "9-5", "A", "A", "r"), (5, "", "12*", "", "A", "T", "r")]
    found = set(rows(rules.mode_errors(spark.createDataFrame(data, shape))))
    assert found == {(3, "reason is required"), (4, "agency is not a number"), (4, "invalid line guard"), (4, "changes nothing"), (5, "conflicts with 2")}
    shape = "id int, agency_id string, licence string, route_short_name string, route_color string, route_text_color string, reason string"
    data = [(1, "", "5", "", "", "", "r"), (2, "", "7", "a", "12345", "", "r"), (3, "", "7", "b", "", "FFFFFF", "r")]
    found = set(rows(rules.presentation_errors(spark.createDataFrame(data, shape))))
    assert found == {(1, "overrides nothing"), (2, "route_color is not six hex digits"), (3, "conflicts with 2")}


def test_registered_stops_are_used_again(spark):
    known = spark.createDataFrame([(1, 0, "k", 50.0, 14.0), (2, 1, "k", 50.0005, 14.0), (3, 2, "n", None, None)], "id int, ord int, key string, lat double, lon double")
    cands = spark.createDataFrame([("a", "k", 50.0004, 14.0), ("b", "k", 51.0, 14.0), ("c", "n", 1.0, 1.0), ("d", "x", 1.0, 1.0)], "cand string, key string, lat double, lon double")
    assert rows(registry.reuse(known, cands), "cand") == [("a", "k", 1), ("b", "k", None), ("c", "n", 3), ("d", "x", None)]
    assert rows(registry.same_place(known)) == [("k", 1, 2)]
    said = spark.createDataFrame([("", "new"), ("alias", "new"), (None, "moved")], "d string, r string")
    assert rows(said.select(registry.decide(F.col("d"), F.col("r"), True))) == [("new",), ("alias",), ("",)]
    targets = spark.createDataFrame([("", "s1"), ("t", "s1"), (None, "s1;s2")], "t string, s string")
    assert rows(targets.select(registry.alias_target(F.col("t"), F.col("s")))) == [("s1",), ("t",), ("",)]
