"""Readers of text tables, archives and workbooks. Blank cells are empty text unless a reader says otherwise."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GEODATA = ("name", "latitude", "longitude", "region", "country")
CONTEXTS = "array<struct<sample_trip_id: string, previous: struct<stop_id: string, elapsed_minutes: double, latitude: double, longitude: double>, following: struct<stop_id: string, elapsed_minutes: double, latitude: double, longitude: double>, occurrences: int>>"
# Members of a timetable archive and the places of their columns.
MEMBERS = {
    "Linky.txt": {"route": 0, "name": 1, "kind": 3, "distinction": 16},
    "Zastavky.txt": {"stop": 0, "town": 1, "district": 2, "place": 3, "region": 4, "country": 5},
    "LinExt.txt": {"route": 0, "distinction": 6},
    "Zasspoje.txt": {"route": 0, "trip": 1, "stop": 3, "km": 9, "arrival": 10, "departure": 11, "distinction": 14},
}
# Headings of the railway workbook.
RAILWAY = {"code": "Evidenční číslo", "name": "Název", "name20": "Název 20", "latitude": "GPS N (DEG)", "longitude": "GPS E (DEG)", "qualifier": "Kvalifikátor"}
PASSING = ("|", "<")
ROWS = 8192


def number(c: Column) -> Column:
    """A double; blank or not a number gives null."""
    return F.trim(c).try_cast("double")


def _filled(rows: DataFrame, trim: bool = False) -> DataFrame:
    fill = lambda c: F.coalesce(F.trim(c) if trim else c, F.lit(""))
    return rows.select(*[fill(F.col(f"`{c}`")).alias(c) for c in rows.columns])


def geodata(spark: SparkSession, path: str) -> DataFrame:
    """Headerless five-column catalogue, all text; blank lines are skipped, any other width is an error once read."""
    schema = ", ".join(f"{c} string" for c in GEODATA) + ", bad__ string"
    rows = spark.read.csv(path, schema=schema, columnNameOfCorruptRecord="bad__", escape='"', mode="PERMISSIVE")
    checked = F.when(F.col("bad__").isNull(), True).otherwise(F.raise_error(F.concat(F.lit("not five columns: "), "bad__", F.coalesce("name", F.lit("")))).cast("boolean"))
    return _filled(rows.filter(checked).drop("bad__"))


def catalogues(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.csv`` under a folder: five-column rows (a sixth is ignored, other widths skipped) with ``ord``, by path and line."""
    lines = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter="*.csv")
    lines = lines.select("value", F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("ord"))
    width = F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), ","))
    cells = F.from_csv("value", ", ".join(f"{c} string" for c in (*GEODATA, "extra")), {"escape": '"'})
    return lines.filter(width.isin(5, 6)).select("ord", cells.alias("cells")).select(*[F.coalesce(f"cells.{c}", F.lit("")).alias(c) for c in GEODATA], "ord")


def fixed_table(spark: SparkSession, path: str, fields: list[str], trim: bool = False) -> DataFrame:
    """A table whose heading must be ``fields``, all text; a missing file is an empty table."""
    try:
        rows = spark.read.csv(path, header=True, escape='"')
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ", ".join(f"{f} string" for f in fields))
    if rows.columns != list(fields):
        raise ValueError(f"{path}: expected columns {', '.join(fields)}, found {', '.join(rows.columns)}")
    return _filled(rows, trim)


def stop_queries(spark: SparkSession, path: str) -> DataFrame:
    """Stops to resolve; the review table that ``sinks.review`` writes can be read again."""
    rows = spark.read.csv(path, header=True, escape='"', multiLine=True)
    have = set(rows.columns)
    if not {"name", "municipality", "region", "country"} <= have or not {"stop_id", "stop_ids"} & have:
        raise ValueError(f"{path} must have country, municipality, name, region and stop_id or stop_ids")
    get = lambda c: F.trim(F.col(c)) if c in have else F.lit(None).cast("string")
    full = lambda c, default="": F.coalesce(F.nullif(get(c), F.lit("")), F.lit(default))
    return rows.select(
        F.coalesce(F.nullif(get("stop_id"), F.lit("")), get("stop_ids"), F.lit("")).alias("stop_id"), *[full(c).alias(c) for c in ("name", "municipality", "region", "country")],
        full("coordinate_status", "missing").alias("coordinate_status"), number(get("current_latitude")).alias("latitude"), number(get("current_longitude")).alias("longitude"),
        full("coordinate_source").alias("coordinate_source"), full("route_occurrences", "0").cast("int").alias("route_occurrences"), F.from_json(full("route_contexts", "[]"), CONTEXTS).alias("route_contexts"),
    )


def stop_metadata(spark: SparkSession, path: str, order: Column | None = None) -> DataFrame:
    """One row of each ``gtfs_stop_id``, the last in file order or by ``order``."""
    rows = spark.read.parquet(path)
    last = order if order is not None else F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    kept = rows.withColumn("ord__", last).withColumn("rn__", F.row_number().over(Window.partitionBy("gtfs_stop_id").orderBy(F.col("ord__").desc())))
    return kept.filter("rn__ = 1").drop("ord__", "rn__")


def gtfs(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One unpacked feed table (``stops``, ``stop_times``, ``trips``, ``routes``), all text."""
    return _filled(spark.read.csv(f"{folder}/{table}.txt", header=True, escape='"'))


def archive_rows(spark: SparkSession, path: str, member: str, encoding: str = "utf-8-sig") -> DataFrame:
    """``(archive, line, cells)`` of one text member of every zip archive; the member is streamed, never held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as archive:
                    if member not in archive.namelist():
                        continue
                    held: list[list[str]] = []
                    begun = 0
                    with archive.open(member) as raw:
                        for row in csv.reader(io.TextIOWrapper(raw, encoding=encoding, newline="")):
                            held.append(row)
                            if len(held) == ROWS:
                                yield _rows(name, begun, held)
                                begun, held = begun + ROWS, []
                    if held:
                        yield _rows(name, begun, held)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "archive string, line long, cells array<string>")


def _rows(name: str, begun: int, held: list[list[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(range(begun, begun + len(held)), pa.int64()), pa.array(held, pa.list_(pa.string()))], ["archive", "line", "cells"])


def timetable(spark: SparkSession, path: str, member: str) -> DataFrame:
    """A positional member of the timetable archives (see ``MEMBERS``), the last cell's semicolon cut off."""
    cell = lambda i: F.coalesce(F.rtrim(F.get("cells", F.lit(i)), F.lit(";")), F.lit(""))
    return archive_rows(spark, path, member, "cp1250").filter(F.size("cells") > 1).select("archive", "line", *[cell(i).alias(c) for c, i in MEMBERS[member].items()])


def timetable_calls(spark: SparkSession, path: str, active: DataFrame | None = None) -> DataFrame:
    """Calls of the archives with exact kilometres; passing calls, and trips not in ``active(route, distinction, trip)``, are left out."""
    c = timetable(spark, path, "Zasspoje.txt")
    passing = F.col("departure").isin(*PASSING) | ((F.col("arrival") == "") & (F.col("departure") == ""))
    kept = c.filter(~passing).withColumn("km", F.nullif(F.col("km"), F.lit("")).cast("decimal(18,6)"))
    return kept if active is None else kept.join(active, ["route", "distinction", "trip"], "left_semi")


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for letter in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(letter) - 64
    return n - 1


def workbook(spark: SparkSession, path: str) -> DataFrame:
    """``(path, line, cells)`` of the first sheet of workbooks, line 1 first; empty cells are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as book:
                    texts = []
                    if "xl/sharedStrings.xml" in book.namelist():
                        texts = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.parse(book.open("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
                    sheet = min((n for n in book.namelist() if n.startswith("xl/worksheets/sheet")), key=lambda n: (len(n), n))
                    lines, cells = [], []
                    for at, row in enumerate(ElementTree.parse(book.open(sheet)).iter(f"{_MAIN}row"), start=1):
                        values: list[str | None] = []
                        for c in row.iter(f"{_MAIN}c"):
                            place = _column(c.get("r")) if c.get("r") else len(values)
                            values += [None] * (place + 1 - len(values))
                            value = c.find(f"{_MAIN}v")
                            if c.get("t") == "inlineStr":
                                values[place] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                            elif value is not None and value.text is not None:
                                values[place] = texts[int(value.text)] if c.get("t") == "s" else value.text
                        lines.append(int(row.get("r", at)))
                        cells.append(values)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(lines), pa.string()), pa.array(lines, pa.int64()), pa.array(cells, pa.list_(pa.string()))], ["path", "line", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, line long, cells array<string>")


def degrees(c: Column) -> Column:
    """Degrees written like ``N50,1°``."""
    return F.translate(F.translate(c, "NE°", ""), ",", ".").try_cast("double")


def railway_points(rows: DataFrame) -> DataFrame:
    """Points of ``workbook`` rows with ``problem`` (null if sound): every row that is not blank."""
    head = F.broadcast(rows.filter("line = 1").select("path", F.col("cells").alias("head")))
    named = rows.filter("line > 1").join(head, "path").filter(F.exists("cells", lambda v: v.isNotNull()))
    get = lambda c: F.get("cells", F.array_position("head", F.lit(RAILWAY[c])).cast("int") - 1)
    digits = F.regexp_replace(F.trim(get("code")), r"\.0+$", "")
    code = F.when(F.length(digits) <= 6, F.lpad(digits, 6, "0"))
    out = named.select(
        "line", code.alias("code"), F.trim(get("name")).alias("name"), F.trim(get("name20")).alias("name20"), degrees(get("latitude")).alias("latitude"), degrees(get("longitude")).alias("longitude"),
        get("qualifier").try_cast("double").cast("int").alias("qualifier"), F.array_except(F.array(*map(F.lit, RAILWAY.values())), F.col("head")).alias("lacking"),
    )
    ok = lambda c: F.coalesce(c, F.lit(False))
    problem = (
        F.when(F.size("lacking") > 0, F.concat(F.lit("missing columns: "), F.array_join("lacking", ", ")))
        .when(~ok(F.col("code").rlike("^[0-9]{6}$")), "invalid identifier")
        .when(~ok((F.col("name") != "") & (F.col("name20") != "")), "blank name")
        .when(~ok(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)), "coordinates")
        .when(F.col("qualifier").isNull(), "qualifier")
    )
    return out.withColumn("problem", problem).drop("lacking")


def code_collisions(points: DataFrame) -> DataFrame:
    """``(kind, value, n)``: identifiers that occur twice, and five-digit beginnings that do."""
    count = lambda kind, c: points.groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit(kind).alias("kind"), "value", "n")
    return count("identifier", F.col("code")).unionByName(count("beginning", F.substring("code", 1, 5)))
