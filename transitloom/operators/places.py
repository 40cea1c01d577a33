"""Stops within polygons, and the enriched catalogue: region and country by place, overrides, one row of each identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.functions.country import plate_code
from transitloom.functions.geo import in_polygon, ten_thousandths
from transitloom.functions.text import dedup_name, overridden_country

from .catalog import first_wins

#: Degrees of a cell by which points and polygons meet.
CELL = 0.25


def within(lat: Column, lon: Column, rings: Column) -> Column:
    """Even-odd rule over all rings of a polygon, so holes and several parts count right; rings are not closed."""
    return F.aggregate(rings, F.lit(False), lambda acc, ring: acc != in_polygon(lat, lon, ring))


def containing(points: DataFrame, polygons: DataFrame, key: str) -> DataFrame:
    """``(key, code)`` of every polygon(code, rings) around a point(key, latitude, longitude).

    Both are dealt by cells of a grid, a polygon to all cells that its box meets;
    only points of such a cell are tested against it.
    """
    corners = F.flatten("rings")  # an array of points, whose fields are arrays in turn
    ends = {f"{f}_{c}": getattr(F, f"array_{f}")(corners[c]) for f in ("min", "max") for c in ("lat", "lon")}
    cell = lambda c: F.floor(c / CELL).cast("long")
    boxed = polygons.withColumns(ends)
    cells = boxed.withColumn("x", F.explode(F.sequence(cell(F.col("min_lat")), cell(F.col("max_lat"))))).withColumn("y", F.explode(F.sequence(cell(F.col("min_lon")), cell(F.col("max_lon"))))).select("code", "rings", "x", "y", *ends)
    at = points.select(key, "latitude", "longitude", cell(F.col("latitude")).alias("x"), cell(F.col("longitude")).alias("y"))
    lat, lon = F.col("latitude"), F.col("longitude")
    boxes = lat.between(F.col("min_lat"), F.col("max_lat")) & lon.between(F.col("min_lon"), F.col("max_lon"))
    return at.join(cells, ["x", "y"]).filter(boxes & within(lat, lon, F.col("rings"))).select(key, "code")


def located(points: DataFrame, polygons: DataFrame, key: str, name: str) -> DataFrame:
    """``points`` with the code, as ``name``, of the only polygon around each; null where none or several are."""
    one = containing(points, polygons, key).groupBy(key).agg(F.count(F.lit(1)).alias("n__"), F.first("code").alias("code__")).filter("n__ = 1")
    return points.join(one.select(key, F.col("code__").alias(name)), key, "left")


def with_towns(stops: DataFrame, towns: DataFrame, key: str) -> DataFrame:
    """Each stop once behind each town around it that its name lacks, else as it is."""
    around = containing(stops, towns, key).groupBy(key).agg(F.array_sort(F.collect_set("code")).alias("towns__"))
    lacking = F.filter("towns__", lambda t: ~F.contains("name", F.concat(t, F.lit(","))))
    names = F.when(F.coalesce(F.size(lacking), F.lit(0)) > 0, F.transform(lacking, lambda t: F.concat(t, F.lit(","), F.col("name")))).otherwise(F.array("name"))
    return stops.join(around, key, "left").withColumn("name", F.explode(names)).select(*stops.columns)


def enriched(stops: DataFrame, regions: DataFrame, countries: DataFrame) -> DataFrame:
    """``(name, latitude, longitude, region, country)`` of clean stops(ord, ...): what a stop lacks of region and country by its
    place (a region found so is one at home), overrides of border stops, and the first by ``ord`` of rows of one name,
    region, country and place to four decimals."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rows = located(stops.withColumn("name", F.trim("name")), regions, "ord", "r__")
    home = blank("region") & F.col("r__").isNotNull()
    rows = rows.withColumns({"region": F.when(home, F.col("r__")).otherwise(F.col("region")), "country": F.when(home, "CZ").otherwise(F.col("country"))})
    rows = located(rows, countries, "ord", "c__").withColumn("country", F.when(blank("country"), F.col("c__")).otherwise(F.col("country")))
    other = overridden_country(F.col("name"))
    region = F.when(other.isNotNull(), "").otherwise(F.coalesce("region", F.lit("")))
    rows = rows.withColumns({"region": region, "country": F.coalesce(plate_code(F.coalesce(other, "country")), F.lit(""))})
    keys = [dedup_name(F.col("name")), F.col("region"), F.col("country"), ten_thousandths(F.col("latitude")), ten_thousandths(F.col("longitude"))]
    return first_wins(rows, keys, [F.col("ord")]).select("name", "latitude", "longitude", "region", "country")


def exclude_feeds(lines: DataFrame, operators: list[str], systems: list[int], prefixes: list[str]) -> DataFrame:
    """Lines(operator, systems array, line) but those of an operator, an integrated system or a line prefix that other feeds bring."""
    hit = F.coalesce(F.col("operator").isin(operators), F.lit(False)) | F.coalesce(F.arrays_overlap("systems", F.array(*map(F.lit, systems)).cast("array<int>")), F.lit(False))
    for p in prefixes:
        hit = hit | F.coalesce(F.startswith("line", F.lit(p)), F.lit(False))
    return lines.filter(~hit)


def overridden(rows: DataFrame, overrides: DataFrame, day: Column) -> DataFrame:
    """``rows`` (source_namespace, source_id) with the target of the override valid on ``day``, ends included; null without one."""
    dated = overrides.select("source_namespace", "source_id", "target_namespace", "target_id", F.to_date("valid_from", "yyyyMMdd").alias("lo__"), F.to_date("valid_to", "yyyyMMdd").alias("hi__"))
    valid = (rows["source_namespace"] == dated["source_namespace"]) & (rows["source_id"] == dated["source_id"]) & day.between(dated["lo__"], F.coalesce(dated["hi__"], F.lit("9999-12-31").cast("date")))
    return rows.join(dated, valid, "left").select(rows["*"], "target_namespace", "target_id")
