"""Stops and candidates from snapshots of web services: fetching is not this engine's part, each reader takes the stored answers.

Stop readers give ``name, latitude, longitude`` (and ``region`` where a service has
it); candidate readers give ``names, latitude, longitude, municipality, country, kind, source``.
Null or absent fields count as absent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.functions.text import bare_name, is_misplaced, normalize_text

# Tags that hold names or places, and words that mark a stop's label.
NAME_TAGS = ("name", "name:cs", "name:de", "name:pl", "name:sk", "official_name", "local_name", "short_name")
TOWN_TAGS = ("addr:city", "is_in:city", "is_in")
TOWN_FIELDS = ("city", "town", "village", "municipality", "hamlet")
STOP_WORDS = ("zastav", "station", "stop", "haltestelle", "bahnhof", "przystanek", "stanica")

ELEMENT = "id long, lat double, lon double, center struct<lat: double, lon: double>, tags map<string, string>"
ELEMENT_FIELDS = "id: bigint, lat: double, lon: double, center: struct<lat: double, lon: double>, tags: map<string, string>"
FEATURE = "attributes map<string, string>, geometry struct<x: double, y: double, points: array<array<double>>>"
PLACE = "name string, display_name string, category string, type string, lat string, lon string, address map<string, string>, namedetails map<string, string>"
ENTITIES = "items array<struct<name: string, label: string, position: struct<lat: double, lon: double>, regionalStructure: array<struct<name: string, type: string, isoCode: string>>>>"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _stops(rows: DataFrame, name: Column, lat: Column, lon: Column, *more: Column) -> DataFrame:
    return rows.select(name.alias("name"), lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude"), *more)


def feature_points(features: DataFrame, fields: list[str], error: str | None = None) -> DataFrame:
    """One stop for each point of features (``FEATURE``), named by the trimmed fields; answers whose ``error`` column is set are left out."""
    rows = features if error is None else features.filter(F.col(error).isNull())
    name = F.array_join(F.array(*[F.coalesce(F.trim(F.col("attributes")[f]), F.lit("")) for f in fields]), ",")
    one = F.array(F.array("geometry.x", "geometry.y"))
    points = F.when(F.size("geometry.points") > 0, F.col("geometry.points")).otherwise(one)
    rows = rows.select(name.alias("name"), F.explode(points).alias("p"))
    return _stops(rows, F.col("name"), F.get("p", F.lit(1)), F.get("p", F.lit(0)))


def feed_stops(stops: DataFrame, mapper: Callable[[Column], Column] | None = None) -> DataFrame:
    """Stops of a feed's ``stops`` table; rows without name or position are skipped."""
    name, lat, lon = (F.trim(c) for c in ("stop_name", "stop_lat", "stop_lon"))
    return _stops(stops.filter((name != "") & (lat != "") & (lon != "")), mapper(name) if mapper else name, lat, lon)


def bus_stops(answer: DataFrame) -> DataFrame:
    """``text, isBus, point``: stops of buses."""
    return _stops(answer.filter("isBus"), F.col("text"), F.col("point.lat"), F.col("point.lon"))


def board_stops(answer: DataFrame, short: str = "Ústí n.L.,", full: str = "Ústí nad Labem,") -> DataFrame:
    """``Name, Latitude, Longitude``; names that begin with ``short`` appear under the full name too."""
    long_name = F.when(F.startswith("Name", F.lit(short)), F.concat(F.lit(full), F.substr("Name", F.lit(len(short) + 1))))
    rows = answer.filter("Latitude is not null and Longitude is not null").withColumn("each", F.explode(F.array_compact(F.array("Name", long_name))))
    return _stops(rows, F.col("each"), F.col("Latitude"), F.col("Longitude"))


def map_stops(answer: DataFrame) -> DataFrame:
    """``name, lat, lon, sourceType``: those of type S."""
    return _stops(answer.filter("sourceType = 'S'"), F.col("name"), F.col("lat"), F.col("lon"))


def station_stops(answer: DataFrame) -> DataFrame:
    """``name, lat, lon, serviceTypes``: positioned stations that not only trains serve; one without services counts as such."""
    return _stops(answer.filter(F.col("lat").isNotNull() & ~F.forall("serviceTypes", lambda s: s["vehicleType"] == "V")), F.col("name"), F.col("lat"), F.col("lon"))


def short_stops(answer: DataFrame) -> DataFrame:
    """``n, x, y, t``: all but train stops; ``x`` is the latitude."""
    return _stops(answer.filter("t <> 'T'"), F.col("n"), F.col("x"), F.col("y"))


def group_stops(groups: DataFrame) -> DataFrame:
    """Stop groups: each stop that not only trains serve, once more under its municipality if the name lacks that."""
    rows = groups.select("name", "municipality", F.col("districtCode").alias("region"), F.explode("stops").alias("s"))
    rows = rows.filter(~F.forall("s.lines", lambda line: line["type"] == "train"))
    alias = F.when(~F.contains("name", "municipality"), F.concat_ws(",", "municipality", "name"))
    rows = rows.withColumn("each", F.explode(F.array_compact(F.array("name", alias))))
    return _stops(rows, F.col("each"), F.col("s.lat"), F.col("s.lon"), F.col("region"))


def packed_stops(answer: DataFrame, prefix: str = "Žďár n.Sáz.,") -> DataFrame:
    """``stops`` as arrays of text (third name, fourth longitude, fifth latitude, in millionths); bracketed notes go."""
    rows = answer.select(F.explode("stops").alias("s"))
    return _stops(rows, F.concat(F.lit(prefix), F.regexp_replace(F.get("s", F.lit(2)), r" *\[.*\]", "")), F.get("s", F.lit(4)).cast("double") / 1e6, F.get("s", F.lit(3)).cast("double") / 1e6)


def ring_centroid(ring: Column) -> Column:
    """Area centroid ``struct(lat, lon)`` of a closed ring of ``[lon, lat]`` points, reckoned from its first point."""
    x0, y0 = F.get(F.get(ring, F.lit(0)), F.lit(0)), F.get(F.get(ring, F.lit(0)), F.lit(1))
    x = lambda i: F.get(F.get(ring, i), F.lit(0)) - x0
    y = lambda i: F.get(F.get(ring, i), F.lit(1)) - y0
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def step(acc: Column, i: Column) -> Column:
        cross = x(i) * y(i + 1) - x(i + 1) * y(i)
        return F.struct((acc["a"] + cross).alias("a"), (acc["x"] + (x(i) + x(i + 1)) * cross).alias("x"), (acc["y"] + (y(i) + y(i + 1)) * cross).alias("y"))

    return F.aggregate(F.sequence(F.lit(0), F.size(ring) - 2), zero, step, lambda t: F.struct((y0 + t["y"] / (3 * t["a"])).alias("lat"), (x0 + t["x"] / (3 * t["a"])).alias("lon")))


def shape_points(features: DataFrame, name: Column) -> DataFrame:
    """Points as they are and centroids of polygons' outer rings, from ``geometry`` as (``type``, JSON ``coordinates``)."""
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    point, rings = F.from_json(text, "array<double>"), F.from_json(text, "array<array<array<double>>>")
    centre = ring_centroid(F.get(rings, F.lit(0)))
    at = F.when(kind == "Point", F.struct(F.get(point, F.lit(1)).alias("lat"), F.get(point, F.lit(0)).alias("lon"))).when(kind == "Polygon", centre)
    checked = F.coalesce(at, F.raise_error(F.concat(F.lit("geometry of type "), F.coalesce(kind, F.lit("none")))).cast("struct<lat: double, lon: double>"))
    rows = features.select(name.alias("name"), checked.alias("at"))
    return _stops(rows, F.col("name"), F.col("at.lat"), F.col("at.lon"))


def _candidates(rows: DataFrame, names: Column, lat: Column, lon: Column, town: Column, country: Column, kind: Column, source: str, *more: str) -> DataFrame:
    out = rows.select(*more, names.alias("names"), lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude"), town.alias("municipality"), country.alias("country"), kind.alias("kind"), F.lit(source).alias("source"))
    return out.filter((F.size("names") > 0) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def map_elements(elements: DataFrame, municipality: Column, country: Column) -> DataFrame:
    """Candidates of map elements (``ELEMENT``); the two columns stand in where tags say nothing."""
    tag = lambda k: F.col("tags")[k]
    other = F.filter(F.transform(F.split(F.coalesce(tag("alt_name"), F.lit("")), ";"), lambda n: F.trim(n)), lambda n: n != "")
    names = F.concat(F.array_compact(F.array(*[_some(tag(k)) for k in NAME_TAGS])), other)
    lat, lon = (F.when(F.col("center").isNotNull(), F.col(f"center.{c}")).otherwise(F.col(c)) for c in ("lat", "lon"))
    town = F.coalesce(*[_some(tag(k)) for k in TOWN_TAGS], municipality)
    return _candidates(elements, names, lat, lon, town, F.coalesce(tag("addr:country"), tag("is_in:country_code"), country), F.lit("stop"), "osm", "id")


def search_places(items: DataFrame, is_stop: Column) -> DataFrame:
    """Candidates of search results (``PLACE``) beside the stop's own ``municipality`` and ``country``."""
    names = F.array_distinct(F.filter(F.concat(F.array("name"), F.coalesce(F.map_values("namedetails"), F.array().cast("array<string>"))), lambda n: F.coalesce(n, F.lit("")) != ""))
    shown = F.contains(normalize_text(F.coalesce("display_name", F.lit(""))), normalize_text(F.col("municipality")))
    town = F.coalesce(*[_some(F.col("address")[k]) for k in TOWN_FIELDS], F.when(shown, F.col("municipality")), F.lit(""))
    return _candidates(items, names, F.col("lat"), F.col("lon"), town, F.coalesce(F.col("address")["country_code"], "country"), F.when(is_stop, "stop").otherwise("poi"), "nominatim-search")


def ranked_entities(answers: DataFrame, most: int = 10) -> DataFrame:
    """Candidates of the first ``most`` entities (``items``, see ``ENTITIES``) of each ``query``, with their rank."""
    rows = answers.select("query", F.posexplode(F.slice("items", 1, most)).alias("rank", "e"))
    part = lambda kind, field: F.coalesce(F.get(F.filter("e.regionalStructure", lambda p: p["type"] == kind), F.lit(0))[field], F.lit(""))
    is_stop = normalize_text(F.coalesce("e.label", F.lit(""))).rlike("|".join(STOP_WORDS))
    return _candidates(rows, F.array(F.coalesce("e.name", F.lit(""))), F.col("e.position.lat"), F.col("e.position.lon"), part("regional.municipality", "name"), part("regional.country", "isoCode"), F.when(is_stop, "stop").otherwise("poi"), "mapy", "query", "rank")


def sole_answers(results: DataFrame, keys: list[str]) -> DataFrame:
    """The result of each key that has exactly one."""
    values = [c for c in results.columns if c not in keys]
    return results.groupBy(*keys).agg(F.count(F.lit(1)).alias("n__"), *[F.first(c).alias(c) for c in values]).filter("n__ = 1").drop("n__")


def latest_edition(links: DataFrame) -> DataFrame:
    """The link published last, by ``published`` as day.month.year and time; of equal ones the greatest."""
    return links.agg(F.max(F.struct(F.to_timestamp("published", "d.M.yyyy H:m:s").alias("at"), "href"))["href"].alias("href"))


def cleaned_points(features: DataFrame, fields: list[str]) -> DataFrame:
    """Stops of one region's feature service: numbers before names and notes after them go, with blank names and its misplaced stop."""
    rows = feature_points(features, fields).withColumn("name", bare_name(F.col("name")))
    return rows.filter((F.col("name") != "") & ~is_misplaced(F.col("name"), F.col("latitude"), F.col("longitude")))


def cached_answers(spark: SparkSession, folder: str, boxes: DataFrame, only_cached: bool = True) -> DataFrame:
    """``boxes`` (box, ...) with their stored answer (``elements``): each file of ``folder`` holds a box and its answer.

    A box without an answer is an error if only stored ones may be used, else its elements are null.
    """
    stored = spark.read.schema(f"box string, elements array<struct<{ELEMENT_FIELDS}>>").json(folder)
    found = boxes.join(stored.dropDuplicates(["box"]), "box", "left")
    if not only_cached:
        return found
    missing = F.raise_error(F.concat(F.lit("no stored answer for "), "box")).cast("boolean")
    return found.filter(F.when(F.col("elements").isNotNull(), True).otherwise(missing))


#: Stop readers by name, each a function of its snapshot.
READERS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (feature_points, feed_stops, bus_stops, board_stops, map_stops, station_stops, short_stops, group_stops, packed_stops, shape_points, cleaned_points)}


def sources(snapshots: dict[str, tuple[str, Callable[[], DataFrame], dict]]) -> dict[str, Callable[[], DataFrame]]:
    """Named sources for ``sinks.write_all``: of each name the reader (see ``READERS``), what gives its snapshot, and options."""
    unknown = sorted({reader for reader, _, _ in snapshots.values()} - READERS.keys())
    if unknown:
        raise ValueError(f"unknown readers: {', '.join(unknown)}")
    return {name: (lambda reader=reader, make=make, options=options: READERS[reader](make(), **options)) for name, (reader, make, options) in snapshots.items()}
