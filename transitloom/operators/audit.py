"""The audit of stops without a sure place, and the work list of those that kept routes still call at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.functions.country import home_or
from transitloom.functions.geo import spread_metres
from transitloom.functions.ids import place_number, trip_parts
from transitloom.functions.text import identity_text, short_id, stage_of

from . import sequence

#: Metres from their mean within which all points of a name must lie to be one place.
COMPACT = 1_000.0
FALLBACK = "open-catalogue>OSM>Mapy>town>unresolved"


def targets(places: DataFrame, impacts: DataFrame, wanted: list[str], least_run: int | None = None, termini: bool = False) -> DataFrame:
    """Places(stop_id, precision) of a wanted precision that trips call at, with their impact (see ``sequence.impacts``).

    With ``least_run`` or ``termini`` only those in so long a run of unresolved calls, or that end a trip.
    """
    found = places.filter(F.col("precision").isin(wanted)).join(impacts.withColumnRenamed("place", "stop_id"), "stop_id")
    if least_run is None and not termini:
        return found
    long_run = F.col("max_run") >= least_run if least_run is not None else F.lit(False)
    return found.filter(long_run | (F.col("terminus") & F.lit(termini)))


def timetable_stop(stops: DataFrame, timetable: DataFrame) -> DataFrame:
    """``stops`` with the columns of their timetable stop (number, ...), by the number in ``stop_id``; one without any is an error."""
    joined = stops.withColumn("number__", place_number(F.col("stop_id"))).join(timetable.withColumn("known__", F.lit(True)), F.col("number__") == F.col("number"), "left")
    sound = F.when(F.col("known__"), F.col("stop_id")).otherwise(F.raise_error(F.concat(F.lit("no timetable stop for "), F.col("stop_id"))).cast("string"))
    return joined.withColumn("stop_id", sound).drop("number__", "known__")


def trip_routes(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """``(trip, route_id, route_name)`` of trips(trip_id, route_id); a route's long name, else its short one, else nothing."""
    blank = lambda c: F.nullif(F.coalesce(F.col(c), F.lit("")), F.lit(""))
    names = routes.select("route_id", F.coalesce(blank("route_long_name"), blank("route_short_name"), F.lit("")).alias("route_name"))
    return trips.select(F.col("trip_id").alias("trip"), "route_id").join(names, "route_id", "left").withColumn("route_name", F.coalesce("route_name", F.lit("")))


def joined(values: Column) -> Column:
    """Distinct values in order, joined by semicolons."""
    return F.array_join(F.array_sort(F.collect_set(values)), ";")


def audit(calls: DataFrame, places: DataFrame, timetable: DataFrame, trips: DataFrame, routes: DataFrame, wanted: list[str], least_run: int | None = None, termini: bool = False) -> DataFrame:
    """The audit's sixteen columns for each selected place, by ``stop_id``.

    ``calls``: trip, ord, place, minutes; ``places``: stop_id, precision, source, lat,
    lon ((0, 0) is no place); ``timetable``: number, name, municipality, region,
    country. Anchors are places of another precision.
    """
    at = places.select(F.col("stop_id").alias("place"), "precision", F.when((F.col("lat") != 0) | (F.col("lon") != 0), F.struct("lat", "lon")).alias("at"))
    known = calls.join(at, "place", "left").withColumns({"target": F.coalesce(F.col("precision").isin(wanted), F.lit(False)), "anchor": F.coalesce((F.col("precision") == "stop") & F.col("at").isNotNull(), F.lit(False))}).drop("precision", "at")
    flat = sequence.collapse(known)
    chosen = timetable_stop(targets(places, sequence.impacts(known), wanted, least_run, termini), timetable)
    on = sequence.runs(known).filter("target").select(F.col("place").alias("stop_id"), "trip").distinct().join(trip_routes(trips, routes), "trip")
    routed = on.groupBy("stop_id").agg(joined(F.col("route_id")).alias("route_ids"), joined(F.col("route_name")).alias("route_names"))
    seen = sequence.contexts(sequence.anchors(flat))
    anchor = lambda side: F.when(F.col(f"{side}_place").isNotNull(), F.struct(F.col(f"{side}_place").alias("stop_id"), F.col(f"{side}_minutes").alias("elapsed_minutes"), F.col(f"{side}_at.lat").alias("latitude"), F.col(f"{side}_at.lon").alias("longitude")))
    for side in ("prev", "next"):
        seen = seen.join(at.select(F.col("place").alias(f"{side}_place"), F.col("at").alias(f"{side}_at")), f"{side}_place", "left")
    one = F.struct(F.col("sample_trip").alias("sample_trip_id"), anchor("prev").alias("previous"), anchor("next").alias("following"), "occurrences")
    told = seen.groupBy(F.col("place").alias("stop_id")).agg(F.to_json(F.array_sort(F.collect_list(one)), {"ignoreNullFields": "false"}).alias("route_contexts"))
    counted = sequence.occurrences(known).withColumnRenamed("place", "stop_id")
    out = chosen.join(counted, "stop_id", "left").join(routed, "stop_id", "left").join(told, "stop_id", "left")
    placed = (F.col("lat") != 0) | (F.col("lon") != 0)
    return out.select(
        "stop_id", "name", "municipality", "region", "country", F.col("precision").alias("coordinate_status"), F.when(placed, F.col("lat")).alias("current_latitude"), F.when(placed, F.col("lon")).alias("current_longitude"),
        F.coalesce("source", F.lit("")).alias("coordinate_source"), F.coalesce("occurrences", F.lit(0)).alias("route_occurrences"), F.col("max_run").alias("maximum_consecutive_unresolved"), F.col("terminus").alias("unresolved_terminus"),
        F.col("trips").alias("affected_trip_count"), F.coalesce("route_ids", F.lit("")).alias("route_ids"), F.coalesce("route_names", F.lit("")).alias("route_names"), F.coalesce("route_contexts", F.lit("[]")).alias("route_contexts"),
    )


def kept_routes(calls: DataFrame, unresolved: DataFrame, decisions: DataFrame) -> DataFrame:
    """``(stop_id, route, distinction)``: kept routes whose trips call at an unresolved stop.

    ``calls``: trip_id, stop_id; ``decisions``: route, distinction, keep; a trip id of another form counts nowhere.
    """
    on = calls.join(unresolved.select("stop_id").distinct(), "stop_id", "left_semi").withColumn("t", trip_parts(F.col("trip_id"))).filter("t is not null")
    on = on.select("stop_id", "t.route", "t.distinction").distinct()
    return on.join(decisions.filter("keep").select("route", "distinction"), ["route", "distinction"], "left_semi").select("stop_id", "route", "distinction")


def region_now(c: Column) -> Column:
    """The region's code today for one that has an older code."""
    region = F.trim(F.coalesce(c, F.lit("")))
    return F.when(region == "OL", "OC").otherwise(region)


def covered(rows: DataFrame, points: DataFrame) -> DataFrame:
    """``(stop_id)`` of rows(stop_id, name, region, country) that a catalogue's points(name, region, country, lat, lon) place.

    Points of the same name and country count, of the same region unless either has
    none, and all of them must lie close to their mean. Rows and points meet in their
    sums by name, country and region; a name's regions are few, so no name is multiplied by its points twice.
    """
    key = lambda: [identity_text(F.col("name")).alias("k_name"), home_or(F.col("country")).alias("k_land"), region_now(F.col("region")).alias("k_region")]
    asked = rows.select("stop_id", *key())
    want = asked.select("k_name", "k_land", "k_region").distinct()
    have = points.select(*key(), "lat", "lon").withColumnRenamed("k_region", "p_region")
    fits = (F.col("k_region") == "") | (F.col("p_region") == "") | (F.col("k_region") == F.col("p_region"))
    sums = have.groupBy("k_name", "k_land", "p_region").agg(F.sum("lat").alias("lat"), F.sum("lon").alias("lon"), F.count(F.lit(1)).alias("n"))
    mean = want.join(sums, ["k_name", "k_land"]).filter(fits).groupBy("k_name", "k_land", "k_region").agg((F.sum("lat") / F.sum("n")).alias("m_lat"), (F.sum("lon") / F.sum("n")).alias("m_lon"))
    far = mean.join(have, ["k_name", "k_land"]).filter(fits).groupBy("k_name", "k_land", "k_region").agg(F.max(spread_metres(F.col("lat"), F.col("lon"), F.col("m_lat"), F.col("m_lon"))).alias("spread"))
    return asked.join(far.filter(F.col("spread") < COMPACT), ["k_name", "k_land", "k_region"], "left_semi").select("stop_id").distinct()


def work_list(unresolved: DataFrame, kept: DataFrame, routes: DataFrame, done: DataFrame) -> DataFrame:
    """One row for each identity of unresolved stops(stop_id, ord, name, municipality, region, country) that kept routes call at.

    ``kept`` as from ``kept_routes``; ``routes``: route, distinction, name; ``done``: stop ids that need no work.
    """
    left = unresolved.join(kept.select("stop_id").distinct(), "stop_id", "left_semi").join(done, "stop_id", "left_anti")
    keys = [identity_text(F.col("name")).alias("k_name"), home_or(F.col("country")).alias("k_land"), identity_text(F.col("municipality")).alias("k_town"), F.trim("region").alias("k_region")]
    keyed = left.select("*", *keys)
    named = ["k_name", "k_land", "k_town", "k_region"]
    people = keyed.groupBy(*named).agg(F.min_by(F.struct("name", "municipality", "region"), "ord").alias("r"), joined(F.col("stop_id")).alias("stop_ids"))
    way = F.struct("route", "distinction")
    ways = keyed.select("stop_id", *named).join(kept, "stop_id").join(routes.withColumnRenamed("name", "route_name"), ["route", "distinction"]).groupBy(*named).agg(
        F.array_join(F.transform(F.array_sort(F.collect_set(way)), lambda w: F.concat(w["route"], F.lit("/"), w["distinction"].cast("string"))), ";").alias("route_distinctions"), joined(F.col("route_name")).alias("route_names")
    )
    return people.join(ways, named).select(
        short_id(*map(F.col, named)).alias("identity_id"), "r.name", "r.municipality", "r.region", F.col("k_land").alias("country"), "stop_ids", "route_distinctions", "route_names",
        stage_of(F.col("r.name"), F.col("k_land")).alias("stage"), F.lit(FALLBACK).alias("fallback_order"), F.struct("k_land", "k_name", "k_town", "k_region").alias("order"),
    )


def summary(rows: DataFrame) -> DataFrame:
    """One row: identities, stops, and counts by country and by stage as maps."""
    by = lambda c: rows.groupBy(c).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias(f"by_{c}"))
    total = rows.agg(F.count(F.lit(1)).alias("identities"), F.coalesce(F.sum(F.size(F.split("stop_ids", ";"))), F.lit(0)).alias("stops"))
    return total.join(F.broadcast(by("country"))).join(F.broadcast(by("stage")))
