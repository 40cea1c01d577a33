"""Route policy: which cross-border routes stay, by countries, distances and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Limits in kilometres for integrated and other routes: whole trip, depth abroad.
SPAN, DEPTH = (200, 120), (80, 60)


def trip_metrics(calls: DataFrame, home: str = "CZ") -> DataFrame:
    """Per route and trip: calls at home and abroad, missing kilometres, span, and the farthest call abroad from home calls.

    ``calls`` has route, trip, country (null if unknown) and km.
    """
    by_km = Window.partitionBy("route", "trip").orderBy("km")
    inner = F.when(F.col("country") == home, F.col("km"))
    # of the home calls only the next ones down and up the line can be nearest
    below = F.last(inner, True).over(by_km.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(inner, True).over(by_km.rowsBetween(0, Window.unboundedFollowing))
    away = calls.withColumn("away", F.when(F.col("country") != home, F.least(F.col("km") - below, above - F.col("km"))))
    return away.groupBy("route", "trip").agg(
        F.count_if(F.col("country") == home).alias("n_home"),
        F.count_if(F.col("country") != home).alias("n_foreign"),
        F.count_if(F.col("km").isNull()).alias("n_missing"),
        (F.max("km") - F.min("km")).alias("span"),
        F.max("away").alias("depth"),
    )


def classify(calls: DataFrame, routes: DataFrame, adjacent: list[str], declared: list[str], home: str = "CZ") -> DataFrame:
    """``(route, keep, reason, countries, maximum_span, maximum_depth)`` by the first rule that applies.

    ``routes`` has route, kind and integrated.
    """
    trips = trip_metrics(calls, home).filter("n_foreign > 0").groupBy("route").agg(
        F.bool_or(F.col("n_home") == 0).alias("foreign_only"), F.bool_or(F.col("n_missing") > 0).alias("missing"), F.max("span").alias("maximum_span"), F.max("depth").alias("maximum_depth")
    )
    facts = calls.groupBy("route").agg(F.array_sort(F.collect_set("country")).alias("countries"), F.bool_or(F.col("country").isNull()).alias("unknown"))
    all_ = routes.join(facts, "route", "left").join(trips, "route", "left").withColumn("countries", F.coalesce("countries", F.array().cast("array<string>")))
    foreign = F.filter("countries", lambda c: c != home)
    limit = lambda pair: F.when(F.col("integrated"), pair[0]).otherwise(pair[1])
    reason = (
        F.when((F.size(foreign) == 0) & ~F.col("kind").isin(declared), "domestic")
        .when(F.size(foreign) == 0, "international_metadata_without_foreign_geography")
        .when(F.col("unknown"), "unknown_stop_country")
        .when(F.size(F.array_except(foreign, F.array(*map(F.lit, adjacent)))) > 0, "non_adjacent_country")
        .when(F.col("foreign_only"), "foreign_only_trip")
        .when(F.col("missing"), "missing_timetable_kilometres")
        .when(F.col("maximum_span") > limit(SPAN), "trip_span_exceeds_limit")
        .when(F.col("maximum_depth") > limit(DEPTH), "foreign_depth_exceeds_limit")
        .otherwise("regional_adjacent")
    )
    measured = F.col("reason").isin("trip_span_exceeds_limit", "foreign_depth_exceeds_limit", "regional_adjacent")
    out = all_.withColumn("reason", reason)
    return out.select(
        "route", F.col("reason").isin("domestic", "regional_adjacent").alias("keep"), "reason", F.array_join("countries", ";").alias("countries"),
        F.when(measured, F.col("maximum_span")).alias("maximum_span"), F.when(measured, F.col("maximum_depth")).alias("maximum_depth"),
    )
