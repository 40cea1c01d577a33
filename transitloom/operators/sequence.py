"""Operators on the calls of trips: runs of unresolved places, timed anchors, route contexts.

``calls`` have columns trip, ord (a total order within the trip), place and target
(whether the place is unresolved); trips are told by key, not by the rows' order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def collapse(calls: DataFrame) -> DataFrame:
    """Drop calls at the place of the call before; drop trips with fewer than two places."""
    w = Window.partitionBy("trip").orderBy("ord")
    n = F.size(F.collect_set("place").over(Window.partitionBy("trip")))
    return calls.withColumns({"before": F.lag("place").over(w), "places": n}).filter("places >= 2 and (before is null or before <> place)").drop("before", "places")


def runs(calls: DataFrame) -> DataFrame:
    """Collapsed calls with ``run`` (length of the maximal run of targets they lie in, 0 for others) and ``terminus``."""
    w, whole = Window.partitionBy("trip").orderBy("ord"), Window.partitionBy("trip")
    flat = collapse(calls).withColumns({"n": F.row_number().over(w), "total": F.count(F.lit(1)).over(whole)})
    island = flat.withColumn("island", F.col("n") - F.row_number().over(Window.partitionBy("trip", "target").orderBy("ord")))
    size = F.when(F.col("target"), F.count(F.lit(1)).over(Window.partitionBy("trip", "target", "island"))).otherwise(0)
    return island.withColumns({"run": size, "terminus": (F.col("n") == 1) | (F.col("n") == F.col("total"))}).drop("n", "total", "island")


def impacts(calls: DataFrame) -> DataFrame:
    """For each unresolved place its longest run, whether it ends a trip, and the trips that call there."""
    return runs(calls).filter("target").groupBy("place").agg(F.max("run").alias("max_run"), F.bool_or("terminus").alias("terminus"), F.countDistinct("trip").alias("trips"))


def anchors(calls: DataFrame) -> DataFrame:
    """For each target call the nearest calls before and after with ``anchor`` set and a time not beyond its own.

    ``minutes`` is a call's time. An anchor whose time runs the wrong way is passed
    over and the search goes on outward. Where a trip's times never run back the nearest
    anchor is the one; only other trips have all their anchors gathered and searched.
    """
    w = Window.partitionBy("trip").orderBy("ord")
    back, ahead = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    timed = F.col("minutes").isNotNull()
    late = F.max("minutes").over(back) > F.col("minutes")
    runs_back = F.bool_or(F.coalesce("late", F.lit(False))).over(Window.partitionBy("trip"))
    rows = calls.withColumn("late", late).withColumn("astray", runs_back).drop("late")
    point = F.when(F.col("anchor") & timed, F.struct("ord", "place", "minutes"))
    wanted = F.col("target") & timed
    straight = rows.filter("not astray").withColumns({"previous": F.last(point, True).over(back), "following": F.first(point, True).over(ahead)}).filter(wanted)
    gathered = rows.filter("astray").withColumns({"back": F.collect_list(point).over(back), "ahead": F.collect_list(point).over(ahead)}).filter(wanted)
    searched = gathered.withColumns(
        {
            "previous": F.try_element_at(F.filter("back", lambda a: a["minutes"] <= F.col("minutes")), F.lit(-1)),
            "following": F.try_element_at(F.filter("ahead", lambda a: a["minutes"] >= F.col("minutes")), F.lit(1)),
        }
    ).drop("back", "ahead")
    return straight.unionByName(searched).drop("astray")


def contexts(anchored: DataFrame) -> DataFrame:
    """Calls of one place between equal anchors at equal distances, counted, with the first trip as a sample.

    ``anchored`` are the anchors of collapsed calls; a call without any says nothing and is left out.
    """
    keyed = anchored.filter("previous is not null or following is not null").select(
        "place", "trip", "ord", F.col("previous.place").alias("prev_place"), (F.col("minutes") - F.col("previous.minutes")).alias("prev_minutes"),
        F.col("following.place").alias("next_place"), (F.col("following.minutes") - F.col("minutes")).alias("next_minutes"),
    )
    return keyed.groupBy("place", "prev_place", "prev_minutes", "next_place", "next_minutes").agg(F.count(F.lit(1)).alias("occurrences"), F.min_by("trip", F.struct("trip", "ord")).alias("sample_trip"))


def occurrences(calls: DataFrame) -> DataFrame:
    """``(place, occurrences)`` of the collapsed target calls, with or without a time."""
    return collapse(calls).filter("target").groupBy("place").agg(F.count(F.lit(1)).alias("occurrences"))
