"""Which of a stop's candidates is the stop: filters of place and route, and the cascade of choices.

``pairs`` have a stop's columns (stop, name, municipality, region, country,
estimated boolean, own_lat, own_lon, contexts array of struct(previous, following) with
anchors struct(minutes, lat, lon)) beside those of a candidate (ord, the order of
a stop's candidates, names array, lat, lon, c_municipality, c_region, c_country, kind, rank).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.functions.country import home_or
from transitloom.functions.geo import distance_metres, travel_budget
from transitloom.functions.text import components, municipality_text, normalize_text, stop_identities, suffix_identities, token_variants
from transitloom.plans.tables import written

from . import match

#: Metres from an estimate within which a stop without anchors may lie, and within which a like name suffices; that likeness.
NEAR_ESTIMATE, NEAR_ALIAS, ALIAS_SCORE = 2_000.0, 5_000.0, 0.75


def country_matches(expected: Column, actual: Column) -> Column:
    """Equal countries; none is the home country."""
    return home_or(expected) == home_or(actual)


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _towns(name: Column) -> Column:
    return F.transform(components(_blank(name)), municipality_text)


def _expected(name: Column, municipality: Column) -> Column:
    return municipality_text(F.coalesce(F.nullif(_blank(municipality), F.lit("")), F.get(F.split(_blank(name), ","), F.lit(0))))


def _in_town(expected: Column, towns: Column, region: Column, actual: Column, c_towns: Column, c_region: Column) -> Column:
    same_region = (_blank(region) != "") & (_blank(c_region) == _blank(region))
    mentions = F.array_contains(towns, actual) | F.array_contains(c_towns, expected)
    return F.when(expected == "", True).when(actual == "", same_region).otherwise((actual == expected) | mentions)


def municipality_matches(name: Column, municipality: Column, region: Column, names: Column, c_municipality: Column, c_region: Column) -> Column:
    """Does the candidate lie in the stop's municipality, as far as either tells one?

    Without an expected one any does; without the candidate's own the regions
    decide; else they are equal, or either is a part of the other's name.
    """
    return _in_town(_expected(name, municipality), _towns(name), region, municipality_text(_blank(c_municipality)), F.flatten(F.transform(names, _towns)), c_region)


def candidate_identities(names: Column) -> Column:
    """Names by which a candidate may be known: each whole name and every suffix of its parts, their words also sorted."""
    return token_variants(F.array_distinct(F.flatten(F.transform(names, suffix_identities))))


def identities_of(name: Column, municipality: Column) -> Column:
    """Names by which a stop may be known, their words also sorted."""
    return token_variants(stop_identities(name, municipality))


def exact_name(identities: Column, candidate: Column) -> Column:
    """Do the two sets of identities share a name?"""
    return F.arrays_overlap(identities, candidate)


def _anchors(contexts: Column) -> Column:
    none = F.array().cast("array<struct<minutes:double,lat:double,lon:double>>")
    return F.coalesce(F.flatten(F.transform(contexts, lambda c: F.array_compact(F.array(c["previous"], c["following"])))), none)


def _way(estimated: Column, distance: Column, anchors: Column, lat: Column, lon: Column, in_town: Column) -> Column:
    far = F.exists(anchors, lambda a: (a["minutes"] < 0) | (distance_metres(lat, lon, a["lat"], a["lon"]) > travel_budget(a["minutes"])))
    near = F.coalesce(distance <= NEAR_ESTIMATE, F.lit(False)) & in_town
    return (
        F.when(~estimated, "not_estimated").when(far, "route_time_impossible").when(F.size(anchors) > 0, "route_time_feasible")
        .when(near, "estimate_within_2km").otherwise("no_route_context_or_nearby_match")
    )


def route_feasibility(estimated: Column, own_lat: Column, own_lon: Column, contexts: Column, lat: Column, lon: Column, in_town: Column) -> Column:
    """``struct(ok, reason, distance)``: could the routes that call at a stop of estimated place call at the candidate's?

    ``distance``: metres from the estimate, null without one. Every anchor must be
    within what a vehicle can go in its time; without anchors the candidate must
    be near the estimate and in the town.
    """
    distance = distance_metres(own_lat, own_lon, lat, lon)
    reason = _way(estimated, distance, _anchors(contexts), lat, lon, in_town)
    return F.struct((~reason.isin(*_NO_WAY)).alias("ok"), reason.alias("reason"), distance.alias("distance"))


_NO_WAY = ("route_time_impossible", "no_route_context_or_nearby_match")


def _of_stops(rows: DataFrame) -> DataFrame:
    """What a stop's name tells by itself."""
    name, town = F.col("name"), F.col("municipality")
    rows = rows.withColumns({"targets": stop_identities(name, town), "expected__": _expected(name, town), "towns__": _towns(name)})
    return rows.withColumn("known_as__", token_variants(F.col("targets")))


def _of_candidates(rows: DataFrame) -> DataFrame:
    """What a candidate's names tell by themselves."""
    names = F.col("names")
    return rows.withColumns({"normal_names": F.transform(names, normalize_text), "actual__": municipality_text(_blank(F.col("c_municipality"))), "c_towns__": F.flatten(F.transform(names, _towns)), "c_known_as__": candidate_identities(names)})


def _compared(p: DataFrame, region: str, c_region: str) -> DataFrame:
    """In_town, exact and score of ``p``, which has what either side's names tell."""
    town = _in_town(*map(F.col, ("expected__", "towns__", region, "actual__", "c_towns__", c_region)))
    p = p.withColumns({"in_town": town, "exact": exact_name(F.col("known_as__"), F.col("c_known_as__"))})
    return match.with_scores(p, "targets", "normal_names", "score").drop("expected__", "towns__", "known_as__", "actual__", "c_towns__", "c_known_as__")


def _judged(p: DataFrame) -> DataFrame:
    """Accepted, reason and distance of compared pairs with land__, c_land__ and anchors__."""
    p = p.withColumn("distance", distance_metres(*map(F.col, ("own_lat", "own_lon", "lat", "lon"))))
    p = p.withColumn("way__", _way(*map(F.col, ("estimated", "distance", "anchors__", "lat", "lon", "in_town"))))
    way, alike = F.col("way__"), F.coalesce((F.col("distance") <= NEAR_ALIAS) & (F.col("score") >= ALIAS_SCORE), F.lit(False))
    reason = (
        F.when(F.col("kind") != "stop", "not_public_transport_stop").when(F.col("land__") != F.col("c_land__"), "wrong_country")
        .when(way.isin(*_NO_WAY), way).when(F.col("in_town"), way)
        .when(F.col("estimated") & F.col("exact"), "route_exact_locality_alias").when(F.col("estimated") & alike, "route_fuzzy_locality_alias").otherwise("municipality_mismatch")
    )
    left_out = ("not_public_transport_stop", "wrong_country", "municipality_mismatch", *_NO_WAY)
    measured = F.when(~F.col("reason").isin("not_public_transport_stop", "wrong_country"), F.col("distance"))
    return p.withColumn("reason", reason).withColumns({"accepted": ~F.col("reason").isin(*left_out), "distance": measured}).drop("way__", "anchors__", "land__", "c_land__")


def assess(pairs: DataFrame) -> DataFrame:
    """``pairs`` with targets, normal_names, in_town, exact, score, accepted, reason and distance.

    A candidate must be a stop, of the country, feasible by route and in the town;
    for a stop of estimated place the same name, or a like one nearby, stands in
    for the town. Names are scored once for each distinct pair.
    """
    told = {"anchors__": _anchors(F.col("contexts")), "land__": home_or(F.col("country")), "c_land__": home_or(F.col("c_country"))}
    return _judged(_compared(_of_candidates(_of_stops(pairs)), "region", "c_region").withColumns(told))


def exact_candidates(assessed: DataFrame) -> DataFrame:
    """The rows among which the exact choice is made: accepted stops of the same name, in the town or of estimated place."""
    return assessed.filter(F.col("accepted") & F.col("exact") & (F.col("in_town") | F.col("estimated")))


def resolve(stops: DataFrame, assessed: DataFrame, fuzzy: float | None = None) -> DataFrame:
    """``(stop, lat, lon, by, reason, candidates)`` of every row of ``stops(stop)``.

    The exact choice comes first, then (with a threshold ``fuzzy``) the fuzzy one,
    then for stops of estimated place the one that routes support. A stop left open
    has a reason: no candidate, none plausible, or none that stands out.
    """
    plausible = assessed.filter("accepted")
    # no filter of the places: it would work the clusters out again for each of its conditions
    exact = match.exact_choice(exact_candidates(assessed)).select("stop", F.when(F.col("lat").isNotNull(), F.struct("lat", "lon")).alias("x"))
    near = match.route_supported(plausible.filter("estimated"), scored=True).select("stop", F.struct("lat", "lon").alias("r"))
    counts = assessed.groupBy("stop").agg(F.count(F.lit(1)).alias("candidates"), F.count_if("accepted").alias("plausible"))
    out = stops.select("stop").distinct().join(counts, "stop", "left").join(exact, "stop", "left").join(near, "stop", "left")
    z = F.lit(None).cast("struct<lat: double, lon: double>")
    if fuzzy is not None:
        out = out.join(match.fuzzy(plausible.filter("in_town"), fuzzy, scored=True).select("stop", F.struct("lat", "lon").alias("f")), "stop", "left")
    else:
        out = out.withColumn("f", z)
    at = F.coalesce("x", "f", "r")
    by = F.when(F.col("x").isNotNull(), "exact").when(F.col("f").isNotNull(), "fuzzy").when(F.col("r").isNotNull(), "route")
    n = F.coalesce("candidates", F.lit(0))
    reason = F.when(at.isNotNull(), F.lit(None)).when(n == 0, "not_found").when(F.col("plausible") == 0, "geography_rejected").otherwise("ambiguous_or_weak_name")
    return out.select("stop", at["lat"].alias("lat"), at["lon"].alias("lon"), by.alias("by"), reason.alias("reason"), n.alias("candidates"))


def _keyed(stops: DataFrame, candidates: DataFrame, country: str) -> tuple[DataFrame, DataFrame]:
    key = lambda town, land, region: {"k_land": home_or(F.col(land)), "k_town": normalize_text(_blank(F.col(town))), "k_region": _blank(F.col(region))}
    return stops.withColumns(key("municipality", "country", "region")), candidates.withColumns(key("c_municipality", country, "c_region"))


_KEYS = ("k_land", "k_town", "k_region")


def candidates_of(stops: DataFrame, candidates: DataFrame) -> DataFrame:
    """``pairs``: each stop with the candidates of its municipality, by country, normalized municipality and region."""
    left, right = _keyed(stops, candidates, "c_country")
    return left.join(right, [*_KEYS]).drop(*_KEYS)


def assess_candidates(stops: DataFrame, candidates: DataFrame, country: str = "c_country") -> DataFrame:
    """``assess(candidates_of(stops, candidates))``; ``country``: the candidates' column by which countries meet.

    What names tell is worked out once for each distinct name of a municipality, and names are
    compared once for each distinct pair there; stops and candidates then meet on these pairs.
    """
    left, right = _keyed(stops, candidates, country)
    left = left.withColumns({"s_key__": F.struct(*_KEYS, "name", "municipality"), "anchors__": _anchors(F.col("contexts")), "land__": home_or(F.col("country"))})
    right = right.withColumns({"c_key__": F.struct(*_KEYS, "names", "c_municipality"), "c_land__": home_or(F.col("c_country"))})
    s, c = left.select(*_KEYS, "s_key__", "name", "municipality").distinct(), right.select(*_KEYS, "c_key__", "names", "c_municipality").distinct()
    both = _compared(_of_stops(s).join(_of_candidates(c), [*_KEYS]), "k_region", "k_region").select("s_key__", "c_key__", "targets", "normal_names", "in_town", "exact", "score")
    # by sorted ranges of keys: all tasks share the pairs, however small the tables are
    met = left.drop(*_KEYS).join(both, "s_key__").hint("merge").join(right.drop(*_KEYS), "c_key__")
    return _judged(met).drop("s_key__", "c_key__")


def resolve_candidates(stops: DataFrame, candidates: DataFrame, fuzzy: float | None = None, country: str = "c_country") -> DataFrame:
    """``resolve`` of all stops among the candidates of their municipality.

    Where a stop's place is known its routes and place decide nothing, so of such stops with
    one name, municipality, region and country one is resolved, and all share its result.
    """
    name = ("name", "municipality", "region", "country")
    once = stops.groupBy("stop").agg((F.count(F.lit(1)) == 1).alias("once__"))
    rows = stops.join(once, "stop", "left").withColumn("alike__", F.coalesce(~F.col("estimated") & F.col("once__"), F.lit(False))).drop("once__")
    alike = rows.filter("alike__").select("stop", F.struct(*name).alias("like__"))
    first = alike.groupBy("like__").agg(F.min("stop").alias("first__"))
    own = rows.filter("not alike__").drop("alike__")
    none = lambda c: F.lit(None).cast(stops.schema[c].dataType).alias(c)
    one = first.select(F.col("first__").alias("stop"), *[F.col(f"like__.{c}").alias(c) for c in name], F.lit(False).alias("estimated"), *[none(c) for c in ("own_lat", "own_lon", "contexts")])
    some = own.select(*one.columns).unionByName(one)
    told = ("ord", "lat", "lon", "rank", "in_town", "exact", "estimated", "score", "own_lat", "own_lon")  # nothing else of a pair counts
    pairs = written(assess_candidates(some, candidates, country).select("stop", "accepted", *[F.when(F.col("accepted"), F.col(c)).alias(c) for c in told]), "assessed")
    made = written(resolve(some, pairs, fuzzy), "resolved")
    shared = alike.join(first, "like__").select("stop", "first__").join(made.withColumnRenamed("stop", "first__"), "first__").drop("first__")
    return made.join(own.select("stop").distinct(), made["stop"].eqNullSafe(own["stop"]), "left_semi").unionByName(shared)


def identity_matches(stops: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(stop, cand)``: pairs that share an identity, by an equality join on each name, whatever the place.

    ``stops`` has stop, name, municipality; ``candidates`` has cand, names.
    """
    s = stops.select("stop", F.explode(identities_of(F.col("name"), F.col("municipality"))).alias("identity"))
    c = candidates.select("cand", F.explode(candidate_identities(F.col("names"))).alias("identity"))
    return s.join(c, "identity").select("stop", "cand").distinct()


def municipality_centres(posts: DataFrame, places: DataFrame) -> DataFrame:
    """``(land, town, region, lat, lon)``: the mean of a municipality's posts(number, lat, lon) by places(number, municipality, region, country); (0, 0) is no place."""
    named = places.select("number", home_or(F.col("country")).alias("land"), normalize_text(F.coalesce("municipality", F.lit(""))).alias("town"), F.trim("region").alias("region"))
    placed = posts.filter(~((F.col("lat") == 0) & (F.col("lon") == 0))).join(named, "number")
    return placed.groupBy("land", "town", "region").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def with_centre(stops: DataFrame, centres: DataFrame) -> DataFrame:
    """``stops`` with ``centre_lat, centre_lon``: their own place, else their municipality's centre, else that of the only
    municipality of this name in the country, whatever its region."""
    keyed = stops.withColumns({"land": home_or(F.col("country")), "town": normalize_text(F.coalesce("municipality", F.lit("")))})
    one = centres.groupBy("land", "town").agg(F.count(F.lit(1)).alias("n"), F.first("lat").alias("only_lat"), F.first("lon").alias("only_lon")).filter("n = 1").drop("n")
    own = centres.select("land", "town", "region", F.col("lat").alias("key_lat"), F.col("lon").alias("key_lon"))
    found = keyed.join(own, ["land", "town", "region"], "left").join(one, ["land", "town"], "left")
    has = F.col("own_lat").isNotNull() & F.col("own_lon").isNotNull()
    pick = lambda c: F.when(has, F.col(f"own_{c}")).otherwise(F.coalesce(f"key_{c}", f"only_{c}"))
    return found.withColumns({"centre_lat": pick("lat"), "centre_lon": pick("lon")}).select(*stops.columns, "centre_lat", "centre_lon")
