"""An append-only registry of identifiers: checks as rows, and stable allocation of new identifiers."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitloom.functions.geo import distance_metres
from transitloom.functions.text import normalize_component
from transitloom.plans.tables import numbered, written


def problems(stops: DataFrame) -> DataFrame:
    """``(check, id)`` for stops(id, key, lat, lon, merged_into): bad coordinates, repeated ids, dangling, self and chained merges."""
    bad = stops.filter(~F.coalesce(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180), F.lit(False))).select(F.lit("coordinates").alias("check"), "id")
    twice = stops.groupBy("id").count().filter("count > 1").select(F.lit("repeated id").alias("check"), "id")
    moved = stops.filter("merged_into is not null")
    dangling = moved.join(stops.select(F.col("id").alias("merged_into")), "merged_into", "left_anti").select(F.lit("missing target").alias("check"), "id")
    own = moved.filter("merged_into = id").select(F.lit("merged into itself").alias("check"), "id")
    chain = moved.filter("merged_into <> id").join(moved.select(F.col("id").alias("merged_into")).distinct(), "merged_into", "left_semi").select(F.lit("chain").alias("check"), "id")
    return bad.unionByName(twice).unionByName(dangling).unionByName(own).unionByName(chain)


#: Metres from which stops of one key are different stops.
DISTINCT = 75.0


def _near(lat: str, lon: str, lat2: str, lon2: str) -> Column:
    metres = distance_metres(F.col(lat), F.col(lon), F.col(lat2), F.col(lon2))
    return F.coalesce(metres < DISTINCT, F.lit(True))  # a stop without a position may be any of its key


def same_place(stops: DataFrame) -> DataFrame:
    """Pairs of different ids of one key that are less than ``DISTINCT`` metres apart."""
    one = stops.groupBy("key", "id").agg(F.min(F.struct("ord", "lat", "lon")).alias("s")).select("key", "id", F.col("s.lat").alias("lat"), F.col("s.lon").alias("lon"))
    other = one.select("key", F.col("id").alias("other"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return one.join(other, "key").filter(F.col("id") < F.col("other")).filter(distance_metres(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) < DISTINCT).select("key", "id", "other")


def reuse(known: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(cand, key, id)``: of the known stops (id, ord, key, lat, lon) of a candidate's key the first within ``DISTINCT`` metres, or null.

    A stop without coordinates on either side counts as near. Candidates: cand, key, lat, lon.
    """
    own = known.select("key", F.col("id"), F.col("ord"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    hit = candidates.join(own, "key").filter(_near("lat", "lon", "lat2", "lon2")).groupBy("cand").agg(F.min(F.struct("ord", "id"))["id"].alias("id"))
    return candidates.select("cand", "key").join(hit, "cand", "left")


def decide(decision: Column, reason: Column, accept_new: bool) -> Column:
    """What is said of a candidate; where nothing is, candidates that are new by ``reason`` are new if they are accepted."""
    said = F.trim(F.coalesce(decision, F.lit("")))
    return F.when((said == "") & F.lit(accept_new) & F.coalesce(reason == "new", F.lit(False)), "new").otherwise(said)


def alias_target(target: Column, suggestion: Column) -> Column:
    """The target that is said, else a suggestion of exactly one."""
    said, other = (F.trim(F.coalesce(c, F.lit(""))) for c in (target, suggestion))
    return F.when((said == "") & ~other.contains(";"), other).otherwise(said)


def table_kind(rows: DataFrame) -> str:
    """``stops``, ``posts`` or ``places`` by a column that only that kind of candidates has."""
    kinds = [kind for kind, column in (("stops", "provisional_id"), ("posts", "post_key"), ("places", "group_key")) if column in rows.columns]
    if not kinds:
        raise ValueError("candidates must have provisional_id, post_key or group_key")
    return kinds[0]


def allocate(known: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(key, id, is_new)``: the smallest known id of a candidate's key, else the next free ids in key order.

    ``known`` has id, key; ``candidates`` has key. New keys are numbered by sorted
    ranges (see ``numbered``), so no task sees all of them, whatever they have in common.
    """
    have = known.groupBy("key").agg(F.min("id").alias("id"))
    want = written(candidates.select("key").distinct().join(have, "key", "left"), "allocate")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    made = numbered(want.filter("id is null").select("key"), ["key"], "place").select("key", (F.col("place") + F.lit(top + 1)).alias("id"), F.lit(True).alias("is_new"))
    return want.filter("id is not null").select("key", "id", F.lit(False).alias("is_new")).unionByName(made)


# Columns that name a stop, states of a row, the form of a post's key and of a merge note.
KEY = ("town", "district", "nearby_place", "okres", "country")
STATUSES = ("active", "retired")
POST_KEY, MERGED = r"^(?:post:[^:\s]+|est:[1-9][0-9]*)$", r"merged_into:([1-9][0-9]*)"
#: Numbers from which ids are provisional.
PROVISIONAL = 1_000_000_000


def _parts() -> Column:
    return F.array(*[normalize_component(F.coalesce(F.col(c), F.lit(""))) for c in KEY])


def _key(rows: DataFrame) -> Column:
    return F.array_join(_parts(), ",")


def _number(c: str) -> Column:
    return F.when(F.trim(c).rlike(r"^[+-]?\d+$"), F.trim(c).cast("long"))


def _point(rows: DataFrame) -> tuple[Column, Column]:
    """``struct(lat, lon)``, null where both are blank; and whether that is sound."""
    lat, lon = F.trim(F.coalesce(F.col("lat"), F.lit(""))), F.trim(F.coalesce(F.col("lon"), F.lit("")))
    both = F.struct(lat.try_cast("double").alias("lat"), lon.try_cast("double").alias("lon"))
    none = (lat == "") & (lon == "")
    return F.when(~none, both), none | (both["lat"].isNotNull() & both["lon"].isNotNull())


def _found(rows: DataFrame, table: str, checks: list[tuple[Column, str]]) -> DataFrame:
    each = F.array_compact(F.array(*[F.when(F.coalesce(wrong, F.lit(False)), F.lit(text)) for wrong, text in checks]))
    return rows.select(F.lit(table).alias("table"), "line", F.explode(each).alias("error"))


def _unsorted(rows: DataFrame, table: str, order: list[Column]) -> DataFrame:
    """One error if a row comes before the one above it. Neighbours are looked at within blocks of lines and across their ends."""
    keyed = rows.select("line", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]).alias("k"))
    below = keyed.select((F.col("line") + 1).alias("line"), F.col("k").alias("above"))
    bad = keyed.join(below, "line").filter("above > k")
    return bad.groupBy().agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(F.lit(table).alias("table"), F.lit(None).cast("long").alias("line"), F.lit("not sorted").alias("error"))


def _twice(rows: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """An error for each row whose key an earlier line has."""
    w = Window.partitionBy(*keys).orderBy("line")
    again = rows.withColumn("n__", F.row_number().over(w)).filter("n__ > 1")
    return again.select(F.lit(table).alias("table"), "line", F.concat(F.lit("duplicate "), F.concat_ws(" ", *keys)).alias("error"))


def validate(stops: DataFrame, posts: DataFrame, places: DataFrame) -> DataFrame:
    """``(table, line, error)`` of a registry, all of whose columns but ``line`` (from 2, consecutive) are text.

    Stops: id, KEY, lat, lon, status, note. Posts: stop_id, post_key, lat, lon,
    status. Places: source_id, group_key, place_id, status. If any stop's own row is
    wrong only such errors are told, as all else would build on it.
    """
    point, sound = _point(stops)
    s = stops.withColumns({"n": _number("id"), "p": point, "sound": sound, "key": _key(stops)})
    out_of_range = ~(F.col("p.lat").between(-90, 90) & F.col("p.lon").between(-180, 180))
    rows = _found(
        s, "stops",
        [
            (F.col("n").isNull(), "id is not an integer"), (~F.col("n").between(1, PROVISIONAL - 1), "id is out of range"), (F.col("n").isNotNull() & (F.trim("town") == ""), "town is required"),
            (F.col("n").isNotNull() & ~F.col("status").isin(*STATUSES), "unknown status"), (F.col("n").isNotNull() & ~F.col("sound"), "coordinates must both be numbers or both empty"), (F.col("n").isNotNull() & F.col("sound") & out_of_range, "coordinates out of range"),
        ],
    )
    gate = rows.isEmpty()
    if not gate:
        return rows
    target = F.nullif(F.regexp_extract("note", MERGED, 1), F.lit("")).cast("long")
    moved = s.withColumn("to", target).filter("to is not null")
    ids, merged = s.select(F.col("n").alias("to")).distinct(), moved.select(F.col("n").alias("to")).distinct().withColumn("moved", F.lit(True))
    told = moved.join(ids.withColumn("known", F.lit(True)), "to", "left").join(merged, "to", "left")
    wrong = F.col("known").isNull() | (F.col("to") == F.col("n"))
    merges = _found(told, "stops", [(wrong, "merged into no other id"), (~wrong & F.col("moved").isNotNull(), "merged into a merged id")])
    first = s.groupBy("key", "n").agg(F.min_by(F.struct("line", "p"), "line").alias("f")).select("key", "n", "f.*")
    several = first.groupBy("key").agg(F.count(F.lit(1)).alias("ids"), F.min("line").alias("line"), F.bool_or(F.col("p").isNull()).alias("bare")).filter("ids > 1")
    unplaced = _found(several, "stops", [(F.col("bare"), "several ids without coordinates for each")])
    # stops nearer than DISTINCT lie in one cell of that height or in neighbouring ones
    cell = F.floor(F.col("p.lat") * 111320 / DISTINCT)
    placed = first.join(several.filter("not bare").select("key"), "key", "left_semi").withColumn("cell", cell)
    other = placed.select("key", F.col("n").alias("m"), F.col("p").alias("q"), F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"))
    close = placed.join(other, ["key", "cell"]).filter(F.col("n") < F.col("m")).filter(distance_metres(F.col("p.lat"), F.col("p.lon"), F.col("q.lat"), F.col("q.lon")) < DISTINCT)
    near = close.select(F.lit("stops").alias("table"), "line", F.concat(F.lit("too close to id "), F.col("m").cast("string")).alias("error")).distinct()
    q_point, q_sound = _point(posts)
    q = posts.withColumns({"n": F.when(F.col("stop_id").rlike("^[0-9]+$"), F.col("stop_id").cast("long")), "p": q_point, "sound": q_sound})
    q = q.join(ids.withColumnRenamed("to", "n").withColumn("known", F.lit(True)), "n", "left")
    q_rows = _found(
        q, "posts",
        [
            (F.col("known").isNull(), "stop is not registered"), (~F.col("post_key").rlike(POST_KEY), "post key must be post:<num> or est:<k>"), (~F.col("status").isin(*STATUSES), "unknown status"),
            (~F.col("sound"), "coordinates must both be numbers or both empty"), (F.startswith("post_key", F.lit("est:")) & (F.col("p").isNull() | ~F.col("sound")), "inferred posts need coordinates"),
        ],
    )
    r_rows = _found(places, "places", [((F.trim("source_id") == "") | (F.col("group_key") == "") | (F.trim("place_id") == ""), "source, group and place are required"), (~F.col("status").isin(*STATUSES), "unknown status")])
    out = merges
    for part in (
        _unsorted(s, "stops", [F.col("n"), _parts(), F.col("lat"), F.col("lon")]), unplaced, near, q_rows, _twice(posts, "posts", ["stop_id", "post_key"]), _unsorted(q.filter("n is not null"), "posts", [F.col("n"), F.col("post_key")]),
        r_rows, _twice(places, "places", ["source_id", "group_key"]), _unsorted(places, "places", [F.col("source_id"), F.col("group_key")]),
    ):
        out = out.unionByName(part)
    return out


_STEP = "seq long, known_id string, new_key string, row_key string, status string"


def _stepwise(rows: pd.DataFrame) -> pd.DataFrame:
    """What becomes of candidates that hang together, in order; ``new_key`` stands for a number that is yet to be given."""
    registered: dict[str, list] = {}
    known, allocated, out = set(), {}, []

    def near(a, b) -> bool:
        if a[0] is None or b[0] is None:
            return True
        east = (a[1] - b[1]) * 111320 * math.cos(math.radians((a[0] + b[0]) / 2))
        return math.hypot((a[0] - b[0]) * 111320, east) < DISTINCT

    for r in rows.sort_values("seq").itertuples(index=False):
        at = (None, None) if r.lat is None or math.isnan(r.lat) else (r.lat, r.lon)
        if r.decision == "registered":
            registered.setdefault(r.key, []).append((at, r.target))
            known.add((r.key, r.target))
            continue
        status = "aliased" if r.decision == "alias" else "added"
        if r.decision == "alias":
            target = r.target
        elif r.provisional and r.provisional in allocated:
            target = allocated[r.provisional]
        else:
            target = next((i for p, i in registered.get(r.key, ()) if near(at, p)), None) or f"new:{r.seq}"
            if r.provisional:
                allocated[r.provisional] = target
        if (r.key, target) in known:
            out.append((r.seq, target, None, r.key, "skipped"))
            continue
        known.add((r.key, target))
        registered.setdefault(r.key, []).append((at, target))
        out.append((r.seq, target, None, r.key, status))
    return pd.DataFrame([(s, None if t.startswith("new:") else t, t[4:] if t.startswith("new:") else None, k, st) for s, t, _, k, st in out], columns=["seq", "known_id", "new_key", "row_key", "status"])


def promote_stops(stops: DataFrame, candidates: DataFrame, accept_new: bool = False) -> DataFrame:
    """``(id, KEY..., lat, lon, note, status, is_new)`` of every candidate that is decided; status: added, aliased or skipped.

    Candidates go in order of their provisional id, key and ``line``. Those of one provisional
    id get one id: that of a stop of the first one's key within ``DISTINCT``
    metres, registered before or by an earlier candidate, else the next free
    number. An alias puts its key on a registered id or on one given before. Only candidates that
    share a key or a provisional id depend on each other; each such set is worked through
    in order on its own, and new numbers are then given by order over all.
    """
    said = decide(F.col("decision"), F.col("reason"), accept_new)
    lat, lon = (F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit("")).cast("double") for c in ("lat", "lon"))
    rows = candidates.withColumns({"key": _key(candidates), "decision": said, "y": lat, "x": lon, "provisional": F.coalesce("provisional_id", F.lit("")), "target": F.when(said == "alias", alias_target(F.col("alias_of"), F.col("alias_of_suggestion")))})
    rows = rows.withColumns({"first__": F.coalesce(F.col("provisional").try_cast("long"), F.lit(0)), "parts__": _parts()}).filter(F.col("decision").isin("new", "alias"))
    rows = written(numbered(rows, ["first__", "parts__", "line"], "seq"), "promote")
    # sets of candidates that share a key or a provisional id: the smallest key that can be reached
    links = rows.filter("provisional <> ''").select("provisional", "key").distinct()
    label = rows.select("key").distinct().withColumn("label", F.col("key"))
    while True:
        low = links.join(label, "key").groupBy("provisional").agg(F.min("label").alias("low"))
        better = links.join(low, "provisional").groupBy("key").agg(F.min("low").alias("low"))
        following = written(label.join(better, "key", "left").select("key", F.least("label", F.coalesce("low", "label")).alias("label")), "promote-sets")
        changed = not following.exceptAll(label).isEmpty()
        label = following
        if not changed:
            break
    point, _ = _point(stops)
    own = stops.withColumns({"key": _key(stops), "p": point})
    before = own.join(rows.select("key").distinct(), "key", "left_semi").select(F.lit(-1).cast("long").alias("n"), "key", F.lit("registered").alias("decision"), F.col("id").alias("target"), F.lit("").alias("provisional"), F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"), F.col("line").cast("long").alias("line"))
    work = rows.select(F.col("seq").alias("n"), "key", "decision", "target", "provisional", F.col("y").alias("lat"), F.col("x").alias("lon"), F.lit(None).cast("long").alias("line"))
    every = work.unionByName(before).join(label, "key").withColumn("seq", F.coalesce(F.col("line") - F.lit(1 << 62), F.col("n")))
    made = written(every.groupBy("label").applyInPandas(_stepwise, _STEP), "promote-steps")
    top = stops.agg(F.coalesce(F.max(F.col("id").cast("long")), F.lit(0))).first()[0]
    fresh = numbered(made.filter("new_key is not null").select(F.col("new_key").cast("long").alias("new_key")).distinct(), ["new_key"], "place").select(F.col("new_key").cast("string").alias("new_key"), (F.col("place") + F.lit(top + 1)).cast("string").alias("fresh"))
    out = rows.join(made.drop("row_key"), "seq").join(fresh, "new_key", "left").withColumn("id", F.coalesce("known_id", "fresh"))
    given = fresh.select(F.col("fresh").alias("target"), F.col("new_key").cast("long").alias("since"))
    told = out.join(stops.select(F.col("id").alias("target")).distinct().withColumn("old", F.lit(True)), "target", "left").join(given, "target", "left")
    sound = (F.col("decision") == "new") | F.col("old").isNotNull() | (F.col("since") < F.col("seq"))
    checked = F.when(F.coalesce(sound, F.lit(False)), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("not a registered id: "), F.coalesce("target", F.lit("")))).cast("string"))
    is_new = F.coalesce((F.col("new_key").cast("long") == F.col("seq")) & (F.col("status") == "added"), F.lit(False))
    return told.select(checked.alias("id"), *[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in KEY], F.trim(F.coalesce("lat", F.lit(""))).alias("lat"), F.trim(F.coalesce("lon", F.lit(""))).alias("lon"), F.trim(F.coalesce("note", F.lit(""))).alias("note"), "status", is_new.alias("is_new"), "seq")


def promote_posts(posts: DataFrame, candidates: DataFrame, accept_new: bool = False) -> DataFrame:
    """``candidates`` (stop_id, post_key, lat, lon, reason, decision, line) with ``status`` added or skipped: the first new one of each key that posts lack is added."""
    rows = candidates.withColumns({"stop_id": F.trim("stop_id"), "post_key": F.trim("post_key"), "said": decide(F.col("decision"), F.col("reason"), accept_new)})
    known = posts.select("stop_id", "post_key").distinct().withColumn("known", F.lit(True))
    place = F.row_number().over(Window.partitionBy("stop_id", "post_key", "said").orderBy("line"))
    fresh = (F.col("said") == "new") & F.col("known").isNull() & (F.col("n") == 1)
    return rows.withColumn("n", place).join(known, ["stop_id", "post_key"], "left").withColumn("status", F.when(fresh, "added").otherwise("skipped")).drop("n", "known", "said")


def promote_places(places: DataFrame, candidates: DataFrame, accept_new: bool = False) -> DataFrame:
    """``candidates`` (source_id, group_key, place_id, reason, decision, alias_of, alias_of_suggestion, line) with ``place_id`` and
    ``status`` added, aliased or skipped.

    A new one pins its own place, an alias one that is pinned already, by the
    places or by an earlier candidate that was added; another target is an error.
    """
    said = decide(F.col("decision"), F.col("reason"), accept_new)
    target = F.when(said == "alias", alias_target(F.col("alias_of"), F.col("alias_of_suggestion"))).otherwise(F.trim("place_id"))
    rows = candidates.withColumns({"source_id": F.trim("source_id"), "said": said, "place_id": target})
    known = places.select("source_id", "group_key").distinct().withColumn("known", F.lit(True))
    place = F.row_number().over(Window.partitionBy("source_id", "group_key").orderBy("line"))
    live = rows.filter(F.col("said").isin("new", "alias")).withColumn("n", place).join(known, ["source_id", "group_key"], "left")
    taken = live.withColumn("taken", (F.col("n") == 1) & F.col("known").isNull())
    pinned = places.select("place_id").distinct().withColumn("pinned", F.lit(-1).cast("long")).unionByName(taken.filter("taken").select("place_id", F.col("line").cast("long").alias("pinned"))).groupBy("place_id").agg(F.min("pinned").alias("pinned"))
    checked = taken.join(pinned, "place_id", "left")
    sound = (F.col("said") == "new") | (F.col("pinned") < F.col("line"))
    place_id = F.when(F.coalesce(sound, F.lit(False)), F.col("place_id")).otherwise(F.raise_error(F.concat(F.lit("not a pinned place: "), F.coalesce("place_id", F.lit("")))).cast("string"))
    status = F.when(~F.col("taken"), "skipped").when(F.col("said") == "alias", "aliased").otherwise("added")
    columns = [c for c in candidates.columns if c != "place_id"]
    return checked.select(*columns, place_id.alias("place_id"), status.alias("status")).unionByName(rows.filter(~F.col("said").isin("new", "alias")).select(*columns, "place_id", F.lit("skipped").alias("status")))


def counters(promoted: DataFrame) -> DataFrame:
    """One row of counts by status."""
    return promoted.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("added", "aliased", "skipped")])


#: Metres within which an inferred post is a registered one.
SAME_POST = 25.0


def reuse_post(posts: DataFrame, inferred: DataFrame) -> DataFrame:
    """``inferred`` (row, stop_id, lat, lon) with ``post_key``: that of the nearest registered inferred post of its stop within ``SAME_POST`` metres, or null."""
    own = posts.filter(F.startswith("post_key", F.lit("est:"))).select("stop_id", "post_key", F.col("lat").cast("double").alias("y"), F.col("lon").cast("double").alias("x"))
    metres = distance_metres(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"))
    near = inferred.join(own, "stop_id").withColumn("metres", metres).filter(F.col("metres") <= SAME_POST)
    best = near.groupBy("row").agg(F.min(F.struct("metres", "post_key"))["post_key"].alias("post_key"))
    return inferred.join(best, "row", "left")
