"""Writers. Each output is a folder committed as a whole; a sorted output is one global sort, however many files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from transitloom.functions.country import plate_code
from transitloom.functions.text import query_variants
from transitloom.operators import registry
from transitloom.operators.places import enriched
from transitloom.plans.tables import numbered

from .files import GEODATA

OPTIONS = {"escape": '"', "emptyValue": "", "lineSep": "\n"}


def _write(rows: DataFrame, path: str, header: bool, mode: str = "overwrite") -> None:
    rows.write.mode(mode).options(**OPTIONS).csv(path, header=header)


def plain_number(c: Column) -> Column:
    """A double in up to 15 significant digits without needless zeros."""
    text = F.format_string("%.15g", c)
    return F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)


def clean_stops(stops: DataFrame) -> DataFrame:
    """Named, positioned stops: a coordinate out of range is an error, blank names and (0, 0) are left out."""
    lat, lon = F.col("latitude"), F.col("longitude")
    sound = F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))
    checked = F.when(sound, True).otherwise(F.raise_error(F.concat(F.lit("invalid coordinates of "), "name")).cast("boolean"))
    return stops.filter(F.trim(F.coalesce("name", F.lit(""))) != "").filter(checked).filter(~((lat == 0) & (lon == 0)))


def write_stops(stops: DataFrame, path: str) -> int:
    """Write a headerless catalogue and return its number of rows; none is an error, and nothing is then written."""
    rows = clean_stops(stops).select(*GEODATA)
    if rows.isEmpty():
        raise ValueError(f"{path}: no stops")
    seen = Observation()
    _write(rows.observe(seen, F.count(F.lit(1)).alias("n")), path, False)
    return int(seen.get["n"])


def write_enriched(stops: DataFrame, regions: DataFrame, countries: DataFrame, path: str) -> int:
    """Write the catalogue of clean stops(ord, ...), their region and country by polygons, one row of each identity (see ``places.enriched``)."""
    return write_stops(enriched(clean_stops(stops), regions, countries), path)


def write_registry(tables: dict[str, DataFrame], folder: str, edition: str, order: dict[str, list[str]]) -> None:
    """Write a registry's ``stops``, ``posts`` and ``places``, if they are sound, as a new edition beside the old one.

    Errors are raised, the first ten told, before anything is written.
    """
    lined = {name: rows if "line" in rows.columns else numbered(rows, order[name], "line").withColumn("line", F.col("line") + 2) for name, rows in tables.items()}
    errors = registry.validate(lined["stops"], lined["posts"], lined["places"]).orderBy("table", "line").limit(10).collect()
    if errors:
        raise ValueError("; ".join(f"{e['table']}:{e['line']}: {e['error']}" for e in errors))
    for name, rows in tables.items():
        write_table(rows.drop("line"), f"{folder}/{edition}/{name}", order[name])


def write_all(sources: dict[str, Callable[[], DataFrame]], folder: str) -> dict[str, int]:
    """Write every source to its own folder; all are tried before the failed ones are raised together."""
    written, failed = {}, {}
    for name, make in sources.items():
        try:
            written[name] = write_stops(make(), f"{folder}/{name}")
        except Exception as error:  # noqa: BLE001  reported below
            failed[name] = error
    if failed:
        raise RuntimeError("; ".join(f"{name}: {error}" for name, error in failed.items()))
    return written


def accepted(rows: DataFrame) -> DataFrame:
    """Accepted stops as catalogue rows in order of their id."""
    return rows.orderBy("stop_id").select("name", "latitude", "longitude", "region", F.coalesce(plate_code(F.col("country")), F.lit("CZ")).alias("country"))


def review(rows: DataFrame) -> DataFrame:
    """Stops left open (as ``files.stop_queries`` reads them, with reason and candidates), as it can read them again."""
    return rows.orderBy("stop_id").select(
        "stop_id", "name", "municipality", "region", "country", "coordinate_status", F.col("latitude").alias("current_latitude"), F.col("longitude").alias("current_longitude"), "coordinate_source", "route_occurrences",
        F.to_json("route_contexts").alias("route_contexts"), F.array_join(query_variants(F.col("name"), F.col("municipality"), F.col("country")), " | ").alias("query_variants"), "reason", "candidates",
    )


def write_results(found: DataFrame, left: DataFrame, accepted_path: str, review_path: str) -> None:
    _write(accepted(found), accepted_path, False)
    _write(review(left), review_path, True)


def candidate_review(assessed: DataFrame) -> DataFrame:
    """The sixteen columns by which assessed candidates (see ``resolve.assess``, with query, label and source) are reviewed:
    scores to six digits, distances to one, no reason for feasible ones."""
    return assessed.orderBy("stop", "ord").select(
        F.col("stop").alias("stop_id"), F.col("name").alias("query_name"), F.array_join("names", " | ").alias("candidate_names"), "query", "label", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.round("distance", 1).alias("distance_from_estimate_metres"), F.col("c_municipality").alias("municipality"), F.col("c_country").alias("country"), "kind", "source", "rank",
        F.round("score", 6).alias("name_score"), F.col("accepted").alias("route_feasible"), F.when(F.col("accepted"), "").otherwise(F.col("reason")).alias("rejection_reason"),
    )


def write_table(rows: DataFrame, path: str, order: list[str]) -> None:
    """Any table with a heading, sorted: audits, work lists and registries."""
    nested = [f.name for f in rows.schema if f.dataType.typeName() in ("array", "map", "struct")]
    _write(rows.orderBy(*order).withColumns({c: F.to_json(c) for c in nested}), path, True)


def write_pair(points: DataFrame, folder: str, edition: str) -> None:
    """Two projections of one set of points under a new ``edition``: readers see both once the second has its success mark."""
    kept = points.select("code", "name", "name20", plain_number(F.col("latitude")).alias("latitude"), plain_number(F.col("longitude")).alias("longitude"), "qualifier").orderBy("code")
    _write(kept, f"{folder}/{edition}/full", True, "error")
    _write(kept.select("name", "latitude", "longitude"), f"{folder}/{edition}/names", False, "error")


def listing(points: DataFrame, name: str = "name", just_names: bool = False, qualifiers: list[int] | None = None) -> DataFrame:
    """Points, or only the chosen kind of name, of the given qualifiers."""
    rows = points if qualifiers is None else points.filter(F.col("qualifier").isin(qualifiers))
    return rows.select("code", name) if just_names else rows.select("code", name, *[plain_number(F.col(c)).alias(c) for c in ("latitude", "longitude")])
