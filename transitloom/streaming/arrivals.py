"""Structured Streaming variants of the catalogue's upkeep and of anchors along running trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transitloom.functions.country import plate_code
from transitloom.functions.geo import ten_thousandths
from transitloom.functions.text import dedup_name
from transitloom.sources.sinks import clean_stops

CATALOGUE = "name string, latitude double, longitude double, region string, country string"


def catalogue_stream(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """Clean stops of catalogue files as they come into a folder, with the ``arrived`` time of their file."""
    rows = spark.readStream.schema(CATALOGUE).option("maxFilesPerTrigger", files_a_batch).csv(folder)
    return clean_stops(rows.withColumn("arrived", F.col("_metadata.file_modification_time")))


def first_seen(stops: DataFrame, within: str = "7 days") -> DataFrame:
    """Each identity (name, region, country, place to four decimals) once in ``within`` of event time; state older than that goes."""
    keys = {"k_name": dedup_name(F.col("name")), "k_region": F.coalesce("region", F.lit("")), "k_country": F.coalesce(plate_code(F.col("country")), F.lit("")), "k_lat": ten_thousandths(F.col("latitude")), "k_lon": ten_thousandths(F.col("longitude"))}
    return stops.withColumns(keys).withWatermark("arrived", within).dropDuplicatesWithinWatermark(list(keys)).drop(*keys)


def calls_by_window(calls: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts of calls(place, ts) at unresolved places by window of event time; calls later than ``late`` are left out."""
    windowed = calls.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "place").agg(F.count(F.lit(1)).alias("calls"))
    return windowed.select("place", F.col("w.start").alias("since"), F.col("w.end").alias("until"), "calls")


def append(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write all that has come, then stop; a later call goes on from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
