"""Polygon and point files: GeoJSON, plain or zipped, and shapefiles, some of them in a national projection."""

from __future__ import annotations

import io
import json
import math
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .snapshots import ring_centroid

_RING = "array<array<struct<lat: double, lon: double>>>"


def _open_ring(points: Column) -> Column:
    return F.transform(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), lambda p: F.struct(F.get(p, F.lit(1)).alias("lat"), F.get(p, F.lit(0)).alias("lon")))


def polygons(spark: SparkSession, path: str, code: str) -> DataFrame:
    """``(code, rings)`` of a GeoJSON feature collection, compressed or not; all rings of all parts, not closed."""
    kind = f"features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    rows = spark.read.schema(kind).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    text = F.col("f.geometry.coordinates")
    one, many = F.from_json(text, "array<array<array<double>>>"), F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    rings = F.when(F.col("f.geometry.type") == "Polygon", one).when(F.col("f.geometry.type") == "MultiPolygon", many)
    return rows.select(F.col("f.properties")[code].alias("code"), F.transform(rings, _open_ring).cast(_RING).alias("rings")).filter("rings is not null")


def _points_of(geometry: dict) -> Iterator[tuple[str, list]]:
    """Points and outer rings of a geometry, those of collections in turn."""
    todo = [geometry]
    while todo:
        g = todo.pop(0)
        if g["type"] == "GeometryCollection":
            todo = [*g["geometries"], *todo]
        elif g["type"] == "Point":
            yield "point", [g["coordinates"][:2]]
        elif g["type"] == "Polygon":
            yield "ring", [p[:2] for p in g["coordinates"][0]]
        else:
            raise ValueError(f"geometry of type {g['type']}")


def zipped_points(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``(name, latitude, longitude)`` of the first member, a GeoJSON collection, of zip files; polygons by their centroid."""

    def read(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in files:
            for content in part["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as f:
                    rows = [(str(x["properties"].get(name) or ""), kind, points) for x in json.load(f)["features"] for kind, points in _points_of(x["geometry"])]
                yield pd.DataFrame(rows, columns=["name", "kind", "points"])

    found = spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, "name string, kind string, points array<array<double>>")
    first = F.get("points", F.lit(0))
    at = F.when(F.col("kind") == "ring", ring_centroid(F.col("points"))).otherwise(F.struct(F.get(first, F.lit(1)).alias("lat"), F.get(first, F.lit(0)).alias("lon")))
    return found.select("name", at["lat"].alias("latitude"), at["lon"].alias("longitude"))


def _records(dbf: bytes, encoding: str) -> Iterator[dict[str, str]]:
    n, header, size = struct.unpack("<IHH", dbf[4:12])
    fields, at = [], 32
    while dbf[at] != 0x0D:
        fields.append((dbf[at : at + 11].split(b"\0")[0].decode("ascii"), dbf[at + 16]))
        at += 32
    for i in range(n):
        row, place, out = dbf[header + i * size : header + (i + 1) * size], 1, {}
        for field, width in fields:
            out[field] = row[place : place + width].decode(encoding, "replace").strip().strip("\0")
            place += width
        yield out


def _first_points(shp: bytes) -> Iterator[tuple[float, float]]:
    """The first point of each shape: points, multipoints, lines and polygons, with or without height and measure."""
    at = 100
    while at + 8 <= len(shp):
        words = struct.unpack(">i", shp[at + 4 : at + 8])[0]
        body = shp[at + 8 : at + 8 + 2 * words]
        kind = struct.unpack("<i", body[:4])[0] % 10
        if kind == 1:
            yield struct.unpack("<2d", body[4:20])
        elif kind == 8:
            yield struct.unpack("<2d", body[40:56])
        elif kind in (3, 5):
            parts = struct.unpack("<i", body[36:40])[0]
            yield struct.unpack("<2d", body[44 + 4 * parts : 60 + 4 * parts])
        else:
            yield math.nan, math.nan
        at += 8 + 2 * words


def shapefile_points(spark: SparkSession, path: str, name: str, encoding: str = "utf-8", drop: tuple[str, str] | None = None, krovak: bool = False) -> DataFrame:
    """``(name, latitude, longitude)`` of zipped shapefiles; records whose field ``drop[0]`` is ``drop[1]`` are left out.

    Coordinates are degrees, or (``krovak``) metres of the projection of ``from_krovak``.
    """

    def read(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in files:
            for content in part["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    member = lambda end, z=z: z.read(next(n for n in z.namelist() if n.endswith(end)))
                    pairs = zip(_records(member(".dbf"), encoding), _first_points(member(".shp")), strict=True)
                    rows = [(r[name], x, y) for r, (x, y) in pairs if drop is None or r.get(drop[0]) != drop[1]]
                table = pd.DataFrame(rows, columns=["name", "longitude", "latitude"])
                if krovak:
                    table["latitude"], table["longitude"] = from_krovak(table["longitude"].to_numpy(float), table["latitude"].to_numpy(float))
                yield table[["name", "latitude", "longitude"]]

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, "name string, latitude double, longitude double")


# Fixed values of the oblique conic projection (EPSG 5514, axes to east and north): the Bessel ellipsoid; latitudes of
# origin and pseudo standard parallel; the cone's azimuth; longitude of origin; scale. Then the shift of the datum to
# WGS 84: metres, seconds of arc (position vector), parts in a million; and the WGS 84 ellipsoid.
_A, _INV_F = 6377397.155, 299.1528128
_LAT0, _PARALLEL, _CONE, _LON0, _SCALE = 49.5, 78.5, 30.28813975277778, 24.833333333333332, 0.9999
_SHIFT, _TURN, _PPM = (570.8, 85.7, 462.8), (4.998, 1.587, 5.261), 3.56
_WGS_A, _WGS_INV_F = 6378137.0, 298.257223563


def from_krovak(x: np.ndarray, y: np.ndarray, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Latitudes and longitudes in WGS 84 of metres in EPSG 5514: the projection backwards, then the shift of the datum."""
    f = 1 / _INV_F
    e2 = 2 * f - f * f
    e = math.sqrt(e2)
    lat0, parallel, alpha = math.radians(_LAT0), math.radians(_PARALLEL), math.radians(_CONE)
    radius = _A * math.sqrt(1 - e2) / (1 - e2 * math.sin(lat0) ** 2)
    b = math.sqrt(1 + e2 * math.cos(lat0) ** 4 / (1 - e2))
    sphere0 = math.asin(math.sin(lat0) / b)
    t0 = math.tan(math.pi / 4 + sphere0 / 2) * ((1 + e * math.sin(lat0)) / (1 - e * math.sin(lat0))) ** (e * b / 2) / math.tan(math.pi / 4 + lat0 / 2) ** b
    n = math.sin(parallel)
    r0 = _SCALE * radius / math.tan(parallel)
    south, west = -y, -x
    r, theta = np.hypot(south, west), np.arctan2(west, south)
    d = theta / math.sin(parallel)
    t = 2 * (np.arctan(np.power(r0 / r, 1 / n) * math.tan(math.pi / 4 + parallel / 2)) - math.pi / 4)
    u = np.arcsin(math.cos(alpha) * np.sin(t) - math.sin(alpha) * np.cos(t) * np.cos(d))
    v = np.arcsin(np.cos(t) * np.sin(d) / np.cos(u))
    lon = math.radians(_LON0) - v / b
    lat = u
    for _ in range(rounds):
        flat = np.power((1 + e * np.sin(lat)) / (1 - e * np.sin(lat)), e / 2)
        lat = 2 * (np.arctan(t0 ** (-1 / b) * np.power(np.tan(u / 2 + math.pi / 4), 1 / b) * flat) - math.pi / 4)
    # to coordinates in space, through the shift, and back
    high = _A / np.sqrt(1 - e2 * np.sin(lat) * np.sin(lat))
    px, py, pz = high * np.cos(lat) * np.cos(lon), high * np.cos(lat) * np.sin(lon), high * (1 - e2) * np.sin(lat)
    rx, ry, rz = (math.radians(s / 3600) for s in _TURN)
    m = 1 + _PPM * 1e-6
    qx = _SHIFT[0] + m * (px - rz * py + ry * pz)
    qy = _SHIFT[1] + m * (rz * px + py - rx * pz)
    qz = _SHIFT[2] + m * (-ry * px + rx * py + pz)
    wf = 1 / _WGS_INV_F
    we2 = 2 * wf - wf * wf
    flat_r = np.hypot(qx, qy)
    wlat = np.arctan2(qz, flat_r * (1 - we2))
    for _ in range(rounds):
        wn = _WGS_A / np.sqrt(1 - we2 * np.sin(wlat) * np.sin(wlat))
        wlat = np.arctan2(qz + we2 * wn * np.sin(wlat), flat_r)
    return np.degrees(wlat), np.degrees(np.arctan2(qy, qx))
