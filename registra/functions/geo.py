"""Coordinates out of JSON or text, and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registra.functions.text import number

EARTH_KM = 6371.0


def _both(pair: Column) -> Column:
    """``lat`` and ``lon`` of a pair of texts if both are numbers; else null."""
    spot = F.struct(number(pair["lat"]).alias("lat"), number(pair["lon"]).alias("lon"))
    return F.get(F.filter(F.array(spot), lambda s: s["lat"].isNotNull() & s["lon"].isNotNull()), 0)


def point_object(c: Column) -> Column:
    """``{"lat": .., "lon": ..}``."""
    return _both(F.from_json(c, "lat string, lon string"))


def point_text(c: Column) -> Column:
    """``lat, lon`` in this order, nothing else around it."""
    parts = F.split(F.when(c.rlike(r"^\s*[+-]?\d+(\.\d+)?\s*,\s*[+-]?\d+(\.\d+)?\s*$"), c), ",")
    return _both(F.struct(F.get(parts, 0).alias("lat"), F.get(parts, 1).alias("lon")))


def geometry(c: Column) -> Column:
    """A GeoJSON point, bare or in a feature, whose coordinates come as ``[lon, lat]``."""
    read = F.from_json(c, "geometry struct<coordinates: array<string>>, coordinates array<string>")
    spots = F.when(read["geometry"].isNotNull(), read["geometry"]["coordinates"]).otherwise(read["coordinates"])
    return _both(F.struct(F.get(spots, 1).alias("lat"), F.get(spots, 0).alias("lon")))


def coordinates(point: Column, geom: Column) -> Column:
    """``lat`` and ``lon`` of the first source that has both: point object, point text, geometry."""
    return F.coalesce(point_object(point), point_text(point), geometry(geom))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if any coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))
