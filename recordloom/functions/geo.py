"""Coordinates: distances, cells, order keys, polygons in WKT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_MILES = 3958.7613


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle miles."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))
    inner = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * EARTH_MILES * F.asin(F.sqrt(F.least(inner, F.lit(1.0))))


def cell(col: Column, degrees: float) -> Column:
    return F.floor(col / F.lit(degrees))


def around(col: Column, degrees: float) -> Column:
    """The cell of a value and both its neighbours."""
    at = cell(col, degrees)
    return F.array(at - 1, at, at + 1)


def zorder_key(lat: Column, lon: Column, bits: int = 16) -> Column:
    """Interleaved bits of latitude and longitude scaled to ``bits`` bits each."""
    scale = (1 << bits) - 1
    y, x = F.floor((lat + 90) / 180 * scale), F.floor((lon + 180) / 360 * scale)
    out = F.lit(0).cast("long")
    for i in range(bits):
        pick = lambda v, at: F.shiftleft(F.shiftright(v, i).bitwiseAND(F.lit(1).cast("long")), at)  # noqa: E731, B023
        out = out.bitwiseOR(pick(x, 2 * i)).bitwiseOR(pick(y, 2 * i + 1))
    return out


def rings(wkt: Column) -> Column:
    """array<struct<hole, points>> of the rings of a polygon or multipolygon; points: array<struct<x, y>>."""
    pair = lambda p: F.split(F.trim(p), r"\s+")
    point = lambda p: F.struct(F.get(pair(p), F.lit(0)).cast("double").alias("x"), F.get(pair(p), F.lit(1)).cast("double").alias("y"))
    found = F.regexp_extract_all(wkt, F.lit(r"(?:\(\s*|,\s*)\([^()]+\)"), F.lit(0))  # an outer ring opens its polygon, a hole follows a comma
    return F.transform(found, lambda r: F.struct(r.startswith(",").alias("hole"), F.transform(F.split(F.regexp_replace(r, "[(),\\s]*\\(|\\)", ""), ","), point).alias("points")))


def edges(points: Column) -> Column:
    """array<struct<a,b>> of a closed ring's consecutive points."""
    return F.zip_with(F.slice(points, F.lit(1), F.size(points) - 1), F.slice(points, F.lit(2), F.size(points) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def wkt_centroid(wkt: Column) -> Column:
    """struct<lon, lat>: area centroid of a polygon or multipolygon, holes taken out."""
    cross = lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
    total = lambda sides, f: F.aggregate(sides, F.lit(0.0), lambda s, e: s + f(e))

    def part(r: Column) -> Column:
        sides = edges(r["points"])
        area = total(sides, cross)
        sign = F.when(r["hole"], -1.0).otherwise(1.0) * F.signum(area)  # rings may run either way
        moment = lambda c: sign * total(sides, lambda e: (e["a"][c] + e["b"][c]) * cross(e)) / 3
        return F.struct((sign * area).alias("area"), moment("x").alias("x"), moment("y").alias("y"))

    parts = F.transform(rings(wkt), part)
    add = lambda c: F.aggregate(parts, F.lit(0.0), lambda s, p: s + p[c])
    return F.struct((add("x") / F.nullif(add("area"), F.lit(0.0))).alias("lon"), (add("y") / F.nullif(add("area"), F.lit(0.0))).alias("lat"))


def sides(wkt: Column) -> Column:
    """array<struct<a,b>> of all rings of a polygon or multipolygon."""
    return F.flatten(F.transform(rings(wkt), lambda r: edges(r["points"])))


def polygon_distance(x: Column, y: Column, wkt: Column) -> Column:
    """Degrees from a point to a polygon or multipolygon, 0 inside; a hole is outside."""
    return sides_distance(x, y, sides(wkt))


def sides_distance(x: Column, y: Column, sides: Column) -> Column:
    """polygon_distance from the polygon's sides(), for polygons that many points meet."""

    def to_edge(e: Column) -> Column:
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["a"]["x"]) * dx + (y - e["a"]["y"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))))
        t = F.coalesce(t, F.lit(0.0))
        return F.sqrt(F.pow(x - e["a"]["x"] - t * dx, F.lit(2.0)) + F.pow(y - e["a"]["y"] - t * dy, F.lit(2.0)))

    def crosses(e: Column) -> Column:
        spans = (e["a"]["y"] > y) != (e["b"]["y"] > y)
        at = e["a"]["x"] + (y - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"]) / F.nullif(e["b"]["y"] - e["a"]["y"], F.lit(0.0))
        return spans & (x < at)

    inside = F.size(F.filter(sides, crosses)) % 2 == 1
    return F.when(inside, F.lit(0.0)).otherwise(F.array_min(F.transform(sides, to_edge)))


def bounds(wkt: Column) -> Column:
    """struct<x0, y0, x1, y1> around a polygon or multipolygon."""
    points = F.flatten(F.transform(rings(wkt), lambda r: r["points"]))
    side = lambda f, c: f(F.transform(points, lambda p: p[c]))
    return F.struct(side(F.array_min, "x").alias("x0"), side(F.array_min, "y").alias("y0"), side(F.array_max, "x").alias("x1"), side(F.array_max, "y").alias("y1"))
