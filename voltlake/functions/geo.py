"""Planar geometry and map projection as column expressions.

A geometry is ``array<array<array<struct<x,y>>>>``: parts, rings, vertices. A point is one part
with one ring of one vertex; rings of areas are closed (last vertex = first).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltlake.functions.nested import let

# GRS80 ellipsoid and UTM zone 32 (EPSG:25832).
_A = 6378137.0
_F = 1 / 298.257222101
_LON0 = 9.0
_K0 = 0.9996
_FALSE_EASTING = 500000.0

_N = _F / (2 - _F)
_ECC = 2 * math.sqrt(_N) / (1 + _N)
RECTIFYING_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krueger series to fourth order.
KRUEGER = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
]


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def point_geometry(x: Column, y: Column) -> Column:
    return F.array(F.array(F.array(xy(x, y))))


def _sphere(lon: Column, lat: Column) -> tuple[Column, Column]:
    sine = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - F.lit(_ECC) * F.atanh(F.lit(_ECC) * sine))
    dlon = F.radians(lon - F.lit(_LON0))
    return (
        F.atan2(t, F.cos(dlon)),
        F.atanh(F.sin(dlon) / F.sqrt(F.lit(1.0) + t * t)),
    )


def _plane(xi: Column, eta: Column) -> Column:
    east, north = eta, xi
    for j, alpha in enumerate(KRUEGER, start=1):
        a, b = F.lit(2.0 * j) * xi, F.lit(2.0 * j) * eta
        east = east + F.lit(alpha) * F.cos(a) * F.sinh(b)
        north = north + F.lit(alpha) * F.sin(a) * F.cosh(b)
    scale = F.lit(_K0 * RECTIFYING_RADIUS)
    return xy(F.lit(_FALSE_EASTING) + scale * east, scale * north)


def to_utm32(lon: Column, lat: Column) -> Column:
    """Degrees to metres: struct<x,y>."""
    return _plane(*_sphere(lon, lat))


def geometry_to_utm32(geometry: Column) -> Column:
    """Every vertex of a geometry from degrees to metres."""

    def vertex(p: Column) -> Column:
        xi, eta = _sphere(p["x"], p["y"])
        return let(F.struct(xi.alias("xi"), eta.alias("eta")), lambda s: _plane(s["xi"], s["eta"]))

    return F.transform(
        geometry, lambda part: F.transform(part, lambda ring: F.transform(ring, vertex))
    )


def ring_segments(ring: Column) -> Column:
    """Consecutive vertices of a ring as segments."""
    return F.transform(
        F.filter(
            F.arrays_zip(
                ring.alias("a"), F.slice(ring, F.lit(2), F.greatest(F.size(ring), F.lit(1))).alias("b")
            ),
            lambda s: s["b"].isNotNull(),
        ),
        lambda s: F.struct(
            s["a"]["x"].alias("ax"), s["a"]["y"].alias("ay"),
            s["b"]["x"].alias("bx"), s["b"]["y"].alias("by"),
        ),
    )


def segments(geometry: Column) -> Column:
    """All segments of all rings of all parts."""
    return F.flatten(F.transform(F.flatten(geometry), ring_segments))


def vertices(geometry: Column) -> Column:
    return F.flatten(F.flatten(geometry))


def bounds(geometry: Column) -> Column:
    """struct<x0,y0,x1,y1> around a geometry."""
    xs = F.transform(vertices(geometry), lambda p: p["x"])
    ys = F.transform(vertices(geometry), lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    )


def _crosses(s: Column, y: Column) -> Column:
    return (s["ay"] > y) != (s["by"] > y)


def covers_point(edges: Column, x: Column, y: Column) -> Column:
    """Odd number of edges to the right of (x, y). Holes and several parts need no special case."""

    def right_of(s: Column) -> Column:
        # Side of the edge without a division: the sign flips with the edge's direction.
        side = (s["bx"] - s["ax"]) * (y - s["ay"]) - (x - s["ax"]) * (s["by"] - s["ay"])
        return _crosses(s, y) & F.when(s["by"] > s["ay"], side > 0).otherwise(side < 0)

    return (F.size(F.filter(edges, right_of)) % 2) == 1


def near_segment(edges: Column, x: Column, y: Column, radius: Column) -> Column:
    """Does any edge come within ``radius`` (inclusive) of (x, y)?"""

    def near(s: Column) -> Column:
        ux, uy = s["bx"] - s["ax"], s["by"] - s["ay"]
        length2 = ux * ux + uy * uy
        along = F.when(
            length2 > 0,
            F.greatest(
                F.lit(0.0),
                F.least(F.lit(1.0), ((x - s["ax"]) * ux + (y - s["ay"]) * uy) / length2),
            ),
        ).otherwise(F.lit(0.0))
        return let(
            along,
            lambda t: _square(s["ax"] + t * ux - x) + _square(s["ay"] + t * uy - y)
            <= radius * radius,
        )

    return F.exists(edges, near)


def _square(value: Column) -> Column:
    return value * value


def _part_interior(part: Column) -> Column:
    """Widest inner span of one area on a scan line: struct<width,west,y>, west = -x.

    Of equally wide spans the westernmost wins.

    The line lies midway between the vertices next above and next below the middle of the
    bounds, so it meets no vertex.
    """

    def on_line(ys: Column) -> Column:
        middle = (F.array_min(ys) + F.array_max(ys)) / F.lit(2.0)
        return let(
            middle,
            lambda m: (
                F.array_max(F.filter(ys, lambda v: v <= m))
                + F.coalesce(F.array_min(F.filter(ys, lambda v: v > m)), m)
            )
            / F.lit(2.0),
        )

    def spans(y: Column, edges: Column) -> Column:
        crossing = F.transform(
            F.filter(edges, lambda s: _crosses(s, y)),
            lambda s: s["ax"]
            + (y - s["ay"]) / (s["by"] - s["ay"]) * (s["bx"] - s["ax"]),
        )
        return let(
            F.sort_array(crossing),
            lambda xs: F.transform(
                F.filter(
                    F.arrays_zip(
                        xs.alias("l"),
                        F.slice(xs, F.lit(2), F.greatest(F.size(xs), F.lit(1))).alias("r"),
                        F.sequence(F.lit(0), F.greatest(F.size(xs) - 1, F.lit(0))).alias("i"),
                    ),
                    lambda z: z["r"].isNotNull() & (z["i"] % 2 == 0),
                ),
                lambda z: F.struct(
                    (z["r"] - z["l"]).alias("width"),
                    (-(z["l"] + z["r"]) / F.lit(2.0)).alias("west"),
                    y.alias("y"),
                ),
            ),
        )

    ys = F.transform(F.flatten(part), lambda p: p["y"])
    edges = F.flatten(F.transform(part, ring_segments))
    return let(
        F.struct(ys.alias("ys"), edges.alias("edges")),
        lambda v: let(on_line(v["ys"]), lambda y: F.array_max(spans(y, v["edges"]))),
    )


def _line_vertex(geometry: Column) -> Column:
    """The inner vertex of a line next to its centroid; of a line without inner vertices, the
    end next to it."""

    def weighted(s: Column) -> Column:
        length = F.sqrt(_square(s["bx"] - s["ax"]) + _square(s["by"] - s["ay"]))
        return F.struct(
            length.alias("length"),
            (length * (s["ax"] + s["bx"]) / 2).alias("x"),
            (length * (s["ay"] + s["by"]) / 2).alias("y"),
        )

    def total(parts: Column, name: str) -> Column:
        return F.aggregate(parts, F.lit(0.0), lambda acc, s: acc + s[name])

    def nearest(points: Column, centre: Column) -> Column:
        ranked = F.transform(
            points,
            lambda p: F.struct(
                (_square(p["x"] - centre["x"]) + _square(p["y"] - centre["y"])).alias("d"),
                p["x"].alias("x"), p["y"].alias("y"),
            ),
        )
        return F.array_min(ranked)

    def centre(parts: Column) -> Column:
        length = F.nullif(total(parts, "length"), F.lit(0.0))
        return xy(total(parts, "x") / length, total(parts, "y") / length)

    parts = F.transform(segments(geometry), weighted)
    inner = F.flatten(
        F.transform(
            F.flatten(geometry), lambda r: F.slice(r, F.lit(2), F.greatest(F.size(r) - 2, F.lit(0)))
        )
    )
    candidates = F.when(F.size(inner) > 0, inner).otherwise(vertices(geometry))
    found = let(parts, lambda p: let(centre(p), lambda c: nearest(candidates, c)))
    return F.struct(found["x"].alias("x"), found["y"].alias("y"))


def representative_point(geometry: Column, kind: Column) -> Column:
    """A point on the geometry: the point itself, a vertex of a line, or the middle of an area's
    widest inner span."""
    inner = F.array_max(F.transform(geometry, _part_interior))
    first = vertices(geometry)[0]
    return (
        F.when(kind == "point", first)
        .when(kind.isin("linestring", "multilinestring"), _line_vertex(geometry))
        .otherwise(
            F.coalesce(F.struct((-inner["west"]).alias("x"), inner["y"].alias("y")), first)
        )
    )
