"""Spherical and planar geometry as Column expressions over DOUBLE arrays.

A point is (lon, lat) in degrees, a path ARRAY<ARRAY<DOUBLE>>, a ring a path whose last
vertex repeats the first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the numbers every result is compared on.
EARTH_RADIUS_M = 6_371_000
METRES_PER_DEGREE_PLANAR = 111_320


def degrees_lat(metres: Column) -> Column:
    """Metres along a meridian, in degrees."""
    return metres / F.lit(EARTH_RADIUS_M * math.pi / 180)


def degrees_lon(metres: Column, lat: Column) -> Column:
    """Metres along a parallel at `lat`, in degrees."""
    return metres / (
        F.lit(float(EARTH_RADIUS_M)) * F.cos(F.radians(lat)) * F.lit(math.pi) / F.lit(180.0)
    )


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.sqrt(chord))


def rectangle_ring(lon: Column, lat: Column, width_m: Column, height_m: Column) -> Column:
    """Closed axis-aligned rectangle around a centre, corners at 6 decimals."""
    half_w = degrees_lon(width_m / 2, lat)
    half_h = degrees_lat(height_m / 2)
    west, east = F.round(lon - half_w, 6), F.round(lon + half_w, 6)
    south, north = F.round(lat - half_h, 6), F.round(lat + half_h, 6)
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return F.array(*[F.array(x, y) for x, y in corners])


def edges(path: Column) -> Column:
    """Consecutive vertex pairs of a path, ARRAY<STRUCT<ax, ay, bx, by>>."""
    starts = F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))
    return F.transform(
        starts,
        lambda a, i: F.struct(
            a[0].alias("ax"), a[1].alias("ay"), path[i + 1][0].alias("bx"), path[i + 1][1].alias("by")
        ),
    )


def closed(ring: Column) -> Column:
    """The ring with its first vertex repeated at the end if it is not there yet."""
    return F.when(ring[0] == F.element_at(ring, -1), ring).otherwise(
        F.concat(ring, F.array(ring[0]))
    )


def is_box(ring: Column) -> Column:
    """Whether a ring, closed or not, is a rectangle along the axes."""

    def straight(p: Column, q: Column) -> Column:
        return (p[0] == q[0]) != (p[1] == q[1])

    def opposite(p: Column, q: Column) -> Column:
        return (p[0] != q[0]) & (p[1] != q[1])

    def rectangle(r: Column) -> Column:
        a, b, c, d, last = [F.get(r, F.lit(i)) for i in range(5)]
        corners = (F.size(r) == 4) | ((F.size(r) == 5) & (a == last))
        sides = straight(a, b) & straight(b, c) & straight(c, d) & straight(d, a)
        return corners & opposite(a, c) & opposite(b, d) & sides

    # Inside of a function over arrays the ring is computed once, not once per corner.
    return F.coalesce(F.exists(F.array(ring), rectangle), F.lit(False))


def _cross(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def strictly_inside(ring_edges: Column, lon: Column, lat: Column) -> Column:
    """Even-odd test against the edges of a closed ring; points on the boundary are outside."""

    def touches(e: Column) -> Column:
        return (
            (_cross(e.ax, e.ay, e.bx, e.by, lon, lat) == 0)
            & lon.between(F.least(e.ax, e.bx), F.greatest(e.ax, e.bx))
            & lat.between(F.least(e.ay, e.by), F.greatest(e.ay, e.by))
        )

    def right_of_point(e: Column) -> Column:
        straddles = (e.ay > lat) != (e.by > lat)
        return straddles & (lon < (e.bx - e.ax) * (lat - e.ay) / (e.by - e.ay) + e.ax)

    crossings = F.size(F.filter(ring_edges, right_of_point))
    return ~F.exists(ring_edges, touches) & (crossings % 2 == 1)


def point_in_polygon(rings: Column, lon: Column, lat: Column) -> Column:
    """Strict containment in the exterior ring; holes are not looked at."""
    return strictly_inside(edges(closed(rings[0])), lon, lat)


def segments_meet(s: Column, t: Column) -> Column:
    """Whether two segments (ax, ay, bx, by) share a point, touching and collinear included."""
    overlap = (
        (F.least(s.ax, s.bx) <= F.greatest(t.ax, t.bx))
        & (F.least(t.ax, t.bx) <= F.greatest(s.ax, s.bx))
        & (F.least(s.ay, s.by) <= F.greatest(t.ay, t.by))
        & (F.least(t.ay, t.by) <= F.greatest(s.ay, s.by))
    )

    def split_by(u: Column, v: Column) -> Column:
        first = F.signum(_cross(u.ax, u.ay, u.bx, u.by, v.ax, v.ay))
        second = F.signum(_cross(u.ax, u.ay, u.bx, u.by, v.bx, v.by))
        return first * second <= 0

    return overlap & split_by(s, t) & split_by(t, s)


def paths_meet(a: Column, b: Column) -> Column:
    """Whether two polylines share a point."""
    return F.exists(edges(a), lambda s: F.exists(edges(b), lambda t: segments_meet(s, t)))


def ring_area_m2(ring: Column) -> Column:
    """Planar shoelace area, degrees scaled to metres at the mean latitude of all listed vertices.

    Longitudes are taken relative to the first vertex, which keeps the small area accurate.
    """
    loop = closed(ring)
    inner = F.sequence(F.lit(1), F.size(loop) - 2)
    doubled = F.aggregate(
        inner,
        F.lit(0.0),
        lambda acc, i: acc + (loop[i][0] - loop[0][0]) * (loop[i - 1][1] - loop[i + 1][1]),
    )
    mean_lat = F.aggregate(ring, F.lit(0.0), lambda acc, v: acc + v[1]) / F.size(ring)
    scale = F.lit(float(METRES_PER_DEGREE_PLANAR))
    return F.abs(doubled / 2) * scale * (scale * F.cos(F.radians(mean_lat)))


def path_length_m(path: Column) -> Column:
    """Sum of great-circle distances along a path."""
    return F.aggregate(
        edges(path), F.lit(0.0), lambda acc, e: acc + haversine_m(e.ax, e.ay, e.bx, e.by)
    )


def to_micro(value: Column) -> Column:
    """Round a coordinate to the 6 decimals every stored coordinate has."""
    return F.round(value, 6)
