"""Geodesy, grids and plane geometry as Column expressions."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: GRS80 / CGCS2000 ellipsoid and the regional equal-area projection (fixed values).
A, INV_F = 6378137.0, 298.257222101
LAT0, LON0, LAT1, LAT2 = 23.7025695, 108.251719, 21.9133551666667, 25.4917838333333
#: Datum-shift model (fixed values): Krasovsky axis, eccentricity, and the box outside of which nothing is shifted.
KRASOVSKY_A, KRASOVSKY_EE = 6378245.0, 0.00669342162296594323
BOX = (72.004, 137.8347, 0.8293, 55.8271)

_E2 = 2 / INV_F - 1 / INV_F**2
_E = math.sqrt(_E2)


def _q(s):
    """Authalic q of a sine, for floats."""
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _m(lat):
    return math.cos(lat) / math.sqrt(1 - _E2 * math.sin(lat) ** 2)


_R = [math.radians(x) for x in (LAT0, LAT1, LAT2)]
_N = (_m(_R[1]) ** 2 - _m(_R[2]) ** 2) / (_q(math.sin(_R[2])) - _q(math.sin(_R[1])))
_C = _m(_R[1]) ** 2 + _N * _q(math.sin(_R[1]))
_RHO0 = A * math.sqrt(_C - _N * _q(math.sin(_R[0]))) / _N


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres of the regional equal-area projection, closed form on the ellipsoid."""
    s = F.sin(F.radians(lat))
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    rho, theta = A * F.sqrt(_C - _N * q) / _N, _N * F.radians(lon - LON0)
    return rho * F.sin(theta), _RHO0 - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Metres to degrees; the latitude by the authalic series, below 1e-9 degrees of error here."""
    dy = _RHO0 - y
    rho = F.sqrt(x * x + dy * dy)
    theta = F.atan2(x, dy)
    q = (_C - (rho * _N / A) * (rho * _N / A)) / _N
    qp = 1 - (1 - _E2) / (2 * _E) * math.log((1 - _E) / (1 + _E))
    beta = F.asin(q / qp)
    e4, e6 = _E2**2, _E2**3
    lat = beta + (_E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
    s = F.sin(lat)
    part = 1 - _E2 * s * s
    lat = lat + part * part / (2 * F.cos(lat)) * (q / (1 - _E2) - s / part + F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))  # one Newton step
    return LON0 + F.degrees(theta / _N), F.degrees(lat)


def in_box(lon: Column, lat: Column) -> Column:
    return lon.between(BOX[0], BOX[1]) & lat.between(BOX[2], BOX[3])


def shifted(lon: Column, lat: Column) -> tuple[Column, Column]:
    """The published datum shift (WGS84 to GCJ-02); identity outside of the box."""
    x, y, pi = lon - 105.0, lat - 35.0, math.pi
    wave = (20.0 * F.sin(6.0 * x * pi) + 20.0 * F.sin(2.0 * x * pi)) * (2.0 / 3.0)
    dlat = (-100.0 + 2.0 * x + 3.0 * y + 0.2 * y * y + 0.1 * x * y + 0.2 * F.sqrt(F.abs(x)) + wave
            + (20.0 * F.sin(y * pi) + 40.0 * F.sin(y / 3.0 * pi)) * (2.0 / 3.0) + (160.0 * F.sin(y / 12.0 * pi) + 320.0 * F.sin(y * pi / 30.0)) * (2.0 / 3.0))
    dlon = (300.0 + x + 2.0 * y + 0.1 * x * x + 0.1 * x * y + 0.1 * F.sqrt(F.abs(x)) + wave
            + (20.0 * F.sin(x * pi) + 40.0 * F.sin(x / 3.0 * pi)) * (2.0 / 3.0) + (150.0 * F.sin(x / 12.0 * pi) + 300.0 * F.sin(x / 30.0 * pi)) * (2.0 / 3.0))
    r = F.radians(lat)
    m = 1.0 - KRASOVSKY_EE * F.sin(r) * F.sin(r)
    dlat = dlat * 180.0 / (KRASOVSKY_A * (1.0 - KRASOVSKY_EE) / (m * F.sqrt(m)) * pi)
    dlon = dlon * 180.0 / (KRASOVSKY_A / F.sqrt(m) * F.cos(r) * pi)
    inside = in_box(lon, lat)
    return F.when(inside, lon + dlon).otherwise(lon), F.when(inside, lat + dlat).otherwise(lat)


def unshifted(lon: Column, lat: Column, rounds: int = 8) -> Column:
    """struct(lon, lat): the shift undone by fixed-point steps (each divides the error by about a hundred).

    The rounds are a fold over a short array, so the expression stays small."""
    def step(p: Column, _: Column) -> Column:
        x, y = shifted(p["lon"], p["lat"])
        return F.struct((p["lon"] - (x - lon)).alias("lon"), (p["lat"] - (y - lat)).alias("lat"))

    start = F.struct(lon.alias("lon"), lat.alias("lat"))
    return F.when(in_box(lon, lat), F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)).otherwise(start)


def grid_id(x: Column, y: Column, x0: float = -400000.0, y0: float = -300000.0, size: float = 1000.0) -> Column:
    """GX1K_R<row>_C<col> of a point; negative indexes carry an N. More than six digits are kept whole."""
    def part(i: Column) -> Column:
        digits = F.abs(i).cast("string")
        padded = F.when(F.length(digits) >= 6, digits).otherwise(F.lpad(digits, 6, "0"))
        return F.when(i < 0, F.concat(F.lit("N"), padded)).otherwise(padded)

    row, col = F.floor((y - y0) / size), F.floor((x - x0) / size)
    return F.concat(F.lit("GX1K_R"), part(row), F.lit("_C"), part(col))


def snap(x: Column, step: float, up: bool = False) -> Column:
    return (F.ceil(x / step) if up else F.floor(x / step)) * step


def line_points(wkt: Column) -> Column:
    """Vertices of a LINESTRING as structs (x, y)."""
    body = F.regexp_extract(wkt, r"\((.*)\)", 1)
    return F.transform(F.split(body, r"\s*,\s*"), lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("x"), F.split(F.trim(p), r"\s+")[1].cast("double").alias("y")))


def line_length(points: Column) -> Column:
    pairs = F.zip_with(F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points) - 1), lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"]))
    return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)


def ring_area(points: Column) -> Column:
    """Shoelace area of a closed ring of structs (x, y)."""
    cross = F.zip_with(F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points) - 1), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def box_overlap(a: tuple, b: tuple) -> Column:
    """Area shared by two boxes (x0, y0, x1, y1) of Columns or numbers."""
    c = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    w = F.least(c(a[2]), c(b[2])) - F.greatest(c(a[0]), c(b[0]))
    h = F.least(c(a[3]), c(b[3])) - F.greatest(c(a[1]), c(b[1]))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def _clipped_area(xs: list[float], ys: list[float], box: tuple[float, float, float, float]) -> float:
    """Area of a ring (first point repeated at the end) inside a box, one side of the box after the other."""
    ring = list(zip(xs, ys))[:-1]
    for axis, limit, low in ((0, box[0], True), (0, box[2], False), (1, box[1], True), (1, box[3], False)):
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1]):
            p_in, q_in = (p[axis] >= limit, q[axis] >= limit) if low else (p[axis] <= limit, q[axis] <= limit)
            if p_in != q_in:
                f = (limit - p[axis]) / (q[axis] - p[axis])
                out.append((limit, p[1] + f * (q[1] - p[1])) if axis == 0 else (p[0] + f * (q[0] - p[0]), limit))
            if q_in:
                out.append(q)
        ring = out
        if not ring:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))) / 2


@F.pandas_udf(T.DoubleType())
def clipped_area(xs: pd.Series, ys: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    """Area of each ring within its box; no built-in expression clips polygons."""
    return pd.Series([_clipped_area(list(a), list(b), (c, d, e, f)) for a, b, c, d, e, f in zip(xs, ys, x0, y0, x1, y1)])


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point to a segment."""
    dx, dy = bx - ax, by - ay
    f = F.when(dx * dx + dy * dy > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))).otherwise(0.0)
    return F.hypot(px - (ax + f * dx), py - (ay + f * dy))


def line_distance(a: Column, b: Column) -> Column:
    """Distance of two lines (arrays of structs x, y with two vertices at least): 0 where they cross, else the least
    distance of a vertex of one to a segment of the other."""
    def segments(points: Column) -> Column:
        n = F.size(points) - 1
        return F.zip_with(F.slice(points, 1, n), F.slice(points, 2, n), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    def side(p: Column, q: Column, r: Column) -> Column:
        return F.sign((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))

    def to_segments(points: Column, segs: Column) -> Column:
        return F.array_min(F.transform(points, lambda v: F.array_min(F.transform(segs, lambda s: segment_distance(v["x"], v["y"], s["p"]["x"], s["p"]["y"], s["q"]["x"], s["q"]["y"])))))

    sa, sb = segments(a), segments(b)
    cross = F.exists(sa, lambda s: F.exists(sb, lambda r: (side(s["p"], s["q"], r["p"]) * side(s["p"], s["q"], r["q"]) < 0) & (side(r["p"], r["q"], s["p"]) * side(r["p"], r["q"], s["q"]) < 0)))
    return F.when(cross, 0.0).otherwise(F.least(to_segments(a, sb), to_segments(b, sa)))


def authalic_latitude(lat: Column) -> Column:
    """Latitude (radians) on the sphere of equal area."""
    s = F.sin(F.radians(lat))
    qp = 1 - (1 - _E2) / (2 * _E) * math.log((1 - _E) / (1 + _E))
    return F.asin(((1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))) / qp)


#: Square of the radius of the sphere of equal area.
AUTHALIC_R2 = A * A * (1 - (1 - _E2) / (2 * _E) * math.log((1 - _E) / (1 + _E))) / 2


def geodesic_area(lons: list[Column], lats: list[Column]) -> Column:
    """Area on the ellipsoid of a small polygon (corners in degrees, in turn): spherical excess on the sphere of equal area.
    Sides of some kilometres differ from geodesics by far less than a millionth."""
    phi, lam = [authalic_latitude(x) for x in lats], [F.radians(x) for x in lons]
    n = len(lons)

    def excess(i: int) -> Column:
        j = (i + 1) % n
        t = F.tan((lam[j] - lam[i]) / 2)
        u, v = F.tan(phi[i] / 2), F.tan(phi[j] / 2)
        return 2 * F.atan(t * (u + v) / (1 + u * v))

    total = excess(0)
    for i in range(1, n):
        total = total + excess(i)
    return F.abs(total) * AUTHALIC_R2


def ellipsoid_offset(lon: Column, lat: Column, east: Column, north: Column) -> tuple[Column, Column]:
    """Point at small offsets in metres along the parallel and the meridian."""
    s = F.sin(F.radians(lat))
    w = 1 - _E2 * s * s
    prime, meridian = A / F.sqrt(w), A * (1 - _E2) / (w * F.sqrt(w))
    return lon + F.degrees(east / (prime * F.cos(F.radians(lat)))), lat + F.degrees(north / meridian)


def point_in_ring(x: Column, y: Column, points: Column) -> Column:
    """Even-odd rule on a closed ring of structs (x, y)."""
    crossings = F.zip_with(F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points) - 1),
                           lambda a, b: F.when(((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]), 1).otherwise(0))
    return F.aggregate(crossings, F.lit(0), lambda s, v: s + v) % 2 == 1


def destination(lon: Column, lat: Column, bearing: Column, metres: Column, radius: float = 6371008.8) -> tuple[Column, Column]:
    """Point at a distance and bearing on the sphere."""
    p, b, d = F.radians(lat), F.radians(bearing), metres / radius
    lat2 = F.asin(F.sin(p) * F.cos(d) + F.cos(p) * F.sin(d) * F.cos(b))
    lon2 = F.radians(lon) + F.atan2(F.sin(b) * F.sin(d) * F.cos(p), F.cos(d) - F.sin(p) * F.sin(lat2))
    return F.degrees(lon2), F.degrees(lat2)
