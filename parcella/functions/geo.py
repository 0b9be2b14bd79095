"""Geometry as plain Spark arrays.

A geometry is a multipolygon ``polygon > ring > point > [lon, lat]``; the first
ring of a polygon is its outline, the others are holes, and every ring is
closed. All functions are native expressions, so geometry never leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY = "array<array<array<array<double>>>>"
EARTH_KM = 6371.0
AUTHALIC_KM = 6371.0072
ECCENTRICITY = 0.0818191908426215  # of the WGS 84 ellipsoid
_Q_POLE = 1 - (1 - ECCENTRICITY**2) / (2 * ECCENTRICITY) * math.log(
    (1 - ECCENTRICITY) / (1 + ECCENTRICITY)
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def box(min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """Rectangle as a one-ring multipolygon."""
    corners = [(min_x, min_y), (max_x, min_y), (max_x, max_y), (min_x, max_y), (min_x, min_y)]
    ring = F.array(*[F.array(x.cast("double"), y.cast("double")) for x, y in corners])
    return F.array(F.array(ring))


# SQL lambda bodies shared by the functions below. ``r`` is a ring.
_PAIRS = (
    "zip_with(slice({r}, 1, greatest(size({r}) - 1, 0)), slice({r}, 2, greatest(size({r}) - 1, 0)),"
    " (a, b) -> struct(a[0] AS x1, a[1] AS y1, b[0] AS x2, b[1] AS y2))"
)
_SIGN = "CASE WHEN i = 0 THEN 1D ELSE -1D END"


def edges(geom: str) -> Column:
    """All edges of all rings as ``struct<x1,y1,x2,y2>``; even-odd counting then
    makes holes work unasked."""
    return F.expr(f"flatten(transform(flatten({geom}), r -> {_PAIRS.format(r='r')}))")


def envelope(geom: str) -> Column:
    """Bounding box as ``struct<min_x,min_y,max_x,max_y>``."""
    xs, ys = (f"transform(flatten(flatten({geom})), p -> p[{i}])" for i in (0, 1))
    return F.expr(
        f"struct(array_min({xs}) AS min_x, array_min({ys}) AS min_y, "
        f"array_max({xs}) AS max_x, array_max({ys}) AS max_y)"
    )


def within_edges(sides: str, x: str, y: str, *, border: bool) -> Column:
    """Point-in-polygon on an edge list; ``border`` says whether the outline counts.

    Even-odd rule on a ray towards +x, plus an exact on-edge test.
    """
    inside = (
        f"aggregate({sides}, 0, (n, e) -> n + CASE WHEN (e.y1 > {y}) <> (e.y2 > {y}) "
        f"AND {x} < e.x1 + ({y} - e.y1) * try_divide(e.x2 - e.x1, e.y2 - e.y1) "
        "THEN 1 ELSE 0 END) % 2 = 1"
    )
    touching = (
        f"exists({sides}, e -> (e.x2 - e.x1) * ({y} - e.y1) = (e.y2 - e.y1) * ({x} - e.x1) "
        f"AND {x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
        f"AND {y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))"
    )
    return F.expr(f"({touching}) OR ({inside})" if border else f"NOT ({touching}) AND ({inside})")


def contains(geom: str, x: str, y: str) -> Column:
    """Strict interior test on a geometry column."""
    return within_edges(_edge_sql(geom), x, y, border=False)


def intersects(geom: str, x: str, y: str) -> Column:
    """Interior or border test on a geometry column."""
    return within_edges(_edge_sql(geom), x, y, border=True)


def _edge_sql(geom: str) -> str:
    return f"flatten(transform(flatten({geom}), r -> {_PAIRS.format(r='r')}))"


def centroid(geom: str) -> Column:
    """Area-weighted centroid as ``struct<lon,lat>``; holes weigh negatively.

    Each ring is reduced to its area and first moments relative to its first
    point, which keeps digits.
    """
    shoelace = (
        f"aggregate({_PAIRS.format(r='r')}, struct(0D AS a, 0D AS mx, 0D AS my), (acc, e) -> "
        "struct(acc.a + {c} AS a, acc.mx + (e.x1 + e.x2 - 2 * r[0][0]) * {c} AS mx, "
        "acc.my + (e.y1 + e.y2 - 2 * r[0][1]) * {c} AS my))"
    ).replace(
        "{c}",
        "((e.x1 - r[0][0]) * (e.y2 - r[0][1]) - (e.x2 - r[0][0]) * (e.y1 - r[0][1]))",
    )
    parts = (
        f"flatten(transform({geom}, polygon -> transform(transform(polygon, (r, i) -> struct("
        f"{shoelace} AS s, {_SIGN} AS sign, r[0][0] AS x, r[0][1] AS y)), q -> struct("
        "abs(q.s.a) * q.sign AS w, q.x + try_divide(q.s.mx, q.s.a * 3D) AS x, "
        "q.y + try_divide(q.s.my, q.s.a * 3D) AS y)))"
        ")"
    )
    weighted = (
        f"aggregate({parts}, struct(0D AS w, 0D AS x, 0D AS y), (acc, p) -> struct("
        "acc.w + p.w AS w, acc.x + coalesce(p.w * p.x, 0D) AS x, "
        "acc.y + coalesce(p.w * p.y, 0D) AS y), "
        "t -> struct(try_divide(t.x, t.w) AS lon, try_divide(t.y, t.w) AS lat))"
    )
    return F.expr(weighted)


def authalic_sine(lat: str, double: str = "D") -> str:
    """SQL: sine of the authalic latitude of degrees ``lat`` on the WGS 84 ellipsoid.

    On the sphere of equal area a band between two authalic latitudes has the area that the
    ellipsoid has between the geographic ones (Snyder, Map Projections, 1987, eq. 3-11, 3-12).
    ``double`` marks literals as floating in the SQL at hand.
    """
    e, sine = ECCENTRICITY, f"sin(radians({lat}))"
    q = (
        f"({1 - e * e!r}{double} * ({sine} / (1 - {e * e!r}{double} * {sine} * {sine}) "
        f"- {1 / (2 * e)!r}{double} * ln((1 - {e!r}{double} * {sine}) / (1 + {e!r}{double} * {sine}))))"
    )
    return f"({q} / {_Q_POLE!r}{double})"


def area_km2(geom: str, ellipsoid: bool = True) -> Column:
    """Area on the ellipsoid, or on the sphere of equal area, holes removed.

    Edges are straight in longitude and (authalic) sine of latitude, as in Chamberlain and
    Duquette (JPL 2007): exact for boxes along meridians and parallels.
    """
    sines = [authalic_sine(f"e.y{n}") if ellipsoid else f"sin(radians(e.y{n}))" for n in (1, 2)]
    ring = (
        f"abs(aggregate({_PAIRS.format(r='r')}, 0D, (acc, e) -> acc + radians(e.x2 - e.x1) "
        f"* (2D + {sines[0]} + {sines[1]}))) * {_SIGN}"
    )
    rings = f"flatten(transform({geom}, polygon -> transform(polygon, (r, i) -> {ring})))"
    return F.expr(f"aggregate({rings}, 0D, (acc, v) -> acc + v) * {AUTHALIC_KM**2 / 2.0!r}D")


def arc_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, haversine form (stable for coincident points)."""
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.least(F.lit(1.0), half))) * (2 * EARTH_KM)


def snapped(geom: Column | str, digits: int) -> Column:
    """Coordinates rounded to ``digits`` decimals, then repaired.

    Rounding can collapse small islands and holes: consecutive duplicate points
    go, rings left with fewer than three distinct points go, and a polygon goes
    with its outline.
    """

    def grid(ring: Column) -> Column:
        points = F.transform(ring, lambda p: F.transform(p, lambda v: F.round(v, digits)))
        return F.filter(points, lambda p, i: (i == 0) | (p != F.get(points, i - 1)))

    rounded = F.transform(_col(geom), lambda polygon: F.transform(polygon, grid))
    alive = F.filter(rounded, lambda polygon: _is_ring(polygon[0]))
    return F.transform(alive, lambda polygon: F.filter(polygon, _is_ring))


def _is_ring(ring: Column) -> Column:
    return F.size(F.array_distinct(ring)) >= 3


def to_geojson(geom: Column | str) -> Column:
    """GeoJSON text: Polygon for one part, MultiPolygon for several, NULL for none."""
    g = _col(geom)
    return F.when(
        F.size(g) == 1,
        F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(g, F.lit(0)).alias("coordinates"))),
    ).when(
        F.size(g) > 1,
        F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), g.alias("coordinates"))),
    )


def from_geojson(text: Column | str, depth: int = 4) -> Column:
    """Polygonal parts of a GeoJSON geometry text, as a multipolygon.

    Points and lines are dropped. Collections may nest ``depth`` deep; deeper
    input raises instead of losing parts.
    """
    raw = _col(text)
    head = F.from_json(raw, "type string, coordinates string, geometries array<string>")
    empty = F.array().cast(GEOMETRY)
    if depth == 0:
        nested = F.raise_error(F.lit("geometry collection nested too deeply")).cast(GEOMETRY)
    else:
        nested = F.flatten(F.transform(head.geometries, lambda g: from_geojson(g, depth - 1)))
    return (
        F.when(raw.isNull(), F.lit(None).cast(GEOMETRY))
        .when(
            head.type == "Polygon",
            F.array(F.from_json(head.coordinates, "array<array<array<double>>>")),
        )
        .when(head.type == "MultiPolygon", F.from_json(head.coordinates, GEOMETRY))
        .when(head.type == "GeometryCollection", nested)
        .otherwise(empty)
    )
