"""Spatial joins as equi-joins on grid cells followed by an exact test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcella.functions import geo

DEFAULT_CELL = 0.25


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(float(size)))


def polygon_cells(
    polygons: DataFrame, geom: str, cell: float, keep: Sequence[str]
) -> DataFrame:
    """One row per (polygon, grid cell that it covers) with the edges a test there needs.

    Cells come from the boxes of the single parts, so the sea between islands gives none.
    The even-odd ray runs along +x: only edges that meet the cell's row, at the cell or
    right of it, can matter. A cell that no edge touches is all inside or all outside, as
    its centre is: outside ones go, inside ones need no test (``_edges`` is NULL).
    """
    size, slack = repr(float(cell)), repr(float(cell) * 1e-9)
    span = {
        axis: f"sequence(floor(b.{axis}0 / {size}D), floor(b.{axis}1 / {size}D))" for axis in "xy"
    }
    ends = ", ".join(
        f"array_{f}(transform(g[0], p -> p[{i}])) AS {axis}{n}"
        for i, axis in enumerate("xy")
        for n, f in enumerate(("min", "max"))
    )
    parts = f"transform(filter({geom}, g -> size(g) > 0 AND size(g[0]) > 0), g -> struct({ends}))"
    rows = (
        polygons.select(*keep, geo.edges(geom).alias("_edges"), F.expr(parts).alias("_parts"))
        .withColumn(
            "_cy", F.expr(f"explode(array_distinct(flatten(transform(_parts, b -> {span['y']}))))")
        )
        .withColumn(
            "_edges",
            F.expr(
                f"filter(_edges, e -> least(e.y1, e.y2) <= (_cy + 1) * {size}D + {slack}D "
                f"AND greatest(e.y1, e.y2) >= _cy * {size}D - {slack}D)"
            ),
        )
    )
    in_row = f"filter(_parts, b -> floor(b.y0 / {size}D) <= _cy AND floor(b.y1 / {size}D) >= _cy)"
    cells = rows.withColumn(
        "_cx",
        F.expr(f"explode(array_distinct(flatten(transform({in_row}, b -> {span['x']}))))"),
    ).withColumn(
        "_edges", F.expr(f"filter(_edges, e -> greatest(e.x1, e.x2) >= _cx * {size}D - {slack}D)")
    )
    touched = F.expr(f"exists(_edges, e -> least(e.x1, e.x2) <= (_cx + 1) * {size}D + {slack}D)")
    centre = geo.within_edges(
        "_edges", f"((_cx + 0.5D) * {size}D)", f"((_cy + 0.5D) * {size}D)", border=True
    )
    return (
        cells.withColumn("_touched", touched)
        .where(F.col("_touched") | centre)
        .withColumn("_edges", F.when(F.col("_touched"), F.col("_edges")))
        .drop("_touched", "_parts")
    )


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    *,
    x: str,
    y: str,
    keep: Sequence[str],
    geom: str = "geom",
    key: str | None = None,
    border: bool = False,
    cell: float = DEFAULT_CELL,
) -> DataFrame:
    """Pairs of points and the polygons that hold them (inner join).

    ``keep`` are the polygon columns to return; ``key`` is an optional column
    both sides must also agree on. Cells spread dense areas over many join keys
    and no broadcast is forced: Spark broadcasts the cells only when their
    measured size is under its threshold, else it shuffles and splits skew.
    """
    shared = [key] if key else []
    kept = [c for c in keep if c != key]
    cells = polygon_cells(polygons, geom, cell, [*shared, *kept])
    located = points.withColumn("_cx", _cell(F.col(x), cell)).withColumn(
        "_cy", _cell(F.col(y), cell)
    )
    return (
        located.join(cells, [*shared, "_cx", "_cy"])
        .where(F.col("_edges").isNull() | geo.within_edges("_edges", x, y, border=border))
        .drop("_cx", "_cy", "_edges")
    )


def count_points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    *,
    x: str,
    y: str,
    code: str,
    name: str,
    geom: str = "geom",
    cell: float = DEFAULT_CELL,
) -> DataFrame:
    """Points strictly inside each polygon; polygons without points keep a zero."""
    counts = (
        points_in_polygons(points, polygons, x=x, y=y, keep=[code], geom=geom, cell=cell)
        .groupBy(code)
        .agg(F.count(F.lit(1)).alias(name))
    )
    return polygons.join(counts, code, "left").withColumn(name, F.coalesce(name, F.lit(0)))
