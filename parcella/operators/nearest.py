"""Nearest-neighbour join on a curve over the sphere.

Places are unit vectors, ordered by the Morton curve through the cube around the sphere, so
poles and the date line are nothing special. Up to ``PLACES`` of them (checked by counting)
make one small tree that goes to every task, and the left rows are not shuffled. More are
cut into ranges of the curve of about ``PLACES`` each:

1. every left row goes to the range of its own place on the curve and gets the nearest of
   that range's tree; a range with many left rows is dealt to several tasks, each with a copy
   of its places, one copy for ``LEFT_ROWS`` rows;
2. only rows whose ball (radius: the distance found, or that to the far side of the nearest
   box) meets the box of another range go there in a second pass.

Places are copied once, and once more for each ``LEFT_ROWS`` left rows of their range. What
the driver and every task hold besides is one cut, one box and one count a range.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcella.functions.geo import EARTH_KM
from parcella.sources.staging import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package

#: Places of one tree, left rows that one copy of a range serves, and places of a tree's leaf.
PLACES, LEFT_ROWS, LEAF = 65_536, 1_000_000, 32
#: Places of each range whose keys set the cuts.
SAMPLED = 64
#: Slack of bounds against rounding, in units of the Earth's radius (six millimetres).
SLACK = 1e-9


def on_sphere(lat, lon):
    """Unit vectors (n, 3) of degrees."""
    import numpy as np

    phi, lam = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)], axis=1)


def curve_keys(points):
    """Morton keys of 3 x 21 bits, along which neighbours on the sphere mostly stay close."""
    import numpy as np

    cells = np.clip((points + 1) * 2**20, 0, 2**21 - 1).astype(np.int64)
    keys = np.zeros(len(points), np.int64)
    for bit in range(21):
        for axis in range(3):
            keys |= ((cells[:, axis] >> bit) & 1) << (3 * bit + axis)
    return keys


def chord(km):
    """Length of the straight line below an arc of ``km``, in Earth radii."""
    import numpy as np

    return 2 * np.sin(np.minimum(km / (2 * EARTH_KM), np.pi / 2))


def arcs_km(lat1, lon1, lat2, lon2):
    """Great-circle distance, haversine form."""
    import numpy as np

    half = (
        np.sin(np.radians(lat2 - lat1) / 2) ** 2
        + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    )
    return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(1.0, half)))


def box_distances(points, low, high):
    """Chords from every point to the near and to the far side of every box, (n, boxes) each."""
    import numpy as np

    near = np.zeros((len(points), len(low)))
    far = np.zeros_like(near)
    for axis in range(3):
        p = points[:, axis, None]
        below, above = low[:, axis] - p, p - high[:, axis]
        near += np.maximum(0, np.maximum(below, above)) ** 2
        far += np.maximum(np.abs(below), np.abs(above)) ** 2
    return np.sqrt(near), np.sqrt(far)


class Tree:
    """Places in curve order, in leaves with boxes; ``places`` is an Arrow table of
    ``_rlat, _rlon, _rid`` and anything else."""

    def __init__(self, places) -> None:
        import numpy as np

        lat, lon = (np.asarray(places.column(c), np.float64) for c in ("_rlat", "_rlon"))
        order = np.argsort(curve_keys(on_sphere(lat, lon)), kind="stable")
        self.places = places.take(order)
        self.lat, self.lon = lat[order], lon[order]
        ids = self.places.column("_rid").to_pylist()
        self.rank = np.empty(len(ids), np.int64)
        self.rank[sorted(range(len(ids)), key=ids.__getitem__)] = np.arange(len(ids))
        points, starts = on_sphere(self.lat, self.lon), np.arange(0, len(ids), LEAF)
        self.low, self.high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)

    def nearest(self, lat, lon, limit):
        """(place or -1, km) of the nearest within ``limit`` km of each point; ties by id."""
        import numpy as np

        found, best = np.full(len(lat), -1), np.array(limit, np.float64)
        for start in range(0, len(lat), 256):
            part = slice(start, start + 256)
            found[part], best[part] = self._nearest(lat[part], lon[part], best[part])
        return found, best

    def _nearest(self, lat, lon, limit):
        import numpy as np

        near, far = box_distances(on_sphere(lat, lon), self.low, self.high)
        reach = np.minimum(chord(limit), far.min(axis=1)) + SLACK
        first = near.argmin(axis=1)
        rows = np.arange(len(lat))
        found, best = self._visit(lat, lon, rows, first, np.full(len(lat), -1), limit.copy())
        reach = np.minimum(reach, chord(best) + SLACK)
        near[rows, first] = np.inf
        rows, leaves = np.nonzero(near <= reach[:, None])
        return self._visit(lat, lon, rows, leaves, found, best)

    def _visit(self, lat, lon, rows, leaves, found, best):
        """Compare rows with all places of their leaves; ``rows`` ascend."""
        import numpy as np

        for start in range(0, len(rows), 8_192):
            r, at = rows[start : start + 8_192], leaves[start : start + 8_192, None] * LEAF + np.arange(LEAF)
            past = at >= len(self.lat)
            at = np.minimum(at, len(self.lat) - 1)
            km = arcs_km(lat[r, None], lon[r, None], self.lat[at], self.lon[at])
            km[past] = np.inf
            least = km.min(axis=1)
            rank = np.where(km == least[:, None], self.rank[at], np.iinfo(np.int64).max)
            pick = rank.argmin(axis=1)
            each = np.arange(len(r))
            order = np.lexsort((rank[each, pick], least, r))
            one = order[np.unique(r[order], return_index=True)[1]]  # the best leaf of each row
            row, km, place = r[one], least[one], at[one, pick[one]]
            held = found[row]
            better = (km < best[row]) | (
                (km == best[row]) & ((held < 0) | (self.rank[place] < self.rank[held]))
            )
            found[row[better]], best[row[better]] = place[better], km[better]
        return found, best


def _answers(batch, tree: Tree, lat: str, lon: str, limit):
    """Arrow columns of the nearest place of every row: ``_km, _rid, _kept`` (null: none)."""
    import numpy as np
    import pyarrow as pa

    at, km = tree.nearest(
        np.asarray(batch.column(lat), np.float64), np.asarray(batch.column(lon), np.float64), limit
    )
    places = pa.array(np.where(at < 0, 0, at), mask=at < 0)
    found = tree.places.select(["_rid", "_kept"]).take(places)
    kept = (found.column(c).combine_chunks() for c in ("_rid", "_kept"))
    return [pa.array(km, mask=at < 0), *kept]


def _small(origin: DataFrame, places, fields: str, max_km: float) -> DataFrame:
    """Every left row against one tree, where it lies."""
    shared = origin.sparkSession.sparkContext.broadcast(places)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tree = Tree(shared.value)
        for batch in batches:
            if batch.num_rows:
                found = _answers(batch, tree, "_lat", "_lon", np.full(batch.num_rows, max_km))
                yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=["_key", "_km", "_rid", "_kept"])

    return origin.mapInArrow(run, fields)


def _cuts(targets: DataFrame, total: int, per_range: int) -> list[int]:
    """First keys of all ranges but the first, from a sample of ``SAMPLED`` places a range."""
    import numpy as np

    ranges = -(-total // per_range)
    wanted = ranges * SAMPLED
    least = F.pmod(F.xxhash64("_rlat", "_rlon"), F.lit(1 << 30)) < int(2**30 * min(1.0, 1.2 * wanted / total)) + 1
    some = targets.where(least).select("_rlat", "_rlon").toArrow()
    keys = np.sort(curve_keys(on_sphere(*(np.asarray(some.column(c), np.float64) for c in (0, 1)))))
    at = (np.arange(1, ranges) * len(keys)) // ranges
    return np.unique(keys[at]).tolist() if len(keys) else []


def _with_range(df: DataFrame, lat: str, lon: str, cuts) -> DataFrame:
    """``df`` with the curve range of each row as ``_range``."""
    shared = df.sparkSession.sparkContext.broadcast(cuts)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            points = on_sphere(*(np.asarray(batch.column(c), np.float64) for c in (lat, lon)))
            ranges = np.searchsorted(np.array(shared.value, np.int64), curve_keys(points), side="right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ranges.astype(np.int32))], names=[*batch.schema.names, "_range"]
            )

    return df.mapInArrow(run, f"{_fields(df)}, _range int")


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _visit_ranges(origin: DataFrame, places: DataFrame, slices: dict[int, int], boxes, fields: str) -> DataFrame:
    """Nearest place of the row's range within its ``_limit``; with ``boxes``, also ``_others``,
    the ranges whose boxes its ball still meets.

    Places come first in the sorted rows of a (range, slice); left rows stream past the tree.
    """
    dense = [F.lit(x) for r, n in slices.items() if n > 1 for x in (r, n)]
    n_slices = F.coalesce(F.create_map(*dense)[F.col("_range")], F.lit(1)) if dense else F.lit(1)
    left = origin.select(
        "_range", F.pmod(F.xxhash64("_key", "_lat", "_lon"), n_slices).cast("int").alias("_slice"),
        F.lit(1).alias("_side"), "_key", "_lat", "_lon", "_limit",
    )
    copies = F.explode(F.sequence(F.lit(0), n_slices - 1)).alias("_slice")
    right = places.select("_range", copies, F.lit(0).alias("_side"), "_rlat", "_rlon", "_rid", "_kept")
    both = left.unionByName(right, allowMissingColumns=True)
    dealt = both.repartition("_range", "_slice").sortWithinPartitions("_range", "_slice", "_side")
    shared = origin.sparkSession.sparkContext.broadcast(boxes)
    with_others = boxes is not None

    def run(batches):
        import numpy as np
        import pyarrow as pa

        current, parts, tree = None, [], None
        place_columns = ["_rlat", "_rlon", "_rid", "_kept"]
        for batch in batches:
            group = np.asarray(batch.column("_range"), np.int64) << 32 | np.asarray(batch.column("_slice"), np.int64)
            side = np.asarray(batch.column("_side"))
            starts = np.flatnonzero(np.diff(group * 2 + side, prepend=group[:1] * 2 + side[:1] - 1)) if len(group) else []
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                rows = batch.slice(start, end - start)
                if group[start] != current:
                    current, parts, tree = group[start], [], None
                if side[start] == 0:
                    parts.append(rows.select(place_columns))
                    continue
                if tree is None and parts:
                    tree, parts = Tree(pa.Table.from_batches(parts)), []
                limit = np.asarray(rows.column("_limit"), np.float64)
                if tree is None:  # a range without places
                    kinds = (pa.float64(), *(rows.schema.field(c).type for c in ("_rid", "_kept")))
                    found = [pa.nulls(rows.num_rows, t) for t in kinds]
                    km = limit
                else:
                    found = _answers(rows, tree, "_lat", "_lon", limit)
                    km = np.where(np.asarray(found[0].is_null()), limit, np.asarray(found[0].fill_null(0.0)))
                columns = [rows.column(c) for c in ("_key", "_lat", "_lon")] + found
                if with_others:
                    ids, low, high = shared.value
                    own = int(group[start] >> 32)
                    lat, lon = (np.asarray(rows.column(c), np.float64) for c in ("_lat", "_lon"))
                    others, reach = [], np.empty(len(km))
                    for a in range(0, len(km), 256):
                        near, far = box_distances(on_sphere(lat[a : a + 256], lon[a : a + 256]), low, high)
                        bound = np.minimum(chord(km[a : a + 256]), far.min(axis=1)) + SLACK
                        near[:, ids == own] = np.inf
                        others += [ids[x].tolist() for x in near <= bound[:, None]]
                        reach[a : a + 256] = np.minimum(km[a : a + 256], 2 * EARTH_KM * np.arcsin(np.minimum(1, bound / 2)))
                    columns += [pa.array(reach), pa.array(others, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"{_fields(origin.select('_key', '_lat', '_lon'))}, {fields}"
    names = ["_key", "_lat", "_lon", "_km", "_rid", "_kept"]
    if with_others:
        schema += ", _reach double, _others array<int>"
        names += ["_reach", "_others"]
    return dealt.mapInArrow(run, schema)


def _large(origin: DataFrame, targets: DataFrame, fields: str, max_km: float, per_range: int, left_rows: int) -> DataFrame:
    """Both sides cut into ranges of the curve; see the module's text."""
    import numpy as np

    cuts = _cuts(targets, targets.count(), per_range)
    places = staged(_with_range(targets, "_rlat", "_rlon", cuts), "places")
    phi, lam = "radians(_rlat)", "radians(_rlon)"
    axes = {"x": f"cos({phi}) * cos({lam})", "y": f"cos({phi}) * sin({lam})", "z": f"sin({phi})"}
    ends = places.groupBy("_range").agg(
        *[f(F.expr(e)).alias(f"{n}{a}") for n, f in (("low", F.min), ("high", F.max)) for a, e in axes.items()]
    ).orderBy("_range").collect()  # one row a range
    boxes = (
        np.array([r["_range"] for r in ends]),
        np.array([[r[f"low{a}"] for a in "xyz"] for r in ends]) - SLACK,
        np.array([[r[f"high{a}"] for a in "xyz"] for r in ends]) + SLACK,
    )
    located = staged(_with_range(origin, "_lat", "_lon", cuts).withColumn("_limit", F.lit(float(max_km))), "located")

    def slices(df: DataFrame) -> dict[int, int]:
        return {r["_range"]: -(-r["count"] // left_rows) for r in df.groupBy("_range").count().collect()}  # one row a range

    first = staged(_visit_ranges(located, places, slices(located), boxes, fields), "first")
    done = first.select("_key", "_lat", "_lon", "_km", "_rid", "_kept")
    again = staged(
        first.select("_key", "_lat", "_lon", F.col("_reach").alias("_limit"), F.explode("_others").alias("_range")),
        "crossing",
    )
    second = _visit_ranges(again, places, slices(again), None, fields)
    open_rows = F.size("_others") > 0
    settled = first.where(~open_rows).select("_key", "_km", "_rid", "_kept")
    best = (
        first.where(open_rows).select(*done.columns).unionByName(second)
        .groupBy("_key", "_lat", "_lon")
        .agg(F.min(F.when(F.col("_km").isNotNull(), F.struct("_km", "_rid", "_kept"))).alias("_b"))
        .select("_key", "_b._km", "_b._rid", "_b._kept")
    )
    return settled.unionByName(best)


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    *,
    key: str,
    left_at: tuple[str, str],
    right_at: tuple[str, str],
    right_id: str,
    keep: Sequence[str],
    distance: str,
    max_km: float,
    places: int = PLACES,
    left_rows: int = LEFT_ROWS,
) -> DataFrame:
    """Nearest right row within ``max_km`` of each left row; ties by ``right_id``.

    Exact and free of cross joins; right rows at one place count as one, that of the smallest
    id. Rows without coordinates take no part, and ``key`` tells left rows apart. ``*_at``
    are (lat, lon) column names.
    """
    r_lat, r_lon = (F.col(c).cast("double") for c in right_at)
    targets = (
        right.where(r_lat.isNotNull() & r_lon.isNotNull() & ~F.isnan(r_lat) & ~F.isnan(r_lon))
        .groupBy(r_lat.alias("_rlat"), r_lon.alias("_rlon"))
        .agg(F.min(F.struct(F.col(right_id).alias("_rid"), F.struct(*keep).alias("_kept"))).alias("_r"))
        .select("_rlat", "_rlon", "_r.*")
    )
    lat, lon = (F.col(c).cast("double") for c in left_at)
    origin = left.where(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)).select(
        F.col(key).alias("_key"), lat.alias("_lat"), lon.alias("_lon")
    )
    kind = _fields(targets.select("_rid", "_kept"))
    few = targets.limit(places + 1).toArrow()
    if few.num_rows == 0:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in targets.schema.fields[2:]]
        found = origin.where("false").select("_key", F.lit(None).cast("double").alias("_km"), *nothing)
    elif few.num_rows <= places:
        found = _small(origin, few, f"{_fields(origin.select('_key'))}, _km double, {kind}", float(max_km))
    else:
        found = _large(origin, staged(targets, "targets"), f"_km double, {kind}", float(max_km), places, left_rows)
    return found.where("_km IS NOT NULL").select(
        F.col("_key").alias(key),
        *[F.col(f"_kept.{c}").alias(c) for c in keep],
        F.col("_km").alias(distance),
    )
