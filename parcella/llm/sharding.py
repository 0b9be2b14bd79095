"""Shards by fixed virtual slots.

A record's key is hashed into one of thousands of virtual slots that never change. Rows
and bytes are summed by slot (map-side combined, one row per slot whatever the input),
and a small versioned table maps slots to shards. Version 0 is dealt by bytes; later
versions come from editing the stored map before it: ``rebalance`` moves slots from full to
empty shards, ``grow`` moves slots into one more shard. Records are never rehashed. Every
version stays in its own folder; a pointer beside them names the newest (``snapshots``).

Defined cases: null text has no bytes; rows without a key are spread by their text; rows
that share a key share a slot, and equal ones are numbered in any order; a text of any length
counts by its bytes; an empty table gives an empty result; extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcella.sources import snapshots
from parcella.sources.staging import staged

N_SLOTS = 4096
#: Gap between the fullest and the emptiest shard, as a share of the mean, that needs no edit.
TOLERANCE = 1e-4
MAP_SCHEMA = "version int, virtual_slot int, shard int, n_rows long, n_bytes long"


def slot_of(key, n_slots: int = N_SLOTS):
    """Virtual slot of a key column."""
    return F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int")


def slot_loads(records: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, rows, bytes) of the slots in use: at most ``n_slots`` rows, so they fit the driver."""
    found = records.groupBy("virtual_slot").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")
    )
    return sorted((r["virtual_slot"], r["n"], r["b"]) for r in found.collect())


def deal(loads, n_shards: int) -> dict[int, int]:
    """First map: heaviest slot first, each to the lightest shard, then evened out."""
    weight = [0] * n_shards
    shard_of = {}
    for slot, _, size in sorted(loads, key=lambda x: (-x[2], x[0])):
        to = min(range(n_shards), key=lambda s: (weight[s], s))
        shard_of[slot] = to
        weight[to] += size
    return rebalance(shard_of, loads, n_shards)


def rebalance(shard_of: dict[int, int], loads, n_shards: int) -> dict[int, int]:
    """Edit a map: move or swap slots from the fullest to the emptiest shard while it helps."""
    shard_of = dict(shard_of)
    size = {slot: b for slot, _, b in loads}
    for slot in size:  # a slot that had no rows when the map was made
        shard_of.setdefault(slot, slot % n_shards)
    members: list[set[int]] = [set() for _ in range(n_shards)]
    for slot in size:
        members[shard_of[slot]].add(slot)
    weight = [sum(size[s] for s in m) for m in members]
    for _ in range(4 * len(size) + 1):
        full = max(range(n_shards), key=lambda s: (weight[s], -s))
        empty = min(range(n_shards), key=lambda s: (weight[s], s))
        gap = weight[full] - weight[empty]
        if gap * n_shards <= TOLERANCE * sum(weight):
            break
        best, give, take = gap, None, None
        back = sorted([(size[s], s) for s in members[empty]] + [(0, None)], key=lambda x: x[0])
        j = 0
        for b, slot in sorted((size[s], s) for s in members[full]):
            # the exchange that halves the gap best: b - x near gap / 2
            while j + 1 < len(back) and abs(gap - 2 * (b - back[j + 1][0])) <= abs(
                gap - 2 * (b - back[j][0])
            ):
                j += 1
            left = abs(gap - 2 * (b - back[j][0]))
            if left < best:
                best, give, take = left, slot, back[j][1]
        if give is None:
            break
        for slot, a, z in ((give, full, empty), (take, empty, full)):
            if slot is not None:
                members[a].discard(slot)
                members[z].add(slot)
                weight[a] -= size[slot]
                weight[z] += size[slot]
                shard_of[slot] = z
    return shard_of


def grow(shard_of: dict[int, int], loads, n_shards: int) -> dict[int, int]:
    """Edit a map for one more shard: slots move only into it, from the fullest shards."""
    shard_of = dict(shard_of)
    size = {slot: b for slot, _, b in loads}
    weight = [0] * (n_shards + 1)
    for slot, b in size.items():
        weight[shard_of[slot]] += b
    goal = sum(weight) / (n_shards + 1)
    for slot in sorted(size, key=lambda s: (-size[s], s)):
        home = shard_of[slot]
        if weight[home] - size[slot] >= goal * 0.98 and weight[-1] + size[slot] <= goal * 1.02:
            shard_of[slot] = n_shards
            weight[home] -= size[slot]
            weight[-1] += size[slot]
    return shard_of


def map_table(spark, versions: list[dict[int, int]], loads) -> DataFrame:
    """The stored form of a map: every version, one row per slot (``MAP_SCHEMA``)."""
    load = {slot: (n, b) for slot, n, b in loads}
    rows = [
        (v, slot, shard, *load.get(slot, (0, 0)))
        for v, shard_of in enumerate(versions)
        for slot, shard in sorted(shard_of.items())
    ]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def load_map(spark, path: str) -> tuple[int, dict[int, int], int] | None:
    """(version, shard of each slot, number of shards) of the newest stored map; None if none is."""
    found = snapshots.current(spark, path)
    if found is None:
        return None
    rows = snapshots.table(spark, path).select("virtual_slot", "shard").collect()  # n_slots at most
    return int(found["version"]), {r["virtual_slot"]: r["shard"] for r in rows}, found["n_shards"]


def append_version(spark, path: str, version: int, shard_of: dict[int, int], n_shards: int, loads) -> None:
    """Store a version of the map beside those before it and make it the newest."""
    rows = map_table(spark, [shard_of], loads).withColumn("version", F.lit(version))

    def write(folder: str) -> dict:
        rows.write.parquet(folder)
        return {"n_shards": n_shards}

    snapshots.commit(spark, path, write, str(version))


def edited(shard_of: dict[int, int], before: int, loads, n_shards: int) -> dict[int, int]:
    """The map after today's loads: rebalanced, or grown to more shards, one at a time."""
    if n_shards < before:
        raise ValueError(f"the stored map has {before} shards; they only grow")
    if n_shards == before:
        return rebalance(shard_of, loads, n_shards)
    shard_of = dict(shard_of)
    weight = [0] * before
    for slot, _, b in loads:
        if slot in shard_of:
            weight[shard_of[slot]] += b
    for slot, _, b in loads:  # slots that had no rows so far
        if slot not in shard_of:
            shard_of[slot] = min(range(before), key=lambda s: (weight[s], s))
            weight[shard_of[slot]] += b
    for n in range(before, n_shards):
        shard_of = grow(shard_of, loads, n)
    return shard_of


def current_map(spark, loads, n_shards: int, path: str | None) -> tuple[int, dict[int, int]]:
    """(version, map) for today's loads: the stored map, edited and appended where it changes."""
    known = load_map(spark, path) if path else None
    if known is None:
        version, shard_of = 0, deal(loads, n_shards)
    else:
        version, before, n_before = known
        shard_of = edited(before, n_before, loads, n_shards)
        if shard_of == before and n_shards == n_before:
            return version, shard_of
        version += 1
    if path:
        append_version(spark, path, version, shard_of, n_shards, loads)
    return version, shard_of


def shard_records(
    docs: DataFrame,
    n_shards: int = 8,
    n_slots: int = N_SLOTS,
    id_col: str = "doc_id",
    text: str = "text",
    map_path: str | None = None,
) -> DataFrame:
    """One row per record: ``doc_id, size, text_crc32, virtual_slot, shard, slot, map_version``.

    ``slot`` numbers the rows of a shard from 0 without gaps: rows are numbered inside
    their virtual slot and shifted by the rows of the shard's slots before it, so no
    shard is ever sorted as a whole. With ``map_path`` the newest map stored there is taken,
    edited for today's loads and number of shards, and appended where that changes it.
    """
    spark = docs.sparkSession
    body = F.col(f"`{text}`")
    records = staged(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.when(F.col(f"`{id_col}`").isNull(), slot_of(body, n_slots))
            .otherwise(slot_of(F.col(f"`{id_col}`"), n_slots))
            .alias("virtual_slot"),
        ),
        "records",
    )
    loads = slot_loads(records)
    version, shard_of = current_map(spark, loads, n_shards, map_path)
    mapped = map_table(spark, [shard_of], loads)
    ahead = (
        Window.partitionBy("shard")
        .orderBy("virtual_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    places = mapped.select(
        F.col("virtual_slot").alias("_slot"),
        "shard",
        F.lit(version).alias("map_version"),
        F.coalesce(F.sum("n_rows").over(ahead), F.lit(0)).alias("_ahead"),
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    return (
        records.withColumn("_place", F.row_number().over(inside) - 1)
        .join(F.broadcast(places), F.col("virtual_slot") == F.col("_slot"))  # n_slots rows
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("_ahead") + F.col("_place")).cast("long").alias("slot"),
            "virtual_slot",
            "map_version",
        )
    )
