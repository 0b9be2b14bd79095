"""Mix sources to target weights, by exact budgets.

Every document gets a hash-random key. Within a source the key space is cut into equal
ranges; sizes are summed by range first, so a prefix sum over the few ranges of a source
gives each range its offset, and a running sum inside a range does the rest. A source of
any size is thus spread over as many tasks as it has ranges. The budget of a source is
cut at an exact word: whole epochs first, then the documents before the cut.

Only built-in functions. Defined cases: null text has size 0; null sources are one
source, last in order; repeated rows count as often as they stand; a source without
words has target 0 and gives nothing; equal keys go by id, then size; a text of any length is
only counted; an empty table gives an empty result; further columns pass through, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.llm.common import free_name, n_words
from parcella.sources.staging import staged

#: Hex digits of the key that name a range: 16 ** 3 ranges for each source.
RANGE_DIGITS = 3
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from one row per source (``source, source_size``).

    The common level L solves sum(min(most * size, weight * L)) = sum(size). Sources in
    the order of most * size / weight fill up first, so two running sums over one row per
    source give the level that would hold if just the sources before were full; it rises
    up to the true level and falls after it.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"),
    )
    room = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = room.rowsBetween(Window.unboundedPreceding, -1)
    after = room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    return (
        sizes.withColumn("_w", weight)
        .withColumn("_cap", (F.col("source_size") * most).cast("double"))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
        .withColumn(
            "_level",
            (
                F.sum("source_size").over(every).cast("double")
                - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
            )
            / F.sum("_w").over(after),
        )
        .withColumn("_level", F.max("_level").over(every))
        .select(
            "source",
            "source_size",
            F.least("_cap", F.col("_w") * F.col("_level")).alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``taken`` is the number of words the mix takes of the document, whole epochs and the
    cut included. The order within a source is by the MD5 of seed and id, so reruns agree.
    """
    rows = staged(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.col(f"`{source}`").alias("source"),
            n_words(F.col(f"`{text}`")).alias("size"),
            F.md5(
                F.concat_ws("/", F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
            ).alias("key"),
        ),
        "mix",
    ).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    wanted = targets(
        ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, most
    )
    earlier = (
        Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
    offsets = offsets.join(wanted, offsets["source"].eqNullSafe(wanted["source"])).select(
        offsets["source"].alias("_source"), F.col("range").alias("_range"),
        "offset", "source_size", "target",
    )
    inner = (
        Window.partitionBy("source", "range")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    budget = F.floor("target")
    rest = budget - epochs(budget) * F.col("source_size")
    return placed.join(
        offsets,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range")),
    ).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (
            epochs(budget) * F.col("size")
            + F.greatest(
                F.lit(0), F.least(F.col("size"), rest - F.col("offset") - F.col("before"))
            )
        )
        .cast("long")
        .alias("taken"),
    )


def epochs(budget: Column) -> Column:
    """Whole passes over the source that the budget holds."""
    return F.when(
        F.col("source_size") > 0, F.floor(budget / F.col("source_size"))
    ).otherwise(F.lit(0))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document as often as its taken
    words need it; the one document a source's cut goes through stays whole.

    Rows that share an id share one decision, so ids should be unique; a null id is an id.
    """
    id_col = options.get("id_col", "doc_id")
    taken = (
        mix(docs, **options)
        .where("taken > 0")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.ceil(F.max(F.col("taken") / F.col("size"))).cast("int").alias("_times"))
    )
    copy = free_name(docs, "copy")
    return (
        docs.join(taken, docs[id_col].eqNullSafe(taken["_id"]))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), taken["_times"])))
        .select(*(docs[f"`{c}`"] for c in docs.columns))
    )
