"""Statistics kit: normalisation, imputation, modes, histograms, samples, rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.operators.quantiles import average_ranks, group_quantiles


def one_row(df: DataFrame) -> Column:
    """A global aggregate as a scalar subquery: evaluated once, no join at all."""
    return df.select(F.struct("*").alias("_row")).scalar()


def normalised(value: Column, low: Column, high: Column, *, invert: bool = False) -> Column:
    """Clip to [low, high] and stretch to 0..1. NULL when the two bounds meet.

    A NULL value is clipped to ``high`` (``least`` and ``greatest`` skip NULLs),
    so impute first.
    """
    clipped = F.greatest(low, F.least(high, value))
    share = F.try_divide(clipped - low, high - low)
    return 1 - share if invert else share


def stretched(value: Column, low: Column, high: Column) -> Column:
    """Plain min-max to 0..1."""
    return F.try_divide(value - low, high - low)


def normalise(
    df: DataFrame,
    clipped: Mapping[str, tuple[str, bool]] | None = None,
    min_max: Mapping[str, str] | None = None,
    *,
    low: float = 0.01,
    high: float = 0.99,
) -> DataFrame:
    """Add normalised columns, all statistics taken in one aggregation.

    ``clipped`` maps output -> (input, inverted?) for quantile clipping,
    ``min_max`` maps output -> input for the unclipped form. Meant for frames
    with one row per territory: their group state is bounded by the number of
    administrative codes.
    """
    clipped, min_max = clipped or {}, min_max or {}
    aggregates = [
        F.percentile(F.col(source), F.array(F.lit(low), F.lit(high))).alias(f"q_{name}")
        for name, (source, _) in clipped.items()
    ] + [
        F.struct(F.min(source).alias("lo"), F.max(source).alias("hi")).alias(f"m_{name}")
        for name, source in min_max.items()
    ]
    staged = df.withColumn("_stats", one_row(df.agg(*aggregates)))
    added = {
        name: normalised(
            F.col(source), F.col(f"_stats.q_{name}")[0], F.col(f"_stats.q_{name}")[1], invert=inv
        )
        for name, (source, inv) in clipped.items()
    } | {
        name: stretched(F.col(source), F.col(f"_stats.m_{name}.lo"), F.col(f"_stats.m_{name}.hi"))
        for name, source in min_max.items()
    }
    return staged.withColumns(added).drop("_stats")


def impute_by_group_median(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Fill missing values with the median of their group (territory-grain frames)."""
    medians = df.groupBy(key).agg(F.median(value).alias("_median"))
    medians = medians.withColumnRenamed(key, "_key")
    return (
        df.join(medians, F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn(name, F.coalesce(value, "_median"))
        .drop("_key", "_median")
    )


def impute_by_median(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Fill missing values with global medians: output name -> input column."""
    medians = df.agg(*[F.median(source).alias(name) for name, source in columns.items()])
    staged = df.withColumn("_medians", one_row(medians))
    return staged.withColumns(
        {n: F.coalesce(F.col(s), F.col(f"_medians.{n}")) for n, s in columns.items()}
    ).drop("_medians")


def weighted_mean_of_available(weights: Mapping[str, float]) -> Column:
    """Weighted mean over the parts that are not NULL, weights renormalised."""
    top, bottom = F.lit(0.0), F.lit(0.0)
    for name, weight in weights.items():
        top = top + F.lit(weight) * F.coalesce(F.col(name), F.lit(0.0))
        bottom = bottom + F.lit(weight) * F.col(name).isNotNull().cast("double")
    return F.try_divide(top, bottom)


def dominant(df: DataFrame, key: str, category: str, name: str) -> DataFrame:
    """Most frequent category per key, ties by alphabetical order."""
    counts = df.groupBy(key, category).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("_rank"), F.col(category).alias("_category")))
    return (
        counts.groupBy(key)
        .agg(best.alias("_best"))
        .select(key, F.col("_best._category").alias(name))
    )


def histogram(
    df: DataFrame,
    value: str,
    series: Mapping[str, Column],
    bins: int = 60,
    *,
    method: str = "ranked",
) -> DataFrame:
    """Counts per uniform bin from 0 to the p99 rounded to hundreds, one column per series.

    Values above that end are left out; the end itself falls in the last bin.
    Empty bins are present with zeros. Each row carries its bin edges.
    """
    top = group_quantiles(df, [], value, {"p99": 0.99}, method=method).select(
        F.round("p99", -2).alias("hi")
    )
    axis = one_row(top.agg(F.max("hi").alias("hi")))
    placed = df.withColumn("_hi", axis["hi"]).where(F.col(value) <= F.col("_hi"))
    width = F.col("_hi") / F.lit(float(bins))
    counts = (
        placed.withColumn(
            "bin", F.least(F.floor(F.col(value) / width), F.lit(bins - 1)).cast("int")
        )
        .groupBy("bin")
        .agg(*[F.count_if(condition).alias(name) for name, condition in series.items()])
    )
    spark = df.sparkSession
    grid = (
        spark.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .withColumn("_hi", axis["hi"])
        .withColumn("bin_start", F.round(F.col("bin") * width).cast("long"))
        .withColumn("bin_end", F.round((F.col("bin") + 1) * width).cast("long"))
        .drop("_hi")
    )
    return grid.join(counts, "bin", "left").select(
        "bin",
        "bin_start",
        "bin_end",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in series],
    )


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Repeatable sample of ``n`` rows: those with the smallest seeded hash of ``key``.

    A count per hash prefix finds how far to read, so that only about ``n`` rows
    reach the final ordering however large the table is.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))))
    prefix = F.substring("_hash", 1, 4)
    per_prefix = hashed.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    running = per_prefix.withColumn(
        "_before", F.sum("_n").over(Window.orderBy("_prefix")) - F.col("_n")
    )
    last = running.agg(F.max(F.when(F.col("_before") < n, F.col("_prefix"))).alias("_last"))
    return (
        hashed.withColumn("_last", one_row(last)["_last"])
        .where(prefix <= F.col("_last"))
        .orderBy("_hash", key)
        .limit(n)
        .drop("_hash", "_last")
    )


def correlations(df: DataFrame, x: str, y: str) -> DataFrame:
    """Row count, Pearson and Spearman (average ranks) correlation, four decimals."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y)
    ranked = average_ranks(average_ranks(pairs, x, "_rx"), y, "_ry")
    return ranked.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.corr(x, y), 4).alias("pearson"),
        F.round(F.corr("_rx", "_ry"), 4).alias("spearman"),
    )


def rank_stability(
    previous: DataFrame, current: DataFrame, key: str, *, position: str = "rang"
) -> DataFrame:
    """Kendall tau between two short rankings over the items they share.

    Both frames hold one row per ranked item (a top list, tens of rows), so the
    common items fit one array; fewer than two of them gives 1.
    """
    common = previous.select(key, F.col(position).alias("_a")).join(
        current.select(key, F.col(position).alias("_b")), key
    )
    row = common.agg(F.sort_array(F.collect_list(F.struct("_a", "_b"))).alias("_pairs"))
    size = F.size("_pairs")
    concordant = F.aggregate(
        F.transform(
            F.col("_pairs"),
            lambda p, i: F.size(
                F.filter(F.slice(F.col("_pairs"), i + 2, size), lambda q: q._b > p._b)
            ),
        ),
        F.lit(0),
        lambda acc, n: acc + n,
    )
    pairs = size * (size - 1) / F.lit(2.0)
    return row.select(
        size.cast("long").alias("communs"),
        F.when(size < 2, F.lit(1.0)).otherwise((2.0 * concordant - pairs) / pairs).alias("tau"),
    )


def top_ranked(
    df: DataFrame, by: str, ties: Sequence[str], n: int, name: str = "rang"
) -> DataFrame:
    """The ``n`` rows with the largest ``by``, numbered; the window sees only those rows."""
    order = [F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    return (
        df.orderBy(*order)
        .limit(n)
        .withColumn(name, F.row_number().over(Window.orderBy(*order)))
    )
