"""Exact order statistics that survive a group holding most of the rows.

Spark's own ``percentile`` keeps every distinct value of a group in one
aggregation state, which is fine while groups are small (territory-grain
tables) and fatal when one group owns a third of the sales. Two ways avoid it,
both exact:

* ``bracketed``: one map-side combined pass takes a quantile sketch of each
  group, whose values a little below and above each wanted share bracket the
  rank; a second pass counts what lies below the brackets and collects only what
  lies in them. That is two narrow reads and two small shuffles. A group of up
  to ``SMALL`` rows is collected whole, one over ``LARGE`` goes the other way.
* ``ranked``: a monotone bucket of the value gives a histogram per group
  (map-side combined, a few thousand rows per group at most), a running sum over
  it finds which bucket holds each rank, and only rows of those buckets are
  counted by value and ordered, one task per (group, bucket). It also takes
  weights.

What was found for each group is stored before the second read, so its size is
known and the rows are not shuffled to meet it.

One rule for every method: facts are taken over all rows of a group, NULL and NaN
values never enter a quantile, and a group without any other value has NULL quantiles.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.sources.staging import staged

# A group-level aggregate carried along: first-stage aggregate, aggregate that
# merges the partial column, and optionally a function of the merged column.
Fact = tuple

# Relative width of a bucket is about 1/1024, so a price range of 100..50,000
# spreads one hot group over some 6,000 buckets.
BUCKETS_PER_E_FOLD = 1024

# Sketches err by 1/ACCURACY of a group's rows at most; brackets reach MARGIN of them
# to both sides. A bracket holds 2 * (MARGIN + 1/ACCURACY) * LARGE rows and the ties of its
# ends, so never more than LARGE numbers.
ACCURACY, MARGIN = 2_000, 0.004
SMALL, LARGE = 4_096, 4_000_000


def monotone_bucket(value: Column) -> Column:
    """Order-preserving coarse key of a finite double."""
    step = F.floor(F.log1p(F.abs(value)) * BUCKETS_PER_E_FOLD)
    return F.when(value < 0, -step).otherwise(step)


def usable(value: Column) -> Column:
    """The value, NULL in place of NaN."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def _merged(name: str, fact: Fact, group) -> Column:
    whole = fact[1](name).over(group)
    return fact[2](whole) if len(fact) > 2 else whole


def select_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    targets: Mapping[str, str],
    *,
    weight: str | None = None,
    facts: Mapping[str, Fact] | None = None,
) -> DataFrame:
    """Per group, the smallest value whose cumulative weight reaches each target.

    ``targets`` maps an output name to a SQL expression of ``_total``, the
    group's total weight over rows with a value. ``facts`` adds group-level
    aggregates over all rows (see ``Fact``). The output has ``keys``, one column
    per fact, ``_total`` and one column per target; a group without a value has
    NULL targets.
    """
    facts = facts or {}
    keys = list(keys)
    w = F.col(weight) if weight else F.lit(1)
    rows = df.withColumn("_bucket", monotone_bucket(usable(F.col(value))))
    reached = {n: f"({t}) > _before AND ({t}) <= _before + _w" for n, t in targets.items()}

    # rows without a value share the NULL bucket, which has facts but no weight
    histogram = rows.groupBy(*keys, "_bucket").agg(
        F.sum(F.when(F.col("_bucket").isNotNull(), w).otherwise(F.lit(0))).alias("_w"),
        *[fact[0].alias(name) for name, fact in facts.items()],
    )
    group = Window.partitionBy(*keys)
    placed = histogram.select(
        *keys,
        "_bucket",
        (F.sum("_w").over(group.orderBy("_bucket")) - F.col("_w")).alias("_before"),
        "_w",
        F.sum("_w").over(group).alias("_total"),
        *[_merged(name, fact, group).alias(name) for name, fact in facts.items()],
    )
    constant = ["_before", "_total", *facts]
    found_at = staged(placed.where(" OR ".join(["_total = 0", *reached.values()])), "located")
    empty = found_at.where("_total = 0").groupBy(*keys, "_total", *facts).agg(
        *[F.lit(None).cast("double").alias(n) for n in targets]
    )
    located = found_at.where("_total > 0").selectExpr(
        *[f"{k} AS _key{i}" for i, k in enumerate(keys)], "_bucket AS _at", *constant
    )

    same_place = " AND ".join(["_bucket = _at", *[f"{k} <=> _key{i}" for i, k in enumerate(keys)]])
    counted = (
        rows.select(*keys, "_bucket", F.col(value).alias("_value"), w.alias("_weight"))
        .join(located, F.expr(same_place))
        .groupBy(*keys, "_bucket", *constant, "_value")
        .agg(F.sum("_weight").alias("_w"))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_value")
    ordered = counted.withColumn(
        "_before", F.col("_before") + F.sum("_w").over(inside) - F.col("_w")
    )
    found = ordered.groupBy(*keys, "_total", *facts).agg(
        *[F.expr(f"max(CASE WHEN {test} THEN _value END)").alias(n) for n, test in reached.items()]
    )
    return found.unionByName(empty)


def _interpolated(lo: str, hi: str, position: str, name: str) -> str:
    """``lo`` and ``hi``, the values around a zero-based ``position``, as SQL."""
    share = f"({position} - floor({position}))"
    return f"{lo} * (1D - {share}) + {hi} * {share} AS {name}"


def _position(p: float) -> str:
    return f"((_total - 1) * {float(p)!r}D)"


def _nearest(p: float) -> str:
    """Zero-based rank of the first value that reaches share ``p``; in decimals, so that
    a whole product is not lifted over the next rank."""
    return f"CAST(greatest(1, ceil(_total * {float(p)!r}BD)) - 1 AS DOUBLE)"


def _ranked(df, keys, value, probabilities, facts, discrete: bool = False) -> DataFrame:
    targets, wanted = {}, []
    for name, p in probabilities.items():
        if discrete:
            targets[f"_at_{name}"] = f"{_nearest(p)} + 1"
            wanted.append(f"_at_{name} AS {name}")
            continue
        targets[f"_lo_{name}"] = f"floor({_position(p)}) + 1"
        targets[f"_hi_{name}"] = f"ceil({_position(p)}) + 1"
        wanted.append(_interpolated(f"_lo_{name}", f"_hi_{name}", _position(p), name))
    found = select_ranks(df, keys, value, targets, facts=facts)
    return found.selectExpr(*keys, *facts, *wanted)


def _bracketed(
    df, keys, value, probabilities, facts, small: int, large: int, discrete: bool = False
) -> DataFrame:
    small = max(small, math.ceil(1 / (MARGIN - 1 / ACCURACY)))  # a bracket reaches over one rank
    v = usable(F.col(value))
    shares = [s for p in probabilities.values() for s in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))]
    sketched = staged(
        df.groupBy(*keys).agg(
            F.count(v).alias("_total"),
            F.percentile_approx(v, shares, ACCURACY).alias("_cuts"),
            *[fact[0].alias(name) for name, fact in facts.items()],
        ),
        "sketched",
    )
    located = sketched.selectExpr(
        *[f"{k} AS _key{i}" for i, k in enumerate(keys)], "_total", "_cuts", *facts
    )
    same_group = F.expr(" AND ".join(f"{k} <=> _key{i}" for i, k in enumerate(keys)))
    rows = df.select(*keys, v.alias("_v")).where("_v IS NOT NULL")
    few = F.col("_total") <= small
    parts = [F.collect_list(F.when(few, F.col("_v"))).alias("_all")]
    wanted = []
    for j, (name, p) in enumerate(probabilities.items()):
        lo, hi = (F.col("_cuts")[2 * j + side] for side in (0, 1))
        parts.append(F.count_if(~few & (F.col("_v") < lo)).alias(f"_below{j}"))
        parts.append(F.collect_list(F.when(~few & F.col("_v").between(lo, hi), F.col("_v"))).alias(f"_in{j}"))
        # ranks from 1: of the small group's values, or of the bracket's after those below it;
        # one outside would be an error, as no element is at 0 or past the end
        at = _nearest(p) if discrete else _position(p)
        picks = [
            f"element_at(IF(_total <= {small}, _all, _in{j}), "
            f"greatest(0, int({f}({at}) + 1 - IF(_total <= {small}, 0, _below{j}))))"
            for f in ("floor", "ceil")
        ]
        wanted.append(f"{picks[0]} AS {name}" if discrete else _interpolated(*picks, at, name))
    lists = ["_all", *(f"_in{j}" for j in range(len(probabilities)))]
    counted = (
        rows.join(located.where(F.col("_total") <= large), same_group)
        .groupBy(*keys, "_total", *facts)
        .agg(*parts)
    )
    for name in lists:
        counted = counted.withColumn(name, F.sort_array(name))
    empty = [F.lit(None).cast("double").alias(n) for n in probabilities]
    found = counted.selectExpr(*keys, *facts, *wanted).unionByName(
        sketched.where("_total = 0").select(*keys, *facts, *empty)
    )
    if sketched.where(F.col("_total") > large).isEmpty():
        return found
    crowded = located.where(F.col("_total") > large).drop("_total", "_cuts", *facts)
    rest = df.join(crowded, same_group, "left_semi")
    return found.unionByName(_ranked(rest, keys, value, probabilities, facts, discrete))


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    *,
    facts: Mapping[str, Fact] | None = None,
    method: str = "bracketed",
    small: int = SMALL,
    large: int = LARGE,
) -> DataFrame:
    """Quantiles per group, one column per probability, interpolated if not said otherwise.

    ``method``:

    * ``bracketed`` - exact, splits hot groups, for row-grain data of any size;
      ``small`` and ``large`` are the group sizes described above;
    * ``ranked`` - the same result by a histogram; taken if there are no ``keys``;
    * ``state`` - exact, Spark's ``percentile``; the caller chooses it for frames
      whose groups are bounded, such as one row per administrative code;
    * ``discrete`` - the smallest value whose share of the rows reaches the probability
      (``percentile_disc``): exact, found like ``bracketed``, not interpolated;
    * ``approx`` - ``percentile_approx``: the same rule, but a rank may be off by a
      10,000th of the group, and by where the rows lie.
    """
    facts = facts or {}
    keys = list(keys)
    if method in ("state", "approx"):
        pick = F.percentile if method == "state" else F.percentile_approx
        quantiles = [
            pick(usable(F.col(value)), float(p)).alias(name) for name, p in probabilities.items()
        ]
        return df.groupBy(*keys).agg(
            *[fact[0].alias(name) for name, fact in facts.items()], *quantiles
        )
    if method not in ("bracketed", "ranked", "discrete"):
        raise ValueError(f"unknown quantile method {method!r}")
    discrete = method == "discrete"
    if method == "ranked" or not keys:
        return _ranked(df, keys, value, probabilities, facts, discrete)
    return _bracketed(df, keys, value, probabilities, facts, small, large, discrete)


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """Lower weighted median per group: the smallest value reaching half the weight."""
    half = {"weighted_median": "_total / 2"}
    return select_ranks(df, keys, value, half, weight=weight).select(*keys, "weighted_median")


def average_ranks(df: DataFrame, value: str, name: str) -> DataFrame:
    """Zero-based rank of ``value`` with ties averaged, without a global sort task.

    Values are counted once each, ordered inside their bucket, and shifted by
    the number of rows in lower buckets.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", monotone_bucket(F.col("_value")))
    )
    per_bucket = counted.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    offsets = per_bucket.select(
        "_bucket",
        (F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")).alias("_before"),
    )
    inside = Window.partitionBy("_bucket").orderBy("_value")
    ranks = counted.join(offsets, "_bucket").select(
        "_value",
        (
            F.col("_before")
            + F.sum("_n").over(inside)
            - F.col("_n")
            + (F.col("_n") - 1) / F.lit(2.0)
        ).alias(name),
    )
    return df.join(ranks, F.col(value) == F.col("_value"), "left").drop("_value")
