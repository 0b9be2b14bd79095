from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcella.operators import quantiles, sales, stats


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, with ties, negatives and a missing value."""
    rng = np.random.default_rng(7)
    frame = pd.DataFrame(
        {
            "g": np.where(rng.random(6000) < 0.6, "hot", rng.integers(0, 20, 6000).astype(str)),
            "x": np.round(rng.lognormal(7, 1, 6000), 1) * rng.choice([1, 1, 1, -1], 6000),
        }
    )
    frame.loc[3, "x"] = None
    return frame, spark.createDataFrame(frame).withColumn("x", F.nanvl("x", F.lit(None)))


#: All groups collected whole, the hot one bracketed, the hot one left to the histogram, the others.
WAYS = [
    {"method": "bracketed"},
    {"method": "bracketed", "small": 0},
    {"method": "bracketed", "small": 0, "large": 1000},
    {"method": "ranked"},
    {"method": "state"},
]


@pytest.mark.parametrize("way", WAYS)
def test_exact_quantiles_match_numpy(skewed, way):
    frame, df = skewed
    probabilities = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0, "f": 0.0}
    got = quantiles.group_quantiles(df, ["g"], "x", probabilities, **way).toPandas()
    expected = frame.groupby("g")["x"].quantile(list(probabilities.values())).unstack()
    expected.columns = list(probabilities)
    got = got.set_index("g").loc[expected.index, list(probabilities)]
    np.testing.assert_allclose(got, expected, rtol=1e-12)


def test_result_does_not_depend_on_partitions(spark, skewed):
    _, df = skewed
    seen = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows = quantiles.group_quantiles(
            df.repartition(int(n)), ["g"], "x", {"m": 0.5, "p": 0.9}
        ).collect()
        seen.append(sorted(tuple(r) for r in rows))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


def test_null_group_and_facts(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double"
    )
    facts = {"n": (F.count(F.lit(1)), F.sum), "lo": (F.min("x"), F.min)}
    rows = quantiles.group_quantiles(df, ["g"], "x", {"m": 0.5}, facts=facts).collect()
    assert {(r.g, r.n, r.lo, r.m) for r in rows} == {(None, 2, 1.0, 2.0), ("a", 1, 5.0, 5.0)}


def test_unknown_method(spark):
    with pytest.raises(ValueError, match="unknown"):
        quantiles.group_quantiles(spark.range(1), [], "id", {"m": 0.5}, method="guess")


def test_weighted_median_is_the_lower_one(spark):
    df = spark.createDataFrame(
        [(2021, 1800.0, 8), (2021, 1400.0, 2), (2024, 2000.0, 10), (2024, 1500.0, 3)],
        "y int, v double, w int",
    )
    got = {r.y: r.weighted_median for r in quantiles.weighted_median(df, ["y"], "v", "w").collect()}
    assert got == {2021: 1800.0, 2024: 2000.0}


def test_average_ranks_match_pandas(skewed):
    frame, df = skewed
    got = quantiles.average_ranks(df, "x", "r").where("x IS NOT NULL").toPandas()
    expected = dict(zip(frame.x, frame.x.rank(method="average") - 1))
    assert all(expected[x] == r for x, r in zip(got.x, got.r))


def test_correlations_match_pandas(spark, skewed):
    frame, _ = skewed
    pairs = frame.dropna().assign(y=lambda f: f.x.rank() % 97)
    row = stats.correlations(spark.createDataFrame(pairs[["x", "y"]]), "x", "y").first()
    assert row.n == len(pairs)
    assert row.pearson == pytest.approx(pairs.x.corr(pairs.y), abs=1e-4)
    assert row.spearman == pytest.approx(pairs.x.rank().corr(pairs.y.rank()), abs=1e-4)


def test_sample_is_the_bottom_of_the_hash(spark):
    import hashlib

    df = spark.range(3000).select(F.col("id").cast("string").alias("id"))
    got = [r.id for r in stats.seeded_sample(df, "id", 40).collect()]
    order = sorted(map(str, range(3000)), key=lambda i: hashlib.md5(f"{i}42".encode()).hexdigest())
    assert got == order[:40]
    assert stats.seeded_sample(df, "id", 5000).count() == 3000


def test_histogram_counts_every_value_up_to_the_end(spark):
    prices = [float(v) for v in range(1000, 6000, 10)]
    df = spark.createDataFrame([(p, "Maison") for p in prices], "prix_m2 double, type_local string")
    rows = stats.histogram(df, "prix_m2", {"n": F.lit(True)}, bins=10).orderBy("bin").collect()
    assert [r.bin for r in rows] == list(range(10))
    assert rows[0].bin_start == 0
    assert sum(r.n for r in rows) == len([p for p in prices if p <= rows[-1].bin_end])
    assert rows[0].n == 0


def test_normalise_and_missing_weights(spark):
    df = spark.createDataFrame([(1000.0,), (2000.0,), (3000.0,)], "p double")
    rows = stats.normalise(df, {"n": ("p", False), "i": ("p", True)}).orderBy("p").collect()
    assert [r.n for r in rows] == pytest.approx([0.0, 0.5, 1.0])
    assert [r.i for r in rows] == pytest.approx([1.0, 0.5, 0.0])
    flat = spark.createDataFrame([(5.0,), (5.0,)], "p double")
    assert [r.n for r in stats.normalise(flat, {"n": ("p", False)}).collect()] == [None, None]
    parts = spark.createDataFrame([(0.5, None), (None, None)], "a double, b double")
    got = parts.select(stats.weighted_mean_of_available({"a": 0.3, "b": 0.7})).collect()
    assert [r[0] for r in got] == [0.5, None]


def test_dominant_breaks_ties_alphabetically(spark):
    df = spark.createDataFrame(
        [("x", "D"), ("x", "C"), ("y", "A"), ("y", "B"), ("y", "B")], "k string, c string"
    )
    got = {r.k: r.top for r in stats.dominant(df, "k", "c", "top").collect()}
    assert got == {"x": "C", "y": "B"}


@pytest.mark.parametrize(
    ("a", "b", "tau"),
    [
        ("abcd", "abcd", 1.0),
        ("abcd", "dcba", -1.0),
        ("abcd", "bacd", 4 / 6),
        ("ab", "xy", 1.0),
    ],
)
def test_rank_stability(spark, a, b, tau):
    frames = [
        spark.createDataFrame([(c, i + 1) for i, c in enumerate(s)], "k string, rang int")
        for s in (a, b)
    ]
    assert stats.rank_stability(*frames, "k").first().tau == pytest.approx(tau)


def test_plans_have_no_cartesian_product_and_no_row_level_single_partition(spark, skewed):
    _, df = skewed
    plan = quantiles.group_quantiles(df, ["g"], "x", {"m": 0.5})._jdf.queryExecution().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert banned not in plan
    clipped = sales.clip_by_group(df, ["g"], "x")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in clipped


@pytest.mark.parametrize("method", ["bracketed", "ranked", "state"])
def test_null_and_nan_by_one_rule(spark, method):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", None), ("c", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    facts = {"n": (F.count(F.lit(1)), F.sum)}
    got = quantiles.group_quantiles(df, ["g"], "x", {"m": 0.5}, facts=facts, method=method)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 4, 2.0), ("b", 1, None), ("c", 1, None)]


def test_brackets_of_a_large_group_hold_the_ranks(spark):
    """200,000 values in odd order and with ties, far more than a sketch keeps."""
    df = spark.range(200_000, numPartitions=7).selectExpr("'g' AS g", "floor(pow(id * 7919 % 200000 / 1e3, 2)) * 1D AS x")
    wanted = {f"p{k}": k / 1000 for k in (0, 1, 10, 250, 333, 500, 999, 1000)}
    ways = [
        quantiles.group_quantiles(df, ["g"], "x", wanted, method=m).first() for m in ("bracketed", "state")
    ]
    assert ways[0] == ways[1]


def test_rows_are_not_shuffled_to_meet_what_was_found(skewed):
    _, df = skewed
    for method, most in (("bracketed", 1), ("ranked", 4)):
        plan = quantiles.group_quantiles(df, ["g"], "x", {"m": 0.5}, method=method)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") <= most, plan


@pytest.mark.parametrize("way", [{}, {"small": 0}, {"small": 0, "large": 1000}])
def test_discrete_quantiles_are_exact_in_large_groups(spark, way):
    """Nearest rank over 120,000 rows in several orders; a sketch is off by some ranks."""
    n = 120_000
    rows = spark.range(n).select(
        F.lit("g").alias("g"), ((F.col("id") * 7919 + 13) % n).cast("double").alias("x")
    )
    wanted = {"a": 0.01, "b": 0.07, "c": 0.25, "d": 0.5, "e": 0.99, "f": 1.0, "z": 0.0}
    for parts in (1, 7):
        got = quantiles.group_quantiles(rows.repartition(parts), ["g"], "x", wanted, method="discrete", **way).first()
        assert [got[k] for k in wanted] == [1199.0, 8399.0, 29999.0, 59999.0, 118799.0, 119999.0, 0.0]
