"""URL filters by a sorted sweep over reversed hosts.

A host's canonical key is its labels in reverse, each followed by a dot
(``www.example.com`` is ``com.example.www.``), so a rule host and all its subdomains are
one interval of keys, and intervals of rule hosts are nested or disjoint. Starts and ends
of the intervals and all pages are range-partitioned by key and sorted once; running
window functions keep the stack of open intervals: a running sum of starts and ends is
the depth, and the last start seen at each depth is that level of the stack. What is open
at the first key of a range is found from that key's own prefixes. A page then takes, of
the rules on its stack whose path is a prefix of its own, the longest.

Only built-in functions; a hot host is spread over ranges, as the range order goes on
with a hash of the row. Defined cases: a null URL, or one without ``://``, has empty host
and path and fits no rule; a rule stated twice blocks if either says so; without rules
every page gets the default; a URL of any length is read whole; repeated rows are each
judged; an empty table gives an empty result; extra columns are ignored unless asked for with
``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.sources.staging import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts after every character, so ``key + LAST`` ends the interval of ``key``.
LAST = "\U0010ffff"
#: ``://``, the host, the path.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
CARRIED, START, PAGE, END = 0, 1, 2, 3


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed host, a dot after each label."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def prefixes(key: Column) -> Column:
    """All keys of the host itself and of the hosts above it, shortest first."""
    labels = F.split(F.rtrim(key, F.lit(".")), r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")),
    )


def rules_by_host(rules: DataFrame) -> DataFrame:
    """``key, rules``: all rules of one host as one stack entry (rules of a host fit a row)."""
    return (
        rules.where("host is not null and path is not null")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block sorts after allow
        .withColumn("rule", F.concat("host", "path"))
        .groupBy(host_key(F.col("host")).alias("key"))
        .agg(F.sort_array(F.collect_list(F.struct("path", "rule", "verdict"))).alias("rules"))
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    keep: tuple[str, ...] = ("page_id",),
    default: str = "allow",
) -> DataFrame:
    """One row per page: the ``keep`` columns, ``host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` (allow or block).
    """
    column = F.col(f"`{url}`")
    seen = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept"),
        host_of(column).alias("host"),
        path_of(column).alias("path"),
    )
    by_host = staged(rules_by_host(rules), "rules")
    own = by_host.select("key", F.explode(prefixes(F.col("key"))).alias("above"))
    depth = (
        own.join(by_host.select(F.col("key").alias("above")), "above", "left_semi")
        .groupBy("key")
        .count()
        .agg(F.coalesce(F.max("count"), F.lit(0)).alias("n"))
        .first()["n"]
    )
    none = by_host.schema["rules"].dataType
    starts = by_host.select(
        "key", F.lit(START).alias("kind"), F.lit(0).cast("long").alias("tie"), "rules"
    )
    ends = by_host.select(F.concat("key", F.lit(LAST)).alias("key"), F.lit(END).alias("kind"))
    here = seen.select(
        host_key(F.col("host")).alias("key"),
        F.lit(PAGE).alias("kind"),
        F.xxhash64("kept", "path").alias("tie"),
        "kept",
        "host",
        "path",
    )
    events = staged(
        here.unionByName(starts, allowMissingColumns=True)
        .unionByName(ends, allowMissingColumns=True)
        .repartitionByRange("key", "kind", "tie")
        .withColumn("slice", F.spark_partition_id()),
        "sweep",
    )
    firsts = events.groupBy("slice").agg(F.min(F.struct("key", "kind")).alias("first"))
    carried = (
        firsts.select("slice", "first", F.explode(prefixes(F.col("first.key"))).alias("key"))
        .where((F.col("key") != F.col("first.key")) | (F.col("first.kind") != START))
        .join(by_host, "key")
        .select("slice", "key", F.lit(CARRIED).alias("kind"), "rules")
    )
    order = Window.partitionBy("slice").orderBy(
        F.col("kind") != CARRIED, "key", "kind"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(F.col("kind") == END, -1).when(F.col("kind") == PAGE, 0).otherwise(1)
    swept = events.unionByName(carried, allowMissingColumns=True).withColumn(
        "depth", F.sum(step).over(order)
    )
    opened = (F.col("kind") == START) | (F.col("kind") == CARRIED)
    levels = [
        F.last(F.when(opened & (F.col("depth") == d), F.col("rules")), ignorenulls=True)
        .over(order)
        .alias(f"level{d}")
        for d in range(1, depth + 1)
    ]
    stacks = swept.select("kind", "kept", "host", "path", "depth", *levels).where(
        F.col("kind") == PAGE
    )
    fitting = [
        F.filter(
            F.when(F.col("depth") >= d, F.col(f"level{d}")).otherwise(F.array().cast(none)),
            lambda r: F.startswith(F.col("path"), r["path"]),
        )
        for d in range(1, depth + 1)
    ]
    best = F.array_max(
        F.transform(
            F.concat(*fitting) if fitting else F.array().cast(none),
            lambda r: F.struct(
                F.length(r["rule"]).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict")
            ),
        )
    )
    return stacks.withColumn("best", best).select(
        *(F.col("kept")[c].alias(c) for c in keep),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
