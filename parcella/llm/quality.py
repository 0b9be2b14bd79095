"""Quality rules of a document, and of the host it comes from.

Each document is measured in one scan of its whole text. Failures are counted for each
rule and host (here: the source); a host's failure rate is shrunk towards all hosts by a
beta prior fitted to the hosts' rates by moments, so a host with few documents is judged
mostly by the rest. A host fails if its shrunk rate of a rule is over ``host_limit``, or an
outlier: with posterior certainty above the middle between the mean of all other hosts and
1. A document is kept if it fails no rule and its host does not fail.

Only built-in functions; one map-side combined aggregation by host. Only failing hosts are
joined to the documents: broadcast up to ``BROADCAST_HOSTS`` of them, counted first, and by
host and salt beyond, so no host's documents meet in one task.

Defined cases: null text counts as empty (and fails, having no words); null hosts are one
host; repeated rows count as often as they stand; a rate that equals its limit passes; a
text of any length is measured whole, within its row; an empty table gives an empty result;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcella.llm.common import BLANKS, WORD
from parcella.sources.staging import staged

SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50
#: Name of a rule and the condition under which a document fails it.
RULES = {
    "few_words": f"n_words < {FEWEST_WORDS}",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * word_chars",
    "dup_lines": "n_lines > 0 and 100 * n_dup_lines > 60 * n_lines",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
BASE_RULES = ("few_words", "repeats")
HOST_LIMIT = 0.8
#: Most failing hosts that are broadcast, and parts of a host beyond.
BROADCAST_HOSTS, SALTS = 100_000, 32
#: Standard deviations of the posterior that an outlier's rate stays above its limit (99 %).
CERTAIN = 2.33


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A plain column of an inner select would be copied into every place of a filter that
    the optimiser pushes below it.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur more than once.

    The windows' hashes are sorted with their places, so equal ones stand side by side;
    the places found are then merged where windows overlap.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.xxhash64(
            F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)
        ),
    )
    found = let(
        windows,
        lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
            let(F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), _covered)
        ),
    )
    return F.when(F.size(words) > 3, found).otherwise(F.lit(0)).cast("long")


def _covered(ranked: Column) -> Column:
    """Words covered by the windows that have an equal neighbour in hash order."""
    repeated = F.filter(
        F.transform(
            ranked,
            lambda x, k: F.when(
                (F.get(ranked, k - 1)["h"] == x["h"]) | (F.get(ranked, k + 1)["h"] == x["h"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    return F.aggregate(
        F.sort_array(repeated),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct(
            (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")
        ),
        lambda s: s["n"],
    )


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The ``keep`` columns and the counts of every document."""
    ids = [F.col(f"`{c}`") for c in keep]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = docs.select(*ids, body.alias("_t")).select("*", words_of(F.col("_t")).alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    return words.select("*", lines.alias("_l")).select(
        *ids,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w")).alias("n_repeat_words"),
    )


def failures() -> dict[str, Column]:
    return {name: F.expr(rule) for name, rule in RULES.items()}


def host_verdicts(measured: DataFrame, host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """``host, n_docs, worst_rate, host_failed``: shrunk failure rates of every host.

    For each rule the hosts' rates have mean m and variance v; the beta prior with these
    moments has strength m (1 - m) / v - 1. With equal rates (v = 0) the prior holds all
    the weight; with a strength below 0 it holds none. Outliers have a rule whose posterior
    rate, less ``CERTAIN`` standard deviations, is above (1 + mean of the other hosts) / 2;
    a single host has no others and equal rates no outlier.
    """
    counts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *(F.count_if(c).alias(f"f_{r}") for r, c in failures().items()),
    )
    rate = {r: F.col(f"f_{r}") / F.col("n_docs") for r in RULES}
    moments = counts.agg(
        F.count(F.lit(1)).alias("hosts"),
        *(F.avg(x).alias(f"m_{r}") for r, x in rate.items()),
        *(F.var_pop(x).alias(f"v_{r}") for r, x in rate.items()),
    ).first()  # one row
    shrunk, outlying = [], []
    others = moments["hosts"] - 1
    for r in RULES:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        strength = max(0.0, m * (1 - m) / v - 1) if v > 0 else None
        shrunk.append(
            F.lit(m)
            if strength is None
            else (F.col(f"f_{r}") + F.lit(m * strength)) / (F.col("n_docs") + F.lit(strength))
        )
        if strength is not None and others:
            spread = F.sqrt(shrunk[-1] * (1 - shrunk[-1]) / (F.col("n_docs") + F.lit(strength + 1)))
            limit = (1 + (F.lit(m * (others + 1)) - rate[r]) / others) / 2
            outlying.append(shrunk[-1] - CERTAIN * spread > limit)
    worst = F.greatest(*shrunk)
    return counts.select(
        "host", "n_docs", worst.alias("worst_rate"),
        reduce(or_, outlying, worst > host_limit).alias("host_failed"),
    )


def _against_failing(
    measured: DataFrame, verdicts: DataFrame, how: str, most: int = BROADCAST_HOSTS
) -> DataFrame:
    """``measured`` joined by ``how`` to its failing hosts (``_host, _failed``), unshuffled while they are few."""
    failing = staged(
        verdicts.where("host_failed").select(F.col("host").alias("_host"), F.lit(True).alias("_failed")),
        "failing_hosts",
    )
    if failing.count() <= most:
        return measured.join(F.broadcast(failing), F.col("source").eqNullSafe(F.col("_host")), how)
    salted = measured.withColumn("_salt", F.monotonically_increasing_id() % SALTS)
    spread = failing.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.col("source").eqNullSafe(F.col("_host")) & (F.col("_salt") == F.col("_part"))
    return salted.join(spread, same, how)


def apply_rules(
    docs: DataFrame, text: str = "text", host: str = "source", id_col: str = "doc_id",
    host_limit: float = HOST_LIMIT, most: int = BROADCAST_HOSTS,
) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed``, ``host_failed``, ``kept``."""
    measured = staged(measure(docs, text, (id_col, host)).toDF("doc_id", "source", *COUNTS), "measured")
    judged = _against_failing(measured, host_verdicts(measured, "source", host_limit), "left", most)
    base = F.expr(" or ".join(f"({RULES[r]})" for r in BASE_RULES))
    host_failed = F.coalesce("_failed", F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), host_failed.alias("host_failed"),
        (~reduce(or_, failures().values()) & ~host_failed).alias("kept"),
    )


def kept_documents(docs: DataFrame, host_limit: float = HOST_LIMIT, most: int = BROADCAST_HOSTS) -> DataFrame:
    """Documents that the method keeps, with the columns of ``docs``, ids unique or not.

    Every text is measured once: documents that pass the rules are stored whole, of the
    others only the counts, by which their hosts are judged.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    passed = ~reduce(or_, failures().values())
    measured = measure(docs.select(row, "text", "source"), "text", ("row", "source"))
    judged = staged(measured.select("source", *COUNTS, F.when(passed, F.col("row")).alias("row")), "judged")
    hosts = host_verdicts(judged.select("source", *COUNTS), "source", host_limit)
    kept = _against_failing(judged.where(passed), hosts, "left_anti", most)
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))
