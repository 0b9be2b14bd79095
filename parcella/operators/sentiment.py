"""A sentiment scorer learnt from the reviews themselves.

Reviewers say which field a text goes into, so every segment has a declared polarity. Words
get their log-odds between the two fields, shrunk towards 0 where they are rare, counted over
segments of the reviews that are not held out. A segment's score is the sum of its words'
weights, bent into (-1, 1). Weights are whole thousandths, so a score does not depend on the
order of summation.

Everything is a map-side combined count or a join: a bounded number of common words travels
with the tasks, all others meet their weights by join, for which only segments that hold such
words are shuffled, and the table of weights is stored, so its size is known.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.functions import text
from parcella.operators.stats import correlations, one_row
from parcella.operators.words import CODE, POSITIVE, Weights, held_out, totals, word_counts
from parcella.sources.staging import staged

#: Segments that a word must occur in, and those that halve its log-odds.
LEAST_SEGMENTS, SHRINKAGE = 5, 20
UNIT = 1000
#: Most words that a scorer on the driver may hold.
WORDS_IN_MEMORY = 200_000
#: Words whose weights travel with the tasks (about 60 MB), and letters that such a word may have.
COMMON_WORDS, LONGEST_COMMON = 2_000_000, 64


def learn_polarity(segments: DataFrame, counts: DataFrame, least: int = LEAST_SEGMENTS) -> DataFrame:
    """``word, weight`` (long, thousandths of log-odds) by ``counts`` (``words.word_counts``) of
    the segments that are not held out, and in how many of them the word is (``n_segments``).

    Add-one counts; a word in k segments keeps k / (k + ``SHRINKAGE``) of its log-odds.
    """
    up = F.col("polarity_field") == POSITIVE
    sides = segments.where(~held_out()).agg(F.count_if(up).alias("up"), F.count_if(~up).alias("down")).first()  # one row
    summed = (
        counts.where("word IS NOT NULL AND up + down > 0")
        .groupBy("word")
        .agg(F.sum("up").alias("_p"), F.sum("down").alias("_n"))
        .where(F.col("_p") + F.col("_n") >= least)
    )
    p = (F.col("_p") + 1) / F.lit(float(sides["up"] + 2))
    n = (F.col("_n") + 1) / F.lit(float(sides["down"] + 2))
    k = F.col("_p") + F.col("_n")
    weight = F.round(F.lit(float(UNIT)) * F.log(p / n) * (k / (k + SHRINKAGE)))
    return summed.select("word", weight.cast("long").alias("weight"), k.alias("n_segments"))


def bent(total: Column) -> Column:
    """A sum of weights as a score in (-1, 1)."""
    return total / (F.abs(total) + F.lit(float(UNIT)))


def common_words(weights: DataFrame, most: int) -> DataFrame:
    """Words of most segments, at most ``most``; of those in equally many segments all or none."""
    short = weights.where(F.length("word") <= LONGEST_COMMON)
    by_segments = short.groupBy("n_segments").agg(F.count(F.lit(1)).alias("_words"))
    up_to = F.sum("_words").over(Window.orderBy(F.desc("n_segments")))
    fit = by_segments.select("n_segments", up_to.alias("_up_to")).where(F.col("_up_to") <= most)
    least = fit.agg(F.min("n_segments")).first()[0]  # one row
    return short.where(F.lit(False) if least is None else F.col("n_segments") >= least)


def score_by_words(
    segments: DataFrame, weights: DataFrame, most: int | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """``segments`` with ``model_score``; null where no word has a weight.

    The ``most`` words of most segments travel with the tasks, which add up their weights.
    If there are more, segments that hold other words, and only these, meet the rest of the
    weights by join. ``keep`` names the columns to keep; what else a text gave is then taken
    from it in the same pass, and no text is shuffled.
    """
    most = COMMON_WORDS if most is None else most
    common, n = common_words(weights, most).select("word", "weight"), weights.count()
    held = common.toArrow().combine_chunks()  # at most ``most``
    names = pa.concat_arrays(held.column("word").chunks or [pa.array([], pa.string())])
    known, few = Weights(names, held.column("weight").to_numpy()), n == held.num_rows
    kept = segments.columns if keep is None else list(keep)
    summed = segments.select("*", totals(text.blanked("text"), known, rest=not few).alias("_sum")).select(*kept, "_sum")
    score = F.when(F.col("_sum.n") > 0, bent(F.col("_sum.total"))).alias("model_score")
    if few:
        return summed.select(*kept, score)
    sums = staged(summed.withColumn("_row", F.monotonically_increasing_id()), "sums")
    rest = sums.where("size(_sum.rest) > 0")
    rare = (
        rest.select("_row", F.explode("_sum.rest").alias("word"))
        .join(weights.join(common, "word", "left_anti"), "word")
        .groupBy("_row")
        .agg(F.sum("weight").alias("_total"), F.count(F.lit(1)).alias("_n"))
    )
    both = [(F.col(f"_sum.{c}") + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("total", "n")]
    joined = rest.join(rare, "_row", "left").withColumn("_sum", F.struct(*both))
    return sums.where("size(_sum.rest) = 0").select(*kept, score).unionByName(joined.select(*kept, score))


def learnt_weights(segments: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Stored weights, learnt from the segments of all reviews but the held-out ones."""
    if counts is None:
        counts = word_counts(segments.withColumn(CODE, F.lit(None).cast("string")))
    return staged(learn_polarity(segments, counts), "word-weights")


def batch_scorer(weights: DataFrame, most: int = WORDS_IN_MEMORY) -> Callable[[Sequence[str]], list]:
    """The same scores as a function of a batch of texts, for ``score_segments``.

    It travels with the task, so the number of words is checked; beyond it, join.
    """
    import re

    rows = weights.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} words: score by join")
    known = {r["word"]: r["weight"] for r in rows}
    least, unit = text.MIN_WORD, float(UNIT)
    find = re.compile(text.LETTERS).findall

    def words(t):
        """Runs of letters; a run that holds a number such as the square sign is cut there."""
        for run in find((t or "").lower()):
            yield from [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()

    def score(texts):
        out = []
        for t in texts:
            found = [known[w] for w in set(words(t)) if len(w) >= least and w in known]
            out.append(sum(found) / (abs(sum(found)) + unit) if found else None)
        return out

    return score


def scorer(weights: DataFrame, most: int | None = None) -> DataFrame | Callable[[Sequence[str]], list]:
    """What ``score_segments`` takes for a stored table of weights: the batch function while
    its words fit a task, else the table itself, which is joined. The scores are the same."""
    most = WORDS_IN_MEMORY if most is None else most
    return batch_scorer(weights, most) if weights.count() <= most else weights


def star_probabilities(score: Column) -> Column:
    """A score as a distribution over one to five stars with that mean, on two neighbours."""
    stars = score * 2.0 + 3.0
    return F.transform(
        F.sequence(F.lit(1), F.lit(5)),
        lambda k: F.greatest(F.lit(0.0), 1.0 - F.abs(stars - k)),
    )


def holdout_report(reviews: DataFrame, segments: DataFrame) -> DataFrame:
    """How the scorer does on the reviews it has not seen: one row.

    ``n_segments``, the share whose sign is that of the declared field (``agreement``, over
    scored ones), and over reviews with a rating ``n`` and the correlations with it of the
    mean model score alone, without the declared polarity.
    """
    unseen = segments.where(held_out() & F.col("model_score").isNotNull())
    right = (F.col("model_score") >= 0) == (F.col("polarity_field") == POSITIVE)
    signs = unseen.agg(
        F.count(F.lit(1)).alias("n_segments"), F.avg(right.cast("double")).alias("agreement")
    )
    means = unseen.groupBy("avis_id").agg(F.avg("model_score").alias("_x"))
    pairs = means.join(reviews.where(F.col("note_moyenne").isNotNull()), "avis_id").select(
        "_x", ((F.col("note_moyenne") - 5.0) / 5.0).alias("_y")
    )
    found = one_row(correlations(staged(pairs, "pairs"), "_x", "_y"))
    return signs.select("*", *(found[c].alias(c) for c in ("n", "pearson", "spearman")))
