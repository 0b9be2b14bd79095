"""Resident reviews: cleaning, segmentation, sentiment and the roll-up per commune."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.functions import text
from parcella.functions.codes import zero_filled
from parcella.functions.lexicon import GENERIC_WORDS, STOP_WORDS, THEMES
from parcella.functions.numbers import real_comma
from parcella.operators import words
from parcella.operators.sentiment import POSITIVE, WORDS_IN_MEMORY, score_by_words
from parcella.operators.stats import correlations
from parcella.sources.staging import staged

CODE = "code_commune"
NEGATIVE = "negatif"
NLP_VERSION = "1"

# Publication thresholds of the roll-up.
LOW_DATA_UNDER = 10
THEME_MIN_SEGMENTS = 3
NUANCED_UNDER = 0.25
QUOTE_CHARS = (80, 300)
CLOUD_SIZE, PREVIEW_SIZE = 40, 7
#: Tokens that a task counts before it hands on what it has.
TOKENS_IN_MEMORY = 500_000
QUOTES_PER_LABEL = {"Positif": 3, "Négatif": 3, "Nuancé": 2}

Scorer = Callable[[Sequence[str]], Sequence[float | None]]


def clean_reviews(raw: DataFrame, order: str) -> DataFrame:
    """Typed reviews under an anonymous id; the author never leaves this function.

    ``order`` names a column that tells apart two reviews of one author on one
    day (the line number of the file).
    """
    positive = F.coalesce("points_positifs", F.lit(""))
    negative = F.coalesce("points_negatifs", F.lit(""))
    return raw.select(
        text.review_id("slug", "date", "auteur", order).alias("avis_id"),
        zero_filled(CODE).alias(CODE),
        "slug",
        "nom_ville",
        text.day_month_year("date").alias("date_avis"),
        real_comma("note_moyenne").alias("note_moyenne"),
        real_comma("environnement").alias("note_environnement"),
        positive.alias("points_positifs"),
        negative.alias("points_negatifs"),
        (F.length(positive) + F.length(negative)).cast("int").alias("n_chars"),
    )


def segment_reviews(reviews: DataFrame) -> DataFrame:
    """One row per segment: positives first, numbered through the whole review."""

    def side(column: str, polarity: str) -> Column:
        return F.transform(
            text.segments(column),
            lambda s: F.struct(F.lit(polarity).alias("polarity_field"), s.alias("text")),
        )

    both = F.concat(side("points_positifs", POSITIVE), side("points_negatifs", NEGATIVE))
    return reviews.select(
        "avis_id", CODE, "date_avis", F.posexplode(both).alias("segment_id", "_segment")
    ).select(
        "avis_id", CODE, "date_avis", "segment_id", "_segment.polarity_field", "_segment.text"
    )


def tag_themes(
    segments: DataFrame, vocabulary: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Add ``themes``, the themes each segment mentions, in canonical order."""
    return segments.withColumn("themes", words.themes("text", vocabulary))


def score_segments(
    segments: DataFrame, scorer: Scorer | Column | DataFrame | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """Add ``model_score``, ``sentiment`` and ``concordant``.

    ``scorer`` is a table of word weights (``sentiment.learnt_weights``), an expression of
    ``text``, or a function that maps a batch of texts
    to scores in [-1, 1] (None when it cannot tell) and runs on Arrow batches; its
    module must be installed on the executors, or shipped with ``addPyFile``. Without
    a scorer the declared polarity decides. ``keep`` names the columns to keep, all by default.
    """
    if scorer is None:
        model = F.lit(None).cast("double")
    elif isinstance(scorer, DataFrame):
        segments, model = score_by_words(segments, scorer, keep=keep), F.col("model_score")
    elif isinstance(scorer, Column):
        model = scorer
    else:

        @F.pandas_udf("double")
        def batch(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                yield pd.Series(list(scorer(part.tolist())), dtype="float64")

        model = F.nanvl(batch("text"), F.lit(None).cast("double"))
    prior = F.when(F.col("polarity_field") == POSITIVE, 1.0).otherwise(-1.0)
    scored = segments.withColumn("model_score", model)
    if keep is not None:
        scored = scored.select(*keep, "model_score")
    score = F.col("model_score")
    return scored.withColumn("sentiment", text.blended(prior, score)).withColumn(
        "concordant", F.when(score.isNotNull(), (score >= 0) == (prior >= 0))
    )


def extract_tokens(segments: DataFrame) -> DataFrame:
    """One row per word-cloud token of a segment, with its themes and sentiment.

    Words are flagged in a projection of their own, so that they are looked up
    once although tokens read them three times.
    """
    kept = [CODE, "avis_id", "segment_id", "themes", "sentiment"]
    flagged = segments.select(*kept, text.flagged_words("text").alias("_words"))
    return flagged.select(*kept, F.explode(text.tokens("_words")).alias("_token")).select(
        CODE, "avis_id", "segment_id", "_token.token", "_token.kind", "themes", "sentiment"
    )


def _token_finder(pairs: bool = True, only: frozenset[str] | None = None) -> Callable[[str], dict]:
    """A function from a lower-case text to its tokens, each once, as in ``text.tokens``:
    token to its (first, last) word. ``only`` names the words that tokens may have."""
    word, shortest = text.LETTERS, text.MIN_WORD
    ignored = frozenset((*STOP_WORDS, *GENERIC_WORDS))

    def tokens(body: str) -> dict:
        import re

        found, last = {}, None
        for w in re.findall(word, body):
            if len(w) < shortest or w in ignored or (only is not None and w not in only):
                last = None
                continue
            found[w] = (w, w)
            if pairs and last is not None:
                found[f"{last} {w}"] = (last, w)
            last = w
        return found

    return tokens


def token_counts(segments: DataFrame, pairs: bool = True) -> DataFrame:
    """``n`` segments and ``n_avis`` reviews of every token (as in ``extract_tokens``) and commune.

    Segments are dealt and sorted by review, so that a task counts a review once; it
    counts in bounded tables, which Spark adds up. ``pairs=False`` leaves out pairs.
    """
    tokens, most = _token_finder(pairs), TOKENS_IN_MEMORY

    def count(batches):
        import pyarrow as pa

        segments_of, reviews_of, size = {}, {}, 0

        def counted():
            nonlocal size
            size = 0
            for code, n in segments_of.items():
                seen, names = reviews_of[code], list(n)
                columns = [
                    pa.array([code] * len(names), pa.string()),
                    pa.array(["bigramme" if " " in t else "nom" for t in names], pa.string()),
                    pa.array(names, pa.string()),
                    pa.array(n.values(), pa.int64()),
                    pa.array([seen[t] for t in names], pa.int64()),
                ]
                for at in range(0, len(names), 50_000):
                    yield pa.RecordBatch.from_arrays(
                        [c.slice(at, 50_000) for c in columns], names=[CODE, "kind", "token", "n", "n_avis"]
                    )
            segments_of.clear(), reviews_of.clear()

        review, here = None, []

        def close(review, here):
            """A whole review goes into the tables."""
            n = segments_of.setdefault(review[0], Counter())
            before = len(n)
            n.update(here)
            reviews_of.setdefault(review[0], Counter()).update(set(here))
            return len(n) - before

        for batch in batches:
            for code, key, body in zip(*(c.to_pylist() for c in batch.columns)):
                if review != (code, key):
                    if review is not None:
                        size += close(review, here)
                    review, here = (code, key), []
                    if size > most:
                        yield from counted()
                if body:
                    here.extend(tokens(body))
        if review is not None:
            close(review, here)
        yield from counted()

    return (
        segments.select(CODE, "avis_id", text.lowered("text").alias("_text"))
        .repartition("avis_id")
        .sortWithinPartitions("avis_id", CODE)
        .mapInArrow(count, f"{CODE} string, kind string, token string, n long, n_avis long")
        .groupBy(CODE, "kind", "token")
        .agg(F.sum("n").alias("n"), F.sum("n_avis").alias("n_avis"))
    )


def leading_words(counts: DataFrame, size: int = CLOUD_SIZE) -> DataFrame:
    """Stored ``_code, _word``: words that a cloud of ``size`` tokens can come from, by the
    ``words.word_counts`` of its segments.

    A word is in ``n`` reviews at most, and in ``n`` less what its commune's reviews came in
    more than one stretch at least. So the ``size``-th word by ``n`` bounds the cloud from below.
    """
    ignored = list(dict.fromkeys((*STOP_WORDS, *GENERIC_WORDS)))
    single = counts.where(F.col("word").isNotNull() & ~F.col("word").isin(ignored))
    rank = F.row_number().over(Window.partitionBy(CODE).orderBy(F.desc("n")))
    last = single.withColumn("_rank", rank).where(F.col("_rank") == size).select(CODE, "n")
    spare = counts.where("word IS NULL").groupBy(CODE).agg(
        F.sum(F.col("n") - F.col("avis_id").isNotNull().cast("long")).alias("_spare")
    ).withColumnRenamed(CODE, "_code")
    bounds = last.join(spare, F.col(CODE).eqNullSafe(F.col("_code"))).select("_code", (F.col("n") - F.col("_spare")).alias("_least"))
    return staged(
        single.join(staged(bounds, "bounds"), F.col(CODE).eqNullSafe(F.col("_code")), "left")
        .where(F.col("n") >= F.coalesce("_least", F.lit(0)))
        .select(F.col(CODE).alias("_code"), F.col("word").alias("_word")),
        "leading",
    )


def found_tokens(leading: DataFrame) -> Column:
    """Tokens of ``text`` that may hold leading words, as ``words.leading_pairs``."""
    # tasks skip other words early while the leading ones of all communes are few
    few = [r[0] for r in leading.select("_word").distinct().limit(WORDS_IN_MEMORY + 1).collect()]
    return words.leading_pairs(text.blanked("text"), frozenset(few) if len(few) <= WORDS_IN_MEMORY else None)


def token_rows(segments: DataFrame, leading: DataFrame) -> DataFrame:
    """Rows as of ``extract_tokens`` from a column ``_tokens`` of ``found_tokens``."""
    kept = [CODE, "avis_id", "segment_id", "themes", "sentiment"]
    rows = segments.select(*kept, F.explode("_tokens").alias("_token"))
    first, last = F.col("_token.first"), F.col("_token.last")
    for end in (first, F.coalesce(last, first)):
        rows = rows.join(leading, F.col(CODE).eqNullSafe(F.col("_code")) & (end == F.col("_word")), "left_semi")
    kind = F.when(last.isNull(), "nom").otherwise("bigramme")
    return rows.select(
        CODE, "avis_id", "segment_id", F.concat_ws(" ", first, last).alias("token"), kind.alias("kind"), "themes", "sentiment"
    )


def leading_tokens(segments: DataFrame, size: int = CLOUD_SIZE) -> DataFrame:
    """All rows of ``extract_tokens`` that a cloud of ``size`` tokens can come from.

    Single words are counted first. The ``size``-th of a commune bounds its cloud from
    below, and a pair is in no more reviews than either of its words, so only words that
    reach the bound, ties included, and pairs of two such words can be in the cloud.
    """
    leading = leading_words(staged(words.word_counts(segments), "words"), size)
    return token_rows(segments.withColumn("_tokens", found_tokens(leading)), leading)


def review_sentiment(
    reviews: DataFrame, segments: DataFrame, model_name: str = "none"
) -> DataFrame:
    """Reviews with their mean segment sentiment, segment count and model label."""
    means = segments.groupBy("avis_id").agg(
        F.avg("sentiment").alias("sentiment_avis"),
        F.count(F.lit(1)).cast("int").alias("n_segments"),
    )
    return reviews.join(means, "avis_id", "left").select(
        "avis_id",
        CODE,
        "slug",
        "nom_ville",
        "date_avis",
        "note_moyenne",
        "note_environnement",
        "sentiment_avis",
        F.coalesce("n_segments", F.lit(0)).alias("n_segments"),
        "n_chars",
        F.lit(model_name).alias("model_name"),
        F.lit(NLP_VERSION).alias("nlp_version"),
    )


def calibrate(scored_reviews: DataFrame) -> DataFrame:
    """Correlation of text sentiment with the rating, over reviews that have both."""
    pairs = scored_reviews.where(F.col("n_segments") > 0).select(
        "sentiment_avis", ((F.col("note_moyenne") - 5.0) / 5.0).alias("_rating")
    )
    return correlations(pairs, "sentiment_avis", "_rating")


# --- roll-up per commune -----------------------------------------------------


def review_meta(reviews: DataFrame, segments: DataFrame) -> DataFrame:
    """Counts, period and overall sentiment: one review, one vote."""
    votes = segments.groupBy(CODE, "avis_id").agg(F.avg("sentiment").alias("_vote"))
    return (
        reviews.join(votes, [CODE, "avis_id"], "left")
        .groupBy(CODE)
        .agg(
            F.min("nom_ville").alias("nom_ville"),
            F.count_distinct("avis_id").alias("n_avis"),
            F.min("date_avis").alias("date_min"),
            F.max("date_avis").alias("date_max"),
            F.round(F.avg("_vote"), 4).alias("sentiment_global"),
        )
        .withColumn("low_data", F.col("n_avis") < LOW_DATA_UNDER)
    )


def _ordered(name: str, order: Sequence[Column], fields: Sequence[str]) -> Column:
    """List of structs sorted by ``order``. Groups are bounded by construction:
    themes per commune or the first ranks of a cloud."""
    item = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *fields)
    return F.transform(
        F.sort_array(F.collect_list(item)), lambda s: F.struct(*[s[f].alias(f) for f in fields])
    ).alias(name)


def theme_scores(segments: DataFrame) -> DataFrame:
    """Sentiment per commune and theme, themes with too few segments left out."""
    mentions = segments.select(CODE, F.explode("themes").alias("theme"), "sentiment")
    share = lambda condition: F.round(F.avg(condition.cast("double")), 3)
    return (
        mentions.groupBy(CODE, "theme")
        .agg(
            F.count(F.lit(1)).alias("n_segments"),
            share(F.col("sentiment") >= text.POSITIVE_FROM).alias("pct_positive"),
            share(F.col("sentiment") <= text.NEGATIVE_TO).alias("pct_negative"),
            F.round(F.avg("sentiment"), 3).alias("score"),
        )
        .where(F.col("n_segments") >= THEME_MIN_SEGMENTS)
    )


def review_themes(segments: DataFrame) -> DataFrame:
    """``theme_scores`` as one ordered list per commune, most mentioned first."""
    fields = ["theme", "n_segments", "pct_positive", "pct_negative", "score"]
    return (
        theme_scores(segments)
        .groupBy(CODE)
        .agg(_ordered("themes", [-F.col("n_segments"), F.col("theme")], fields))
    )


def cloud_words(
    tokens: DataFrame, size: int = CLOUD_SIZE, theme_names: Sequence[str] = tuple(THEMES)
) -> DataFrame:
    """The first ``size`` words per commune by number of distinct reviews.

    Tokens are first reduced to one row per (commune, word, review). Themes
    travel as bits over ``theme_names``, so every state is a few numbers and the
    hash aggregation never falls back to sorting. The rank filter lets Spark
    drop words before they meet in one task. The mean is rounded before it is
    classed, so the order of summation cannot tip a word over a threshold.
    """
    bits = F.lit(0).cast("long")
    for i, theme in enumerate(theme_names):
        bits = bits + F.when(F.array_contains("themes", theme), 1 << i).otherwise(0)
    per_review = tokens.groupBy(CODE, F.col("token").alias("_key"), "avis_id").agg(
        F.sum("sentiment").alias("_sum"), F.count("sentiment").alias("_n"),
        F.bit_or(bits).alias("_bits"),
    )
    per_word = per_review.groupBy(CODE, "_key").agg(
        F.count("avis_id").alias("weight"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("_sentiment"),
        F.bit_or("_bits").alias("_bits"),
    )
    rank = F.row_number().over(
        Window.partitionBy(CODE).orderBy(F.col("weight").desc(), F.col("word"))
    )
    names = F.array(
        *[
            F.when(F.col("_bits").bitwiseAND(1 << i) > 0, F.lit(theme))
            for i, theme in enumerate(theme_names)
        ]
    )
    return (
        per_word.withColumnRenamed("_key", "word")
        .withColumn("rang", rank)
        .where(F.col("rang") <= size)
        .select(
            CODE,
            "rang",
            "word",
            "weight",
            text.sentiment_class(F.round("_sentiment", 9)).alias("sentiment"),
            F.array_sort(F.array_compact(names)).alias("themes"),
        )
    )


def wordcloud(tokens: DataFrame) -> DataFrame:
    """Word cloud and its preview per commune, from one ranking."""
    fields = ["word", "weight", "sentiment", "themes"]
    full = cloud_words(tokens).groupBy(CODE).agg(_ordered("wordcloud", [F.col("rang")], fields))
    return full.withColumn(
        "wordcloud_preview",
        F.transform(
            F.slice("wordcloud", 1, PREVIEW_SIZE),
            lambda w: F.struct(
                w.word.alias("word"), w.weight.alias("weight"), w.sentiment.alias("sentiment")
            ),
        ),
    )


def picked_quotes(segments: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Displayable quotations: the strongest of each review, then a few per label.

    With ``texts`` (segments with ``text``), ``segments`` have ``quotable`` in place of the
    text, and only picked ones are looked up.
    """
    strength = F.abs(F.col("sentiment"))
    label = (
        F.when(~F.col("concordant") | (strength < NUANCED_UNDER), "Nuancé")
        .when(F.col("sentiment") >= NUANCED_UNDER, "Positif")
        .otherwise("Négatif")
    )
    body = [] if texts is not None else ["text"]
    candidates = segments.where("quotable" if texts is not None else quotable()).select(
        CODE,
        "avis_id",
        "date_avis",
        "segment_id",
        *body,
        "sentiment",
        label.alias("label"),
        F.coalesce(F.try_element_at("themes", F.lit(1)), F.lit("autre")).alias("theme"),
    )
    best = Window.partitionBy(CODE, "avis_id").orderBy(strength.desc(), F.col("segment_id"))
    among = Window.partitionBy(CODE, "label").orderBy(
        strength.desc(), F.col("date_avis").desc_nulls_last(), F.col("avis_id")
    )
    limit = F.create_map(*[F.lit(v) for pair in QUOTES_PER_LABEL.items() for v in pair])
    picked = (
        candidates.withColumn("_first", F.row_number().over(best))
        .where(F.col("_first") == 1)
        .withColumn("rang", F.row_number().over(among))
        .where(F.col("rang") <= max(QUOTES_PER_LABEL.values()))
        .where(F.col("rang") <= limit[F.col("label")])
        .select(
            CODE,
            "label",
            "rang",
            *(body or ["avis_id", "segment_id"]),
            "theme",
            F.date_format("date_avis", "yyyy-MM").alias("mois"),
        )
    )
    if texts is None:
        return picked
    keys = ["avis_id", "segment_id"]
    found = texts.select(CODE, *keys, "text").join(staged(picked, "quotes").withColumnRenamed(CODE, "_code"), keys)
    return found.where(F.col(CODE).eqNullSafe(F.col("_code"))).select(CODE, "label", "rang", "text", "theme", "mois")


def quotable() -> Column:
    """Whether a segment's text is of a length to quote."""
    return F.length("text").between(*QUOTE_CHARS)


def verbatims(segments: DataFrame, source: str, texts: DataFrame | None = None) -> DataFrame:
    """Quotations as one ordered list per commune; ``source`` names their origin."""
    quotes = picked_quotes(segments, texts).withColumn("source", F.lit(source))
    fields = ["text", "label", "theme", "mois", "source"]
    order = [F.col("label"), F.col("rang")]
    return quotes.groupBy(CODE).agg(_ordered("verbatims", order, fields))


def review_rollup(
    reviews: DataFrame, segments: DataFrame, tokens: DataFrame, source: str, texts: DataFrame | None = None
) -> DataFrame:
    """One row per commune with everything the review page shows; ``texts`` as in ``picked_quotes``."""
    joined = review_meta(reviews, segments)
    for part in (review_themes(segments), wordcloud(tokens), verbatims(segments, source, texts)):
        joined = joined.join(part, CODE, "left")
    lists = ("themes", "wordcloud", "wordcloud_preview", "verbatims")
    types = dict(joined.select(*lists).dtypes)
    return joined.select(
        CODE,
        "nom_ville",
        "n_avis",
        "date_min",
        "date_max",
        "sentiment_global",
        "low_data",
        *[F.coalesce(c, F.array().cast(types[c])).alias(c) for c in lists],
    )
