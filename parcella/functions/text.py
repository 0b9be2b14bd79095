"""Text and sentiment expressions of the review analysis."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcella.functions import lexicon

# Segmentation, sentiment classes and blending weights.
MIN_SEGMENT_CHARS = 15
HARD_BREAKS = "[→▶•\\n\\r]+"
SENTENCE_ENDS = "(?<=[.!?…])(?U:\\s)+"
POSITIVE_FROM, NEGATIVE_TO = 0.15, -0.15
PRIOR_WEIGHT, MODEL_WEIGHT, PRIOR_ALONE = 0.35, 0.65, 0.6
MIN_WORD = 3
WORD = "\\p{L}+"
#: The same for Python: word characters but digits and underscore (see ``lowered``).
LETTERS = r"[^\W\d_]+"


def lowered(c: Column | str) -> Column:
    """Lower-case text in which ``LETTERS`` finds in Python what ``WORD`` finds in Spark:
    numbers that are no digits, such as the square sign, become blanks."""
    return F.regexp_replace(F.lower(_col(c)), "[\\p{Nl}\\p{No}]", " ")


def blanked(c: Column | str) -> Column:
    """Lower-case words of a text, apart by single blanks; a blank may stand at either end."""
    return F.regexp_replace(F.lower(_col(c)), "\\P{L}+", " ")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_month_year(c: Column | str) -> Column:
    """``DD-MM-YYYY`` as date; anything else is NULL."""
    return F.try_to_date(F.trim(_col(c)), "d-M-yyyy")


def review_id(*parts: Column | str) -> Column:
    """Sixteen hex digits that identify a review without telling its author."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]
    return F.substring(F.sha1(F.concat_ws("|", *texts)), 1, 16)


def segments(c: Column | str) -> Column:
    """Sentence-sized pieces of a text, in order, short ones dropped."""
    pieces = F.flatten(
        F.transform(
            F.split(F.coalesce(_col(c), F.lit("")), HARD_BREAKS),
            lambda chunk: F.split(chunk, SENTENCE_ENDS),
        )
    )
    tidy = F.transform(pieces, lambda s: F.trim(F.regexp_replace(s, "(?U:\\s)+", " ")))
    return F.filter(tidy, lambda s: F.length(s) >= MIN_SEGMENT_CHARS)


def theme_pattern(terms: Sequence[str]) -> str:
    """Whole-word, case-blind pattern of a vocabulary with plural endings.

    Each word of a term may take a plural ending, so that "espace vert" also
    finds "espaces verts". It has no look-around, hence works in any engine.
    """
    words = ("\\s+".join(re.escape(w) + "(?:s|x|e|es)?" for w in t.split()) for t in terms)
    return "(?i)(?:^|[^\\p{L}])(?:" + "|".join(words) + ")(?:[^\\p{L}]|$)"


def themes(c: Column | str, vocabulary: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Themes mentioned in a text, in the vocabulary's own order."""
    vocabulary = vocabulary or lexicon.THEMES
    found = [
        F.when(F.rlike(_col(c), F.lit("(?u)" + theme_pattern(terms))), F.lit(theme))
        for theme, terms in vocabulary.items()
    ]
    return F.array_compact(F.array(*found))


def flagged_words(
    c: Column | str,
    stop_words: Sequence[str] = lexicon.STOP_WORDS,
    generic: Sequence[str] = lexicon.GENERIC_WORDS,
) -> Column:
    """Words of a text in order as ``struct<w,ok>``; ``ok`` marks content words."""
    words = F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD), F.lit(0))
    ignored = list(dict.fromkeys((*stop_words, *generic)))
    return F.transform(
        words,
        lambda w: F.struct(
            w.alias("w"), ((F.length(w) >= MIN_WORD) & ~w.isin(ignored)).alias("ok")
        ),
    )


def tokens(flagged: str) -> Column:
    """Word-cloud tokens from a ``flagged_words`` column, each once per text:
    content words, then adjacent pairs of them, as ``struct<token,kind>``."""
    tail = f"greatest(size({flagged}) - 1, 0)"
    return F.expr(
        "array_distinct(concat("
        f"transform(filter({flagged}, x -> x.ok), "
        "x -> named_struct('token', x.w, 'kind', 'nom')), "
        f"transform(filter(zip_with(slice({flagged}, 1, {tail}), slice({flagged}, 2, {tail}), "
        "(a, b) -> CASE WHEN a.ok AND b.ok THEN concat(a.w, ' ', b.w) END), "
        "p -> p IS NOT NULL), p -> named_struct('token', p, 'kind', 'bigramme'))))"
    )


def stars_to_score(probabilities: Column | str) -> Column:
    """Five class probabilities (1 to 5 stars) as a score in [-1, 1]."""
    p = _col(probabilities)
    stars = F.aggregate(
        F.transform(p, lambda v, i: v * (i + 1)), F.lit(0.0), lambda acc, v: acc + v
    )
    return F.when(F.size(p) == 5, (stars - 3.0) / 2.0).otherwise(
        F.raise_error(F.lit("five star probabilities expected")).cast("double")
    )


def blended(prior: Column, model: Column) -> Column:
    """Declared polarity and model score in one sentiment, bounded to [-1, 1]."""
    mixed = F.greatest(
        F.lit(-1.0), F.least(F.lit(1.0), prior * PRIOR_WEIGHT + model * MODEL_WEIGHT)
    )
    return F.when(model.isNull(), prior * PRIOR_ALONE).otherwise(mixed)


def sentiment_class(c: Column | str) -> Column:
    """Colour class of a mean sentiment."""
    s = _col(c)
    return (
        F.when(s >= POSITIVE_FROM, "positive")
        .when(s <= NEGATIVE_TO, "negative")
        .otherwise("neutral")
    )


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, apostrophes and hyphens included."""
    letters = F.regexp_extract_all(_col(c), F.lit("\\p{L}+|[^\\p{L}]+"), F.lit(0))
    return F.array_join(
        F.transform(
            letters, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
        ),
        "",
    )
