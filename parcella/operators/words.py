"""Words of review segments, read a column at a time.

Spark lower-cases a text and leaves its words apart by blanks (``text.blanked``); tasks split a
batch in Arrow, code its words by a dictionary of the batch, and do what is to be done for a
word once a batch. Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcella.functions import text
from parcella.functions.lexicon import GENERIC_WORDS, STOP_WORDS, THEMES

CODE = "code_commune"
POSITIVE = "positif"
#: First hex digits of the review ids that are held out (three of sixteen).
HELD_OUT = ("0", "1", "2")


def held_out(review_id: str = "avis_id") -> Column:
    """Whether a review takes no part in learning."""
    return F.substring(review_id, 1, 1).isin(*HELD_OUT)


#: Text that is counted at once.
CHARS_AT_ONCE = 16_000_000
_latest: dict = {}


def coded(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a batch of blanked texts, and code and row of every word in order.

    Functions of one projection get the same batch in turn, which is coded once.
    """
    place = (len(column), column.offset, *(b and b.address for b in column.buffers()))
    if _latest.get("place") != place:
        lists = pc.split_pattern(pc.fill_null(column, ""), " ")
        found = lists.flatten().dictionary_encode()
        sizes = np.diff(lists.offsets.to_numpy())
        codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _latest.update(place=place, column=column, found=(found.dictionary, codes, np.repeat(np.arange(len(sizes)), sizes)))
    return _latest["found"]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and how often each is there."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys)))


def looked_up(names: pa.Array, values: pa.Array) -> np.ndarray:
    """Place of each name among ``values``, -1 where it is not."""
    return pc.fill_null(pc.index_in(names, value_set=values), -1).to_numpy(zero_copy_only=False)


def lists_of(rows: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """Values by their (sorted) row as a list for each of ``n`` rows."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def gathered(batches, most: int):
    """Arrow batches of about ``most`` bytes out of smaller ones."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size > most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def word_counts(segments: DataFrame) -> DataFrame:
    """Words of at least ``text.MIN_WORD`` letters by commune, and reviews by commune.

    Rows of words: ``up`` and ``down``, the segments of either field that hold the word,
    held-out reviews left out, and ``n``, the stretches of consecutive segments of one review
    that hold it. Rows of reviews (``word`` null): ``n``, in how many stretches the review
    came. So a word is in ``n`` reviews of a commune at most, and in ``n`` less the sum of its
    reviews' ``n - 1`` at least, however the segments are dealt out.
    """
    shortest, most = text.MIN_WORD, CHARS_AT_ONCE

    def count(batches):
        last, seen = None, set()
        for batch in gathered(batches, most):
            commune, review, side, body = (batch.column(i) for i in range(4))
            names, codes, rows = coded(body)
            long_enough = pc.greater_equal(pc.utf8_length(names), shortest).to_numpy(zero_copy_only=False)
            kept, n = long_enough[codes], max(len(names), 1)
            pairs = distinct(rows[kept] * n + codes[kept])[0]
            rows, codes = pairs // n, pairs % n

            places = commune.dictionary_encode()
            place = places.indices.fill_null(len(places.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = review.dictionary_encode()
            id_ = ids.indices.fill_null(len(ids.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.concatenate(([True], (place[1:] != place[:-1]) | (id_[1:] != id_[:-1])))
            run = np.cumsum(first) - 1
            starts = np.flatnonzero(first)

            in_runs = distinct(run[rows] * n + codes)[0]
            runs, words = in_runs // n, in_runs % n
            end = len(starts) - 1
            latest = set(names.take(pa.array(words[runs == end])).to_pylist())
            goes_on = last == (commune[0].as_py(), review[0].as_py())
            if goes_on:  # what this review had in the batch before counts once
                fresh = (runs > 0) | (looked_up(names, pa.array(list(seen), pa.string()))[words] < 0)
                runs, words = runs[fresh], words[fresh]
                starts = starts[1:]
            seen = latest | seen if goes_on and end == 0 else latest
            last = (commune[-1].as_py(), review[-1].as_py())

            keys = place[rows] * n + codes
            found, sides = distinct(keys)[0], side.fill_null(-1).to_numpy(zero_copy_only=False)[rows]
            up, down, stretches = (np.zeros(len(found), np.int64) for _ in range(3))
            in_run = place[np.flatnonzero(first)][runs] * n + words
            for into, part in ((up, keys[sides == 1]), (down, keys[sides == 0]), (stretches, in_run)):
                part, times = distinct(part)
                into[np.searchsorted(found, part)] = times
            where, none = (pa.concat_arrays([places.dictionary, pa.nulls(1, pa.string())]), pa.nulls)
            yield pa.RecordBatch.from_arrays(
                [
                    where.take(pa.array(found // n)), none(len(found), pa.string()), names.take(pa.array(found % n)),
                    pa.array(up, pa.int64()), pa.array(down, pa.int64()), pa.array(stretches, pa.int64()),
                ],
                names=[CODE, "avis_id", "word", "up", "down", "n"],
            )
            zeros, ones = (pa.array(np.full(len(starts), x, np.int64)) for x in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [commune.take(pa.array(starts)), review.take(pa.array(starts)), none(len(starts), pa.string()), zeros, zeros, ones],
                names=[CODE, "avis_id", "word", "up", "down", "n"],
            )

    side = F.when(~held_out(), F.when(F.col("polarity_field") == POSITIVE, 1).otherwise(0))
    return (
        segments.select(
            CODE, F.col("avis_id").cast("string").alias("avis_id"), side.alias("_side"), text.blanked("text").alias("_words")
        )
        .mapInArrow(count, f"{CODE} string, avis_id string, word string, up long, down long, n long")
        .groupBy(CODE, "avis_id", "word")
        .agg(F.sum("up").alias("up"), F.sum("down").alias("down"), F.sum("n").alias("n"))
    )


def fingerprints(names: pa.Array) -> np.ndarray:
    """A 64-bit number for each word, by its bytes; different words may share one."""
    ends = np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + len(names) + 1].astype(np.int64)
    if not len(names) or ends[-1] == ends[0]:
        return np.zeros(len(names), np.uint64)
    body = np.frombuffer(names.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    ends, sizes = ends - ends[0], np.diff(ends)
    powers = np.cumprod(np.full(sizes.max(), 0x9E3779B97F4A7C15, np.uint64))
    sums = np.cumsum((body + np.uint64(1)) * powers[np.arange(len(body)) - np.repeat(ends[:-1], sizes)])
    sums = np.concatenate((np.zeros(1, np.uint64), sums))
    return sums[ends[1:]] - sums[ends[:-1]]


class Weights:
    """Words and their whole weights, about 30 bytes a word, looked up by fingerprint.

    Words found are compared, and of words that share a fingerprint all but the first are
    looked up by themselves, so no other word gets a weight.
    """

    def __init__(self, names: pa.Array, weights: np.ndarray):
        parts = [fingerprints(names.slice(at, 100_000)) for at in range(0, len(names), 100_000)]
        prints = np.concatenate([np.zeros(0, np.uint64), *parts])
        order = np.argsort(prints, kind="stable")
        self.prints, self.names, self.weights = prints[order], names.take(pa.array(order)), weights[order]
        again = np.flatnonzero(self.prints[1:] == self.prints[:-1]) + 1
        self.twins, self.of_twins = self.names.take(pa.array(again)), self.weights[again]

    def of(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which words have a weight, and the weights (0 where there is none)."""
        if not len(self.names):
            return np.zeros(len(names), bool), np.zeros(len(names), np.int64)
        at = np.minimum(np.searchsorted(self.prints, fingerprints(names)), len(self.prints) - 1)
        has = pc.equal(names, self.names.take(pa.array(at))).to_numpy(zero_copy_only=False)
        weight = np.where(has, self.weights[at], 0)
        if len(self.twins):
            twin = looked_up(names, self.twins)
            has, weight = has | (twin >= 0), np.where(twin >= 0, self.of_twins[twin], weight)
        return has, weight


def totals(body: Column, known: Weights, rest: bool) -> Column:
    """``total`` of the weights of a blanked text's distinct words, ``n`` of them, and with
    ``rest`` the other ones that may have a weight."""
    shortest = text.MIN_WORD

    @F.arrow_udf("struct<total:bigint,n:int,rest:array<string>>")
    def add_up(column: pa.Array) -> pa.Array:
        names, codes, rows = coded(column)
        n, texts = max(len(names), 1), len(column)
        pairs = distinct(rows * n + codes)[0]
        rows, codes = pairs // n, pairs % n
        has, weight = known.of(names)
        here = has[codes]
        total = np.bincount(rows[here], weight[codes[here]], texts)  # whole numbers far below 2 ** 53
        other = ~has & pc.greater_equal(pc.utf8_length(names), shortest).to_numpy(zero_copy_only=False)
        left = other[codes] if rest else np.zeros(len(codes), bool)
        return pa.StructArray.from_arrays(
            [
                pa.array(total.astype(np.int64)),
                pa.array(np.bincount(rows[here], minlength=texts), pa.int32()),
                lists_of(rows[left], texts, names.take(pa.array(codes[left]))),
            ],
            names=["total", "n", "rest"],
        )

    return add_up(body)


def leading_pairs(body: Column, only: frozenset[str] | None = None) -> Column:
    """Tokens of a blanked text, each once, as in ``text.tokens``: ``first, last`` word of a pair
    of neighbours, ``last`` null for a single word. ``only`` names the words they may have."""
    shortest = text.MIN_WORD
    ignored = pa.array([*STOP_WORDS, *GENERIC_WORDS], pa.string())
    wanted = None if only is None else pa.array(sorted(only), pa.string())

    @F.arrow_udf("array<struct<first:string,last:string>>")
    def tokens(column: pa.Array) -> pa.Array:
        names, codes, rows = coded(column)
        n = max(len(names), 1)
        good = pc.greater_equal(pc.utf8_length(names), shortest).to_numpy(zero_copy_only=False)
        good = good & (looked_up(names, ignored) < 0)
        if wanted is not None:
            good = good & (looked_up(names, wanted) >= 0)
        ok = good[codes]
        here = np.flatnonzero(ok)
        two = here[:-1][(np.diff(here) == 1) & (rows[here[1:]] == rows[here[:-1]])]
        at = np.concatenate((here, two))
        second = np.concatenate((np.full(len(here), n), codes[two + 1]))  # n: no second word
        of_first = np.cumsum(good) - 1  # good words numbered anew, so that keys stay small
        m = int(good.sum()) + 1
        second = np.where(second == n, m - 1, of_first[np.minimum(second, n - 1)])
        keys = distinct((rows[at] * m + of_first[codes[at]]) * m + second)[0]
        kept = names.filter(pa.array(good))
        first, last, rows = keys // m % m, keys % m, keys // (m * m)
        values = pa.StructArray.from_arrays(
            [kept.take(pa.array(first)), kept.take(pa.array(last, mask=last == m - 1))], names=["first", "last"]
        )
        return lists_of(rows, len(column), values)

    return tokens(body)


#: Letters that a case-blind pattern takes for another letter than their lower-case form.
FOLDED = {
    c: ord(u.lower())
    for c in range(0x1F000)
    if len(u := chr(c).upper()) == 1 and len(u.lower()) == 1 and len(chr(c).lower()) == 1 and u.lower() != chr(c).lower()
}
ENDINGS = ("", "s", "x", "e", "es")


def themes(c: str, vocabulary: Mapping[str, Sequence[str]] | None = None) -> Column:
    """What ``text.themes`` finds, with words looked up instead of searched for.

    Terms of several words are searched for where their first two words follow each other.
    """
    vocabulary = vocabulary or THEMES
    if not all(w.isalpha() for terms in vocabulary.values() for term in terms for w in term.split()):
        return text.themes(c, vocabulary)
    folded = FOLDED
    single, starts, nexts = {}, {}, {}
    for i, terms in enumerate(vocabulary.values()):
        for term in terms:
            found = [[(w.lower() + e).translate(folded) for e in ENDINGS] for w in term.split()]
            for table, forms in zip((single,) if len(found) == 1 else (starts, nexts), found):
                for form in forms:
                    table[form] = table.get(form, 0) | 1 << i

    forms = sorted({*single, *starts, *nexts})
    bits_of = [np.array([t.get(w, 0) for w in forms], np.int64) for t in (single, starts, nexts)]
    forms, unusual = pa.array(forms, pa.string()), "[" + "".join(map(chr, folded)) + "]"

    @F.arrow_udf("struct<sure:bigint,maybe:bigint>")
    def look_up(column: pa.Array) -> pa.Array:
        names, codes, rows = coded(column)
        if pc.any(pc.match_substring_regex(names, unusual)).as_py():
            names = pa.array([w.translate(folded) for w in names.to_pylist()], pa.string())
        at = looked_up(names, forms)[codes]
        hits = np.flatnonzero(at >= 0)
        sure, maybe = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
        np.bitwise_or.at(sure, rows[hits], bits_of[0][at[hits]])
        next_to = hits[:-1][(np.diff(hits) == 1) & (rows[hits[1:]] == rows[hits[:-1]])]
        np.bitwise_or.at(maybe, rows[next_to], bits_of[1][at[next_to]] & bits_of[2][at[next_to + 1]])
        return pa.StructArray.from_arrays([pa.array(sure), pa.array(maybe)], names=["sure", "maybe"])

    bits = look_up(text.blanked(c))
    found = []
    for i, (theme, terms) in enumerate(vocabulary.items()):
        some = bits["sure"].bitwiseAND(1 << i) > 0
        long_ones = [t for t in terms if len(t.split()) > 1]
        if long_ones:
            pattern = F.lit("(?u)" + text.theme_pattern(long_ones))
            some = some | ((bits["maybe"].bitwiseAND(1 << i) > 0) & F.rlike(F.col(c), pattern))
        found.append(F.when(some, F.lit(theme)))
    # lower-casing this letter leaves a mark behind that is none
    odd = F.instr(c, "İ") > 0
    return F.when(odd, text.themes(c, vocabulary)).otherwise(F.array_compact(F.array(*found)))
