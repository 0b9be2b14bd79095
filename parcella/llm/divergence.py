"""Source divergence audit by in-mapper stripes.

Each task folds whole documents into stripes: for a language's term the number of its
documents and the occurrences by source. A task that holds ``FOLD_ENTRIES`` entries hands
them on and starts anew, so its memory is bounded; the shuffle sorts partial stripes by key
and a streaming pass merges neighbours. A term of any frequency sends one partial stripe a
task and fold, however many rows bear it. Merged stripes of frequent terms are stored; the
totals of the (language, source) groups come from them, and a second pass over them emits
the divergences: sums over terms for each pair of sources, kept in bounded partial sums, and
the terms that a source uses more than its language.

With count c, group total N and V kept terms, p = 1 + floor(SCALE (c + ADDED) / (N + ADDED V)),
by long division in whole numbers. The value of a pair is the sum of abs(p - q) over all kept
terms; that of a term is p - q against its language.

The groups' totals go to every task. Their number is checked against ``GROUPS``: a language
of S sources has S (S - 1) result rows, so a table beyond it has no feasible result.

Defined cases: null text, language or source count as ''; a document without terms still
makes its group occur; a language without kept terms has pairs of value 0 and no terms;
repeated rows count as often as they stand; ties rank by item in UTF-8 order; texts are
folded whole, however long, and hold at most their own terms in memory; an empty table
gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.sources.staging import staged

#: A run of ASCII letters and anything beyond ASCII, in UTF-8, after A-Z became a-z.
TERM = rb"[a-z\x80-\xff]+"
LEAST_DOCS, ADDED, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Entries that a task folds before it hands its stripes on, and cells of partial pair sums.
FOLD_ENTRIES, PAIR_CELLS = 1_000_000, 1 << 21
#: Partial stripes that are merged at a time.
MERGE_ROWS = 50_000
#: Most (language, source) groups whose totals are sent to every task.
GROUPS = 200_000
STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"
#: The stripe under this key (no term is empty) counts the documents of each source.
DOCUMENTS = b""


def _stripes(lang: str, counters: dict, docs: Counter):
    """Batch of the stripes of one language: its terms, each with documents, sources and counts."""
    import numpy as np
    import pyarrow as pa

    names = list(counters)
    terms = pa.array([t for c in counters.values() for t in c], pa.binary()).dictionary_encode()
    code = terms.indices.to_numpy()
    source = np.repeat(np.arange(len(names)), [len(c) for c in counters.values()])
    counts = np.fromiter((n for c in counters.values() for n in c.values()), np.int64, len(code))
    order = np.argsort(code, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(terms.dictionary)))])
    return _batch(
        [lang] * len(terms.dictionary),
        terms.dictionary,
        [docs[t] for t in terms.dictionary.to_pylist()],
        ends,
        pa.array(names, pa.string()).take(pa.array(source[order])),
        counts[order],
    )


def _batch(lang, term, docs, ends, sources, counts):
    """Batch of stripes; ``sources`` and ``counts`` of all of them lie one after the other."""
    import pyarrow as pa

    ends = pa.array(ends, pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(lang, pa.string()),
            term.cast(pa.string()),
            pa.array(docs, pa.int64()),
            pa.ListArray.from_arrays(ends, sources),
            pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
        ],
        names=["lang", "term", "docs", "sources", "counts"],
    )


def fold(docs: DataFrame, limit: int = FOLD_ENTRIES) -> DataFrame:
    """Partial stripes of ``docs`` (lang, source, text, none null).

    While documents are folded, the entries of a language's stripes lie in one hash table a
    source and one of documents, which are counted without a step of Python for each word.
    """

    def run(batches):
        import pyarrow as pa

        find = re.compile(TERM).findall
        counters: dict = {}
        frequency: dict = {}
        entries = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary())):
                words = find(text.as_py().lower())
                words.append(DOCUMENTS)
                counter = counters.setdefault(lang, {}).setdefault(source, Counter())
                known = frequency.setdefault(lang, Counter())
                entries -= len(counter) + len(known)
                counter.update(words)
                known.update(set(words))
                entries += len(counter) + len(known)
                if entries >= limit:
                    for k in counters:
                        yield _stripes(k, counters[k], frequency[k])
                    counters, frequency, entries = {}, {}, 0
        for k in counters:
            yield _stripes(k, counters[k], frequency[k])

    return docs.select("lang", "source", "text").mapInArrow(run, STRIPE)


def _merged(rows, least_docs: int, last: bool):
    """(stripes of all keys of the sorted ``rows`` that are frequent, stripe of the last key or None).

    The last key may go on in later rows, so its stripe is only given out at the end.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lang, term = rows.column("lang").combine_chunks(), rows.column("term").combine_chunks()
    docs = rows.column("docs").to_numpy()
    n = len(docs)
    new = np.ones(n, bool)
    if n > 1:
        changed = pc.or_(pc.not_equal(term[1:], term[:-1]), pc.not_equal(lang[1:], lang[:-1]))
        new[1:] = changed.to_numpy(zero_copy_only=False)
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    total = np.add.reduceat(docs, starts)
    keep = (total >= least_docs) | (pc.binary_length(term).to_numpy()[starts] == 0)
    if not last:
        keep[-1] = True
    kept = np.flatnonzero(keep)
    if not len(kept):
        return None, None
    rows, group = rows.filter(pa.array(keep[group])), group[keep[group]]
    place = np.zeros(len(keep), np.int64)
    place[kept] = np.arange(len(kept))
    sizes = pc.list_value_length(rows.column("sources")).to_numpy()
    names = pc.list_flatten(rows.column("sources")).combine_chunks().dictionary_encode()
    counts = pc.list_flatten(rows.column("counts")).to_numpy()
    width = max(1, len(names.dictionary))
    key = np.repeat(place[group], sizes) * width + names.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    owner, source = key[first] // width, key[first] % width
    stripes = _batch(
        lang.take(pa.array(starts[kept])),
        term.take(pa.array(starts[kept])),
        total[kept],
        np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(kept)))]),
        names.dictionary.take(pa.array(source)),
        np.add.reduceat(counts[order], first),
    )
    if last:
        return stripes, None
    return stripes.slice(0, len(kept) - 1), stripes.slice(len(kept) - 1)


def merge(partial: DataFrame, least_docs: int = LEAST_DOCS, rows: int = MERGE_ROWS) -> DataFrame:
    """Whole stripes of terms in at least ``least_docs`` documents, and of the documents.

    Sorted partial stripes stream by in chunks of about ``rows``; the stripe of a chunk's last
    key, merged, heads the next chunk.
    """

    def run(batches):
        import pyarrow as pa

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                done, open_stripe = _merged(pa.Table.from_batches(held), least_docs, False)
                held, n = [open_stripe], 1
                if done.num_rows:
                    yield done
        if n:
            done, _ = _merged(pa.Table.from_batches(held), least_docs, True)
            if done is not None:
                yield done

    return partial.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, STRIPE)


def group_totals(stripes: DataFrame) -> DataFrame:
    """``lang, source, total, terms``: kept occurrences of every occurring group, kept terms of its language."""
    each = stripes.select(
        "lang", (F.col("term") == "").alias("is_docs"), F.explode(F.arrays_zip("sources", "counts")).alias("x")
    )
    totals = each.groupBy("lang", F.col("x.sources").alias("source")).agg(
        F.coalesce(F.sum(F.when(~F.col("is_docs"), F.col("x.counts"))), F.lit(0)).alias("total")
    )
    kept = stripes.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("terms"))
    return totals.join(kept, "lang")


def _shares(counts, totals, terms: int):
    """p of every count (terms by groups), three decimal digits of the quotient at a time."""
    import numpy as np

    whole = totals + ADDED * terms
    rest = counts + ADDED
    p = np.zeros_like(rest)
    base = 1_000
    for _ in range(3):
        digit, rest = np.divmod(rest * base, whole)
        p = p * base + digit
    return p + 1


def _divergences(stripes: DataFrame, shared, part: str) -> DataFrame:
    """Partial values ``lang, source, item, value`` of one part, from merged stripes."""

    def blocks(batches):
        """(lang, terms, counts by group, p by group) of at most 512 stripes of a language."""
        import numpy as np

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                by_lang: dict = {}
                rows = batch.slice(start, 512)
                for lang, term, _, sources, counts in zip(*(c.to_pylist() for c in rows.columns)):
                    by_lang.setdefault(lang, []).append((term, sources, counts))
                for lang, stripes in by_lang.items():
                    names, totals, terms, places = shared.value[lang]
                    n = np.zeros((len(stripes), len(names)), np.int64)
                    for row, (_, sources, counts) in enumerate(stripes):
                        n[row, [places[s] for s in sources]] = counts
                    yield lang, names, [s[0] for s in stripes], n, _shares(n, totals, terms), totals, terms

    def batch_of(langs, sources, items, values):
        import pyarrow as pa

        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip((langs, sources, items, values), kinds)],
            names=["lang", "source", "item", "value"],
        )

    def pairs(batches):
        import numpy as np

        sums: dict = {}

        def emit():
            for (lang, a), row in sums.items():
                names = shared.value[lang][0]
                others = [j for j in range(len(names)) if j != a]
                if others:
                    yield batch_of(
                        [lang] * len(others), [names[a]] * len(others), [names[j] for j in others], row[others]
                    )
            sums.clear()

        cells = 0
        for lang, names, _, _, p, _, _ in blocks(batches):
            for a in range(len(names)):
                row = np.abs(p - p[:, a : a + 1]).sum(axis=0)
                if (lang, a) in sums:
                    sums[lang, a] += row
                else:
                    sums[lang, a] = row
                    cells += len(names)
                if cells >= PAIR_CELLS:
                    yield from emit()
                    cells = 0
        yield from emit()

    def terms(batches):
        import numpy as np

        for lang, names, found, n, p, totals, kept in blocks(batches):
            q = _shares(n.sum(axis=1, keepdims=True), totals.sum(keepdims=True), kept)
            at, group = np.nonzero((n > 0) & (p > q))
            yield batch_of(
                [lang] * len(at), [names[g] for g in group], [found[t] for t in at], (p - q)[at, group]
            )

    schema = "lang string, source string, item string, value long"
    return stripes.mapInArrow(pairs if part == "pair" else terms, schema)


def _ranked(values: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value",
        F.row_number().over(order).cast("int").alias("rank"),
    )


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: every pair of a language's sources, the ``top`` terms of each."""
    import numpy as np

    def given(name: str, alias: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(alias)

    partial = fold(docs.select(given(lang, "lang"), given(source, "source"), given(text, "text")))
    stripes = staged(merge(partial, least_docs), "stripes")
    totals = staged(group_totals(stripes), "totals")
    groups = totals.orderBy("lang", "source").limit(GROUPS + 1).collect()
    if len(groups) > GROUPS:
        raise ValueError(f"more than {GROUPS} groups of language and source")
    by_lang: dict = {}
    for g in groups:
        by_lang.setdefault(g["lang"], []).append(g)
    sizes = {
        k: (
            [g["source"] for g in v],
            np.array([g["total"] for g in v], np.int64),
            v[0]["terms"],
            {g["source"]: i for i, g in enumerate(v)},
        )
        for k, v in by_lang.items()
    }
    shared = docs.sparkSession.sparkContext.broadcast(sizes)
    kept = stripes.where("term != ''")
    sums = _divergences(kept, shared, "pair").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    names = totals.select("lang", "source")
    pairs = (
        names.join(names.withColumnRenamed("source", "item"), "lang")
        .where("source != item")
        .join(sums, ["lang", "source", "item"], "left")
        .select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    )
    terms = _ranked(_divergences(kept, shared, "term"), "term").where(F.col("rank") <= top)
    return _ranked(pairs, "pair").unionByName(terms)
