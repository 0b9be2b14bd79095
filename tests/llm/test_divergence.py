from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from parcella.llm import divergence


def brute(rows, least=30, top=50):
    """(lang, source, part, item, value, rank) by whole numbers of any size."""
    df, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        df[lang].update(set(found))
        n[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, c in df[lang].items() if c >= least]

        def p(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        of = {s: p(n[lang, s]) for s in sources}
        whole = p(sum((n[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, of[s][t] - whole[t]) for t in kept if n[lang, s][t] and of[s][t] > whole[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k + 1) for k, (t, v) in enumerate(found[:most])]
    return sorted(out)


def rows_of(seed, docs=400):
    r = random.Random(seed)
    vocabulary = ["Éa", "der", "DIE", "das", "x'y", "naïve", "日本", "Zz9z", "und", "in", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for i in range(docs):
        words = [r.choice(vocabulary[: 10 + i % 26]) for _ in range(r.randint(0, 40))]
        rows.append((" ".join(words), r.choice(["en", "de", None, ""]), f"s{int(r.random() ** 3 * 6)}"))
    rows += [(None, "en", "empty"), ("12 ...", "xx", "a"), ("", "xx", "b"), (None, None, None)]
    return rows + rows[:30]


def frame(spark, rows):
    return spark.createDataFrame(
        [(*x, 1, 2, "t", None) for x in rows],
        "text string, lang string, source string, docs long, counts int, term string, item string",
    ).repartition(5)


def test_audit_matches_brute_force(spark, monkeypatch):
    rows = rows_of(1)
    want = brute(rows)
    assert any(x[2] == "term" for x in want)
    for cells in (1 << 20, 10):
        monkeypatch.setattr(divergence, "PAIR_CELLS", cells)
        assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == want


def test_spilled_stripes_merge_to_the_same(spark):
    docs = frame(spark, rows_of(2)).na.fill("")
    whole, small = (
        divergence.merge(divergence.fold(docs, k), rows=n).collect() for k, n in ((10**6, 10**5), (3, 7))
    )

    def plain(stripes):
        return sorted((s.lang, s.term, s.docs, sorted(zip(s.sources, s.counts))) for s in stripes)

    assert plain(whole) == plain(small)


def test_shares_stay_exact_for_large_counts():
    import numpy as np

    counts, totals = np.array([[10**14, 7]]), np.array([3 * 10**14, 10**15])
    got = divergence._shares(counts, totals, 11)[0].tolist()
    assert got == [1 + 10**9 * (c + 5) // (t + 55) for c, t in zip(counts[0].tolist(), totals.tolist())]


def test_empty_table_and_long_text(spark):
    assert divergence.audit(frame(spark, rows_of(3)).limit(0)).count() == 0
    long = [("wort " * 100_000, "de", "a")] + [("Wort WORT", "de", "b")] * 29
    assert sorted(map(tuple, divergence.audit(frame(spark, long)).collect())) == brute(long)
