from __future__ import annotations

import random
import re

from parcella.llm import near_dups


def brute(rows):
    """Component of every row's id, by comparing all sets."""
    sets = []
    for i, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if s and t and None not in (i, j) and 100 * both >= 85 * (len(s) + len(t) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets if i is not None}


def edited(text, share, seed):
    r = random.Random(seed)
    w = text.split()
    for k in r.sample(range(len(w)), max(1, int(share * len(w)))):
        w[k] = f"x{seed}w{k}"
    return " ".join(w)


def test_components_match_brute_force(docs_of, words):
    rows = [(i, words(i, 30 + i % 90)) for i in range(60)]
    rows += [(100 + i, edited(words(3, 400), 0.006 + 0.002 * (i % 5), i)) for i in range(80)]  # chains
    rows += [(300 + i, words(7, 200).upper() if i % 2 else words(7, 200)) for i in range(10)]
    passage = words(999, 60)
    rows += [(400 + i, words(1000 + i, 60) + " " + passage) for i in range(40)]
    got = near_dups.near_duplicates(docs_of(rows, clash=True)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_edges(docs_of, words):
    long = words(1, 120_000)
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\x0btwo"), (6, "two one"),
        (7, long), (8, long + " end"), (9, words(2, 50)), (9, words(2, 50)), (10, "É É É É É"), (11, "é é é é é"),
    ]
    got = near_dups.near_duplicates(docs_of([*rows, (None, "one two"), (None, None)])).collect()
    assert len(got) == len(rows) + 2
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None}
    assert by == brute(rows)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near_dups.near_duplicates(docs_of([])).count() == 0
    assert near_dups.kept_documents(docs_of([])).count() == 0


def test_one_row_of_each_group_stays_whatever_its_id(docs_of, words):
    a, b = words(1, 80), words(2, 80)
    rows = [(4, "one two"), (5, "one two"), (None, "one two"), (None, "x y"), (None, "x y")]
    rows += [(7, a), (7, a), (7, b), (8, edited(b, 0.01, 1)), (9, None), (9, ""), (9, None)]
    docs = docs_of(rows, clash=True)
    kept = near_dups.kept_documents(docs)
    assert kept.columns == docs.columns
    got = sorted((r.text or "")[:9] for r in kept.collect())
    assert got == sorted(["one two", "x y", a[:9], b[:9], "", "", ""])


def test_documents_with_a_common_passage_are_not_paired_in_their_tables(docs_of, words, monkeypatch):
    """Similarity about 0.6: tables are shared by many, but none can be linked through them."""
    met = []
    original = near_dups.alike

    def alike(rows, by_leader):
        sizes = rows.groupBy("key").count().selectExpr("coalesce(sum(count * (count - 1)), 0) AS n").first()
        met.append(sizes.n)
        return original(rows, by_leader)

    monkeypatch.setattr(near_dups, "alike", alike)
    passage = words(999, 160)
    for n in (150, 300):
        rows = [(i, passage + " " + words(1000 + i, 45)) for i in range(n)]
        rows += [(5000, passage + " " + words(1000, 44) + " odd"), (5001, edited(rows[1][1], 0.01, 1))]
        got = near_dups.near_duplicates(docs_of(rows)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert max(met) <= 600  # a few for each document, where 300 in one table make 90,000


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(200, 201)], "a long, b long")
    got = {r.node: r.component for r in near_dups.components(links).collect()}
    assert got == {**{i: 0 for i in range(71)}, 200: 200, 201: 200}


def test_signatures_do_not_depend_on_the_batch():
    texts = ["a b c d e f", None, "", "x", "a  b\tc d e f g"]
    whole, bounds = near_dups.shingle_sets(texts)
    for k, t in enumerate(texts):
        assert list(whole[bounds[k] : bounds[k + 1]]) == list(near_dups.shingle_sets([t])[0])
