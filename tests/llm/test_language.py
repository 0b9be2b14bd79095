from __future__ import annotations

import random

import numpy as np

from parcella.llm import language

ALPHABETS = {"aa": "abcdeé", "bb": "fghijü", "cc": "кимна"}


def prose(lang, seed, n=40):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(ALPHABETS[lang] + "xyz") for _ in range(r.randint(2, 6))) for _ in range(n))


def test_held_out_accuracy_and_calibration(docs_of):
    rows = [(i, prose(k, i), k, "s") for i in range(360) for k in [sorted(ALPHABETS)[i % 3]]]
    docs = docs_of(rows, clash=True)
    model = language.fit(docs.where("doc_id % 4 <> 2"))
    assert model["langs"] == sorted(ALPHABETS) and model["temperature"] > 0
    assert (model["weights"] == 0).mean() > 0.5  # sparse
    got = language.predict(docs, model).where("doc_id % 4 = 2").collect()
    assert np.mean([r.lang_pred == rows[r.doc_id][2] for r in got]) == 1.0
    assert all(0 <= r.score <= 1 for r in got)
    assert {(r.doc_id, r.lang_pred) for r in got} == {
        (r.doc_id, r.lang_pred)
        for r in language.predict(docs.selectExpr("doc_id", "text", "'zz' lang", "'q' source"), model).where("doc_id % 4 = 2").collect()
    }


def test_edges(docs_of):
    rows = [(i, prose(k, i), k) for i in range(60) for k in ["aa" if i % 2 else "bb"]]
    model = language.fit(docs_of([*rows, (90, None, "aa"), (91, "abc", None), (92, "123", "cc")]))
    assert model["langs"] == ["aa", "bb"]
    odd = [(1, None), (2, ""), (3, "12 ... __ ²"), (None, prose("aa", 1)), (5, prose("bb", 2, 60_000)), (5, "a"), (5, "a")]
    got = language.predict(docs_of(odd), model).collect()
    assert len(got) == len(odd)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3))
    assert all(r.lang_pred in ("aa", "bb") for r in got if r.doc_id not in (1, 2, 3))
    nothing = language.fit(docs_of([]))
    assert [r.lang_pred for r in language.predict(docs_of([(1, "abc")]), nothing).collect()] == ["und"]
    assert language.predict(docs_of([]), model).count() == 0
    packed = language.predict(docs_of(odd, clash=True), model, pack=True)
    assert packed.select("row.*").columns == docs_of([], clash=True).columns


def test_document_frequencies_cover_all_rows(docs_of):
    texts = ["ab", "ab cd", "é", "12"]
    found = language.document_frequencies(docs_of(list(enumerate(texts))), "text")
    want = np.zeros_like(found)
    for t in texts:
        used, _ = language.counted(t)
        want[used] += 1
    want[-1] = len(texts)
    assert (found == want).all()


def test_sample_holds_the_smallest_hashes_of_each_language(docs_of):
    from pyspark.sql import functions as F

    rows = [(i, prose(k, i, 8), k) for i in range(300) for k in [sorted(ALPHABETS)[i % 7 % 3]]]
    rows += [(1000 + i, rows[i % 9][1], rows[i % 9][2]) for i in range(200)]  # copies count once
    docs = docs_of(rows)
    hashed = docs.select("lang", "text", F.xxhash64("text").alias("h")).distinct().orderBy("h").collect()
    want = []
    for k in sorted(ALPHABETS):
        want += [(r.h, k, r.text) for r in hashed if r.lang == k][:20]
    got = language.sample_features(docs, "text", "lang", 20)
    assert [x[0] for x in got] == [k for _, k, _ in sorted(want)]
    for (_, used, counts), (_, _, text) in zip(got, sorted(want)):
        u, n = language.counted(text)
        assert (used == u).all() and (counts == n).all()
