"""Words of segments: themes, tokens and counts against the plain expressions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from parcella.functions import text
from parcella.operators import reviews, sentiment, words
from parcella.plans import registry

TERMS = ("Bruit", "bruits", "ESPACES VERTS", "espace  verte", "espace, vert", "vélos", "cafée", "ſale", "İnsécurité", "Ⅷ")


def test_themes_are_those_of_the_pattern(spark):
    r = random.Random(7)
    parts = [*TERMS, "pour le", "pour\tle", "und der", "se garer", "barbares", "x²bus", "l'école", "nuisance sonores", "Kelvin"]
    rows = [(" ".join(r.choices(parts, k=1 + k % 6)),) for k in range(400)] + [(t,) for t in (None, "", "-", *parts)]
    for vocabulary in (None, registry.VOCABULARY, {"a": ("l'école", "bruit"), "b": ("vélo",)}):
        df = spark.createDataFrame(rows, "t string")
        found = df.select("t", text.themes("t", vocabulary).alias("a"), words.themes("t", vocabulary).alias("b")).collect()
        assert [x for x in found if x.a != x.b] == []
        assert len({tuple(x.a) for x in found}) > 2


def test_pairs_are_the_tokens(spark):
    bodies = ["Prix élevés, prix élevés dans la ville", "a bb ccc ddd", "", None, "x² les² parcs²verts eux parcs", "vert " * 40]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, t string")
    plain = df.select("i", text.flagged_words("t").alias("w")).select("i", F.explode(text.tokens("w").alias("x"))).select("i", "col.token")
    pairs = df.select("i", F.explode(words.leading_pairs(text.blanked("t"))).alias("p")).select("i", F.concat_ws(" ", "p.first", "p.last"))
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, plain.collect()))


def test_counts_bound_the_reviews_of_a_word(spark, monkeypatch):
    """However segments are dealt and batched, n bounds the reviews from above and below."""
    monkeypatch.setattr(words, "CHARS_AT_ONCE", 300)
    r = random.Random(1)
    rows = []
    for i in range(90):
        for k in range(1 + i % 5):
            body = " ".join(r.choices(["parc", "bruit", "calme", "gare", "les"], k=3))
            rows.append((f"{i % 85:x}", "01001" if i % 2 else None, k, r.choice(["positif", "negatif"]), body))
    df = spark.createDataFrame(rows, "avis_id string, code_commune string, segment_id int, polarity_field string, text string")
    for dealt in (df.coalesce(1), df.repartition(5)):
        found = words.word_counts(dealt).collect()
        for place in ("01001", None):
            of = {x.avis_id: x.n for x in found if x.word is None and x.code_commune == place}
            spare = sum(of.values()) - len(of)
            for word in ("parc", "bruit", "calme", "gare", "les"):
                hits = [x for x in rows if x[1] == place and word in x[4].split()]
                learnt = [x for x in hits if x[0][0] not in "012"]
                got = next(x for x in found if x.word == word and x.code_commune == place)
                assert (got.up, got.down) == tuple(sum(x[3] == s for x in learnt) for s in ("positif", "negatif"))
                exact = len({x[0] for x in hits})
                assert got.n - spare <= exact <= got.n
            if dealt.rdd.getNumPartitions() == 1:
                assert spare <= 5


def test_rollup_shuffles_no_text(spark, monkeypatch):
    """Beyond the words that travel with the tasks, all texts were shuffled to their scores."""
    d = "/root/testdata/sf0.001"
    expected = sorted(map(str, registry.QUERIES["review_rollup"](spark, d).collect()))
    monkeypatch.setattr(sentiment, "COMMON_WORDS", 3)
    stored = {}

    def keep(df, name="staged"):
        if name in ("scored", "sums"):
            stored[name] = df
        return plain(df, name)

    plain = registry.staged
    for module in (registry, sentiment, reviews):
        monkeypatch.setattr(module, "staged", keep)
    assert sorted(map(str, registry.QUERIES["review_rollup"](spark, d).collect())) == expected
    assert set(stored) == {"scored", "sums"}
    for df in stored.values():
        assert "text" not in df.columns
    assert "text#" not in stored["scored"]._jdf.queryExecution().executedPlan().toString()


def test_silver_gate_scores_no_segments_and_stores_keys(spark, monkeypatch):
    """The gate, which reports the scored segments as absent, had them scored, and stored whole tables."""
    from parcella.operators import quality

    stored = {}

    def keep(df, name="staged"):
        stored[name] = df.columns
        return plain(df, name)

    plain = quality.staged
    monkeypatch.setattr(quality, "staged", keep)
    monkeypatch.setattr(registry, "_scored", None)
    rows = registry.QUERIES["silver_gate"](spark, "/root/testdata/sf0.001").collect()
    assert ("avis_segments", "absente") in {(r.table, r.statut) for r in rows}
    assert len(stored) > 10 and {tuple(c) for c in stored.values()} == {("code_commune",)}


def test_dq_report_joins_no_text(spark, monkeypatch):
    """Beyond the words that travel with the tasks, all texts were joined to their scores."""
    from parcella.operators import quality

    def report(tables):
        frames.update(tables)
        return plain(tables)

    d, frames, plain = "/root/testdata/sf0.001", {}, quality.dq_report
    monkeypatch.setattr(registry, "_silver", lambda spark, d: {})
    expected = sorted(map(str, registry.QUERIES["dq_report"](spark, d).collect()))
    monkeypatch.setattr(quality, "dq_report", report)
    monkeypatch.setattr(sentiment, "COMMON_WORDS", 3)
    assert sorted(map(str, registry.QUERIES["dq_report"](spark, d).collect())) == expected and len(expected) == 4
    texts = {r[0] for r in frames["avis_segments"].select("text").collect()}
    assert all(set(t) <= {"x"} and len(t) >= 15 for t in texts)


def test_weights_are_found_by_whole_words(monkeypatch):
    """Whatever fingerprints words share, only the known ones get a weight."""
    r = random.Random(5)
    some = sorted({"".join(r.choices("abéßп", k=r.randrange(0, 9))) for _ in range(900)})
    names, known = pa.array(some, pa.string()), pa.array(some[::3][::-1], pa.string())
    values = np.arange(1, len(known) + 1, dtype=np.int64)
    expected = dict(zip(known.to_pylist(), values.tolist()))
    plain = words.fingerprints
    assert len(set(plain(names).tolist())) == len(some)
    assert plain(names.slice(7, 50)).tolist() == plain(names).tolist()[7:57]
    for prints in (plain, lambda w: plain(w) % np.uint64(40), lambda w: plain(w) * np.uint64(0)):
        monkeypatch.setattr(words, "fingerprints", prints)
        has, weight = words.Weights(known, values).of(names)
        assert {w: x for w, h, x in zip(some, has, weight) if h} == expected and not weight[~has].any()
    assert not words.Weights(known[:0], values[:0]).of(names)[0].any()


def test_only_segments_with_rare_words_meet_the_weights(spark, monkeypatch):
    """Beyond the words that travel with the tasks, all segments and their tokens were shuffled twice."""
    rows = [(f"{i % 40:x}", i % 3, "positif" if i % 2 else "negatif", f"calme parc rue{'x' if i % 6 == 0 else ''}") for i in range(120)]
    df = spark.createDataFrame(rows, "avis_id string, segment_id int, polarity_field string, text string").coalesce(2)
    weights = sentiment.learnt_weights(df)
    expected = sorted(map(str, sentiment.score_by_words(df, weights).collect()))
    stored = {}

    def keep(df, name="staged"):
        stored[name] = plain(df, name)
        return stored[name]

    plain = sentiment.staged
    monkeypatch.setattr(sentiment, "staged", keep)
    scored = sentiment.score_by_words(df, weights, 3)
    assert sorted(map(str, scored.collect())) == expected
    sums = stored["sums"]
    assert sums.count() == 120 and sums.where("size(_sum.rest) > 0").count() == 20
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "Aggregate [avis_id" not in plan


def test_a_large_vocabulary_travels_with_the_tasks(spark, monkeypatch):
    """Past 100,000 learnt words, all tables met their weights by two shuffles of all segments."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = F.concat(F.lit("w"), F.translate(F.lpad(F.col("id").cast("string"), 6, "0"), "0123456789", letters[:10]))
    weights = spark.range(150_000).select(word.alias("word"), F.col("id").alias("weight"), (F.col("id") % 50 + 5).alias("n_segments"))
    df = spark.createDataFrame([("a", 0, "waaaaaf wbejjjj autre"), ("b", 0, "autre")], "avis_id string, segment_id int, text string")
    scored = sentiment.score_by_words(df, weights)
    assert {r.avis_id: r.model_score for r in scored.collect()} == {"a": 150004 / 151004, "b": None}
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
