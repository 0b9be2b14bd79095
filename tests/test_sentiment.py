"""The scorer learnt from the declared fields of reviews."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from parcella.functions import text
from parcella.operators import reviews, sentiment

SCHEMA = "avis_id string, segment_id int, polarity_field string, text string"
GOOD, BAD = ("calme", "agréable", "parc"), ("bruit", "sale", "danger")


def segments_of(spark, n=240, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        for k, (side, liked, other) in enumerate((("positif", GOOD, BAD), ("negatif", BAD, GOOD))):
            words = r.choices(liked, k=3) + r.choices(other, k=1) + r.choices(["les", "rues", "du", "centre"], k=4)
            words += [f"mot{chr(97 + r.randrange(26))}x"] * 2
            rows.append((f"{r.randrange(16**8):08x}", k, side, " ".join(words).capitalize() + f", {i} !"))
    return rows, spark.createDataFrame(rows, SCHEMA)


def brute_weights(rows):
    seen = [x for x in rows if x[0][0] not in "012"]
    words = [(x[2] == "positif", {w for w in re.findall(r"[^\W\d_]+", x[3].lower()) if len(w) >= 3}) for x in seen]
    up, down = (sum(side == u for u, _ in words) for side in (True, False))
    out = {}
    for w in set().union(*(ws for _, ws in words)):
        p, n = (sum(w in ws for u, ws in words if u == side) for side in (True, False))
        if p + n >= sentiment.LEAST_SEGMENTS:
            odds = math.log(((p + 1) / (up + 2)) / ((n + 1) / (down + 2)))
            out[w] = round(1000 * odds * (p + n) / (p + n + sentiment.SHRINKAGE))
    return out


def test_weights_match_brute_force_and_leave_out_the_held_out(spark):
    rows, frame = segments_of(spark)
    got = {r.word: r.weight for r in sentiment.learnt_weights(frame).collect()}
    assert got == brute_weights(rows)
    assert min(got[w] for w in GOOD) > 500 and max(got[w] for w in BAD) < -500
    assert "du" not in got and abs(got["rues"]) < 200


def test_join_and_batch_give_the_same_scores(spark):
    rows, frame = segments_of(spark)
    weights = sentiment.learnt_weights(frame)
    odd = spark.createDataFrame([("x", 0, "positif", "zzz 123"), ("y", 0, "negatif", ""), ("z", 0, "positif", None)], SCHEMA)
    every = frame.unionByName(odd)
    joined, batch = (
        {(r.avis_id, r.segment_id): (r.model_score, r.sentiment, r.concordant) for r in reviews.score_segments(every, s).collect()}
        for s in (weights, sentiment.batch_scorer(weights))
    )
    assert joined == batch and len(joined) == len(rows) + 3
    assert [joined[k, 0][0] for k in "xyz"] == [None] * 3
    known = brute_weights(rows)
    for a, k, _, t in rows:
        total = sum(known.get(w, 0) for w in {w for w in re.findall(r"[^\W\d_]+", t.lower()) if len(w) >= 3})
        assert joined[a, k][0] == pytest.approx(total / (abs(total) + 1000), abs=1e-12)
    with pytest.raises(ValueError, match="join"):
        sentiment.batch_scorer(weights, most=3)


def test_holdout_report_reads_only_unseen_reviews(spark):
    rows, frame = segments_of(spark)
    scored = reviews.score_segments(frame, sentiment.learnt_weights(frame))
    rated = spark.createDataFrame(
        [(a, 9.0 if side == "positif" else 1.0) for a, _, side, _ in rows], "avis_id string, note_moyenne double"
    )
    report = sentiment.holdout_report(rated, scored).first()
    unseen = [x for x in rows if x[0][0] in "012"]
    assert report.n_segments == len(unseen) == report.n
    assert report.agreement > 0.9 and report.pearson > 0.8 and report.spearman > 0.7


def test_star_probabilities_fold_back(spark):
    scores = spark.createDataFrame([(x / 20,) for x in range(-20, 21)], "s double")
    p = sentiment.star_probabilities(F.col("s"))
    for r in scores.select("s", p.alias("p"), text.stars_to_score(p).alias("b")).collect():
        assert sum(r.p) == pytest.approx(1) and r.b == pytest.approx(r.s) and min(r.p) >= 0


def test_scorer_takes_any_number_of_words(spark, monkeypatch):
    rows, frame = segments_of(spark)
    weights = sentiment.learnt_weights(frame)

    def scores():
        scored = reviews.score_segments(frame, sentiment.scorer(weights))
        return {(r.avis_id, r.segment_id): (r.model_score, r.sentiment, r.concordant) for r in scored.collect()}

    in_batches = scores()
    assert callable(sentiment.scorer(weights))
    monkeypatch.setattr(sentiment, "WORDS_IN_MEMORY", 3)
    assert scores() == in_batches and len(in_batches) == len(rows)


def test_batch_query_scores_large_vocabularies(spark, monkeypatch):
    """The query failed once more words were learnt than a task may hold."""
    from parcella.plans import registry

    query, d = registry.QUERIES["segment_sentiment_batch"], "/root/testdata/sf0.001"
    expected = sorted(map(tuple, query(spark, d).collect()), key=str)
    monkeypatch.setattr(sentiment, "WORDS_IN_MEMORY", 3)
    assert sorted(map(tuple, query(spark, d).collect()), key=str) == expected


def test_rare_words_are_joined_to_the_rest_of_the_weights(spark):
    """Whatever number of words travels with the tasks, scores stay; numbers such as ² end words."""
    rows, frame = segments_of(spark)
    odd = spark.createDataFrame([("x", 0, "positif", "calmeⅧparc bruit² Straße"), ("z", 0, "positif", None)], SCHEMA)
    weights, every = sentiment.learnt_weights(frame), frame.unionByName(odd)

    def scores(scored):
        return {(r.avis_id, r.segment_id): r.model_score for r in scored.collect()}

    expected = scores(sentiment.score_by_words(every, weights))
    for most in (0, 1, 3, 10):
        assert scores(sentiment.score_by_words(every, weights, most)) == expected
    assert scores(reviews.score_segments(every, sentiment.batch_scorer(weights))) == expected
    known = brute_weights(rows)
    total = known["calme"] + known["parc"] + known["bruit"]
    assert expected["x", 0] == pytest.approx(total / (abs(total) + 1000), abs=1e-12)
