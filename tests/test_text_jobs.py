"""Reviews, raw parsers, quality gates and storage on small golden cases."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from parcella.functions import text
from parcella.operators import quality, raw, reviews
from parcella.plans import exports
from parcella.sources import readers, writers
from parcella.sources.layout import Layout
from parcella.sources.staging import shared_folder, spread, staged

REVIEW = "avis_id string, code_commune string, nom_ville string, date_avis date"
SEGMENT = (
    "avis_id string, code_commune string, date_avis date, segment_id int, polarity_field string, "
    "text string, themes array<string>, model_score double, sentiment double, concordant boolean"
)
TOKEN = (
    "code_commune string, avis_id string, segment_id int, token string, kind string, "
    "themes array<string>, sentiment double"
)
DAY = datetime.date(2024, 1, 1)


def rollup(spark, review_ids, segments, tokens):
    return reviews.review_rollup(
        spark.createDataFrame([(i, "01001", "X", DAY) for i in review_ids], REVIEW),
        spark.createDataFrame(segments, SEGMENT),
        spark.createDataFrame(tokens, TOKEN),
        "habitants",
    ).first()


def seg(review, n, tone, body="seg", themes=(), concordant=True):
    polarity = "positif" if tone >= 0 else "negatif"
    return (review, "01001", DAY, n, polarity, body, list(themes), tone, tone, concordant)


def tok(review, word="mot", tone=0.5):
    return ("01001", review, 0, word, "nom", [], tone)


def test_one_review_one_vote(spark):
    row = rollup(
        spark,
        "ab",
        [seg("a", 0, 0.9), seg("a", 1, 0.9), seg("a", 2, 0.9), seg("b", 0, -0.9)],
        [tok("a")],
    )
    assert row.sentiment_global == pytest.approx(0.0)
    assert (row.n_avis, row.low_data) == (2, True)


def test_theme_needs_three_segments(spark):
    few = [seg(f"a{i}", 0, 0.5, themes=["transports"]) for i in range(2)]
    assert rollup(spark, ["a0", "a1"], few, [tok("a0")]).themes == []
    enough = [seg(f"a{i}", 0, 0.5, themes=["transports"]) for i in range(3)]
    assert [t.theme for t in rollup(spark, ["a0"], enough, [tok("a0")]).themes] == ["transports"]


def test_cloud_weight_counts_reviews(spark):
    row = rollup(
        spark,
        "ab",
        [seg("a", 0, 0.5), seg("b", 0, 0.5)],
        [tok("a", "parc")] * 3 + [tok("b", "parc"), tok("a", "rue")],
    )
    assert [(w.word, w.weight, w.sentiment) for w in row.wordcloud] == [
        ("parc", 2, "positive"),
        ("rue", 1, "positive"),
    ]
    assert len(row.wordcloud_preview) == 2


def test_quotes(spark):
    row = rollup(
        spark,
        "abc",
        [
            seg("a", 0, 0.8, "x" * 100),
            seg("a", 1, 0.6, "w" * 100),  # weaker quote of the same review
            seg("b", 0, -0.8, "y" * 100),
            seg("c", 0, -0.5, "z" * 100, concordant=False),
        ],
        [tok("a")],
    )
    labels = {q.label: q for q in row.verbatims}
    assert set(labels) == {"Positif", "Négatif", "Nuancé"} and len(row.verbatims) == 3
    assert labels["Positif"].text == "x" * 100
    assert (labels["Positif"].mois, labels["Positif"].theme) == ("2024-01", "autre")


def test_empty_lists_not_null(spark):
    row = rollup(spark, "a", [seg("a", 0, 0.5, "court")], [tok("a")])
    assert (row.verbatims, row.themes) == ([], [])


RAW_REVIEW = (
    "slug string, code_commune string, nom_ville string, date string, auteur string, "
    "note_moyenne string, environnement string, points_positifs string, points_negatifs string, "
    "ligne int"
)


@pytest.fixture(scope="module")
def raw_reviews(spark):
    return spark.createDataFrame(
        [
            ("brest", "2019", "Brest", "02-09-2022", "Pseudo-A", "6,25", "9",
             "→ Rues paisibles et peu de circulation. La boulangerie du coin est parfaite.",
             "Aucun tram après minuit, c'est dommage.", 0),
            ("brest", "2019", "Brest", "07-01-2021", "Pseudo-B", "3.00", "2",
             "Deux restaurants corrects.", "Un cambriolage dans notre immeuble chaque hiver.", 1),
            ("albi", "81004", "Albi", "", "Pseudo-C", "9.00", "",
             "Lycée réputé, parcs sans déchets ni pollution.", None, 2),
        ],
        RAW_REVIEW,
    )


def test_review_chain_is_anonymous(raw_reviews):
    clean = reviews.clean_reviews(raw_reviews, "ligne")
    segments = reviews.score_segments(reviews.tag_themes(reviews.segment_reviews(clean)))
    final = reviews.review_sentiment(clean, segments)
    tokens = reviews.extract_tokens(segments)
    for frame in (final, segments, tokens):
        assert "auteur" not in frame.columns
        leaked = frame.select(F.to_json(F.struct("*")).alias("j")).where(
            F.col("j").rlike("Pseudo-[ABC]")
        )
        assert leaked.count() == 0
    rows = {r.slug + str(r.date_avis): r for r in final.collect()}
    assert {r.code_commune for r in rows.values()} == {"02019", "81004"}
    assert rows["albiNone"].date_avis is None
    assert rows["brest2022-09-02"].sentiment_avis == pytest.approx((0.6 + 0.6 - 0.6) / 3)
    found = {t for r in segments.collect() for t in r.themes}
    assert {"transports", "commerces", "securite", "education", "environnement"} <= found
    order = segments.where("avis_id = '%s'" % rows["brest2022-09-02"].avis_id)
    assert [r.polarity_field for r in order.orderBy("segment_id").collect()] == [
        "positif", "positif", "negatif"
    ]


def test_model_scores_are_blended(raw_reviews):
    segments = reviews.segment_reviews(reviews.clean_reviews(raw_reviews, "ligne"))
    rows = reviews.score_segments(
        segments, lambda texts: [None if "Rues" in t else -0.9 for t in texts]
    ).collect()
    for r in rows:
        prior = 1 if r.polarity_field == "positif" else -1
        if "Rues" in r.text:
            assert (r.model_score, r.concordant) == (None, None)
            assert r.sentiment == pytest.approx(0.6 * prior)
        else:
            assert r.sentiment == pytest.approx(max(-1, 0.35 * prior - 0.65 * 0.9))
            assert r.concordant == (prior < 0)


def test_review_export_hides_thin_themes(spark, outlines):
    rows = [
        (c, "V", n, DAY, DAY, 0.42, n < 10, [("calme", 8, 0.7, 0.2, 0.5)], [], [], [])
        for c, n in (("01001", 12), ("01002", 4))
    ]
    frame = spark.createDataFrame(rows, exports.REVIEW_ROLLUP_SCHEMA)
    export = exports.review_export(frame, "habitants")
    got = {r.code_commune: r for r in export.collect()}
    assert got["01001"].themes is not None and got["01002"].themes is None
    index = [tuple(r) for r in exports.review_index(export, outlines).collect()]
    assert index == [("01001", "V", 12, 0.5, 0.5), ("01002", "V", 4, 1.5, 0.5)]
    empty = exports.review_export(exports.no_reviews(frame), "habitants")
    assert empty.count() == 0


# --- raw parsers -------------------------------------------------------------

SHEET = """poste de mesure
periode de trente ans
HAUTE-COLLINE (99)
altitude 812 m lat : 44°30'00"N lon : 03°15'36"W

Insolation totale (heures)
10;20;30;40;50;60;70;80;90;100;110;120;1543,5

Température moyenne (Moyenne en °C)
-1;0;1;2;3;4;5;6;7;8;9;10;4,5"""


def test_station_sheet(spark):
    df = spark.createDataFrame(
        [("1", SHEET), ("2", "vide"), ("3", SHEET.replace("Insolation", "Rien"))],
        "num string, sheet string",
    )
    rows = raw.parse_station_sheets(df, "num", "sheet").collect()
    assert [tuple(r) for r in rows] == [("1", 44.5, -3.26, 1543.5, 4.5)]


def review(date, author, mean, notes, texts):
    cells = "".join(f"<tr><th>{n}</th> <td class=x>{v}</td></tr>" for n, v in notes)
    parts = " ".join(f"<b>{label}</b> {body}" for label, body in texts)
    return (
        f'<div class="comm" id=c><p>Avis posté le {date} à 8h. Par <strong>{author}</strong></p>'
        f'<p class="moyenne">{mean}</p><table>{cells}</table><p>{parts}</p>'
    )


PAGE = (
    "<h1>sur-le-lac (99001)</h1><section>"
    + review("01-02-2020", "Premier", "8,25", [("Environnement", 9), ("Transports", 1), ("Sécurité", 3)],
             [("Points positifs", "Vue <i>superbe</i> au matin."), ("Points négatifs", "Peu de bus.")])
    + '</div><div class="comm">jamais noté</div>'
    + review("03-04-2021", "Second", "2,00", [], [("Points positifs", "Le port.")])
)


def test_review_page(spark):
    df = spark.createDataFrame(
        [("lac", "99001", "Sur-le-Lac", PAGE)],
        "slug string, code_commune string, nom_ville string, html string",
    )
    first, last = raw.extract_review_pages(df).orderBy("note_moyenne", ascending=False).collect()
    assert (first.date, first.auteur, first.note_moyenne) == ("01-02-2020", "Premier", "8.25")
    assert (first.environnement, first.transports, first.securite, first.sante) == (
        "9", "1", "3", "",
    )
    assert first.points_positifs == "Vue  superbe  au matin."
    assert first.points_negatifs == "Peu de bus."
    assert (last.auteur, last.points_positifs, last.points_negatifs) == ("Second", "Le port.", "")
    assert df.select(raw.page_title("html")).first()[0] == "Sur-Le-Lac"


def test_landing_skips_known_content(spark, tmp_path):
    listing = spark.createDataFrame(
        [("web", "bus", "a.csv", "1"), ("web", "bus", "b.csv", "2")],
        "source string, dataset string, name string, content string",
    )
    path = str(tmp_path / "bronze")
    assert raw.land_files(listing, path, "2024-01-01")[1] == 2
    assert raw.land_files(listing, path, "2024-01-01")[1] == 0
    changed = listing.withColumn(
        "content", F.when(F.col("name") == "b.csv", "3").otherwise(F.col("content"))
    )
    known = raw.last_contents(raw.ledger(spark, path))
    assert [r.name for r in raw.new_files(changed, known, "2024-01-01").collect()] == ["b.csv"]
    assert raw.new_files(listing, known, "2024-01-02").count() == 2
    assert raw.land_files(changed, path, "2024-01-01")[1] == 1
    assert raw.land_files(listing, path, "2024-01-01")[1] == 1  # the older content is new again
    found = {r.name: r.content for r in raw.landed_files(spark, path).collect()}
    assert found == {"a.csv": "1", "b.csv": "2"}
    assert raw.ledger(spark, path).count() == 4


def test_a_landing_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    listing = spark.createDataFrame(
        [("web", "bus", "a.csv", "1")], "source string, dataset string, name string, content string"
    )
    path = str(tmp_path / "bronze")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(raw.snapshots, "move", die)
        with pytest.raises(RuntimeError, match="lost"):
            raw.land_files(listing, path, "2024-01-01")
    assert raw.ledger(spark, path).count() == 0
    assert raw.land_files(listing, path, "2024-01-01")[1] == 1
    assert [r.content for r in raw.landed_files(spark, path).collect()] == ["1"]


# --- quality -----------------------------------------------------------------


def test_rules_count_violations_in_one_scan(spark):
    df = spark.createDataFrame([("75056", 30000.0, 20000.0), ("1", None, 1.0)],
                               "code_commune string, revenu_median double, revenu_q1 double")
    report = quality.validate_rules(df, quality.RULES["revenus"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    assert [r.violations for r in report.collect()] == [1, 1, 0, 0]


def test_silver_gate_reports_before_stopping(spark, tmp_path):
    bad = spark.sql(
        "SELECT '01001' AS code_commune, 999999D AS revenu_median, 500D AS revenu_q1"
    )
    path = str(tmp_path / "report")
    with pytest.raises(quality.CriticalRuleViolation, match="revenus"):
        quality.check_silver({"revenus": bad}, path)
    assert spark.read.json(path).where("statut = 'KO'").count() == 1
    good = bad.withColumn("revenu_median", F.lit(30000.0))
    rows = quality.check_silver({"revenus": good}).collect()
    assert {r.statut for r in rows if r.table == "revenus"} == {"OK"}
    assert {r.table for r in rows if r.statut == "absente"} == set(quality.GATED) - {"revenus"}


def test_gold_gate(spark):
    scores = spark.sql(
        "SELECT '75056' AS code_commune, 0.5D AS score_valeur, 0.1D AS gap, 0.05D AS gap_pondere"
    )
    with pytest.raises(quality.CriticalRuleViolation, match="scored communes"):
        quality.check_gold(scores)
    previous = spark.createDataFrame([("75056", 1)], "code_commune string, rang int")
    report = quality.check_gold(scores, previous_top=previous, min_rows=1)
    assert report["kendall_tau"] == 1.0 and report["top"] == ["75056"]


def test_zone_and_review_gates(spark):
    zones = spark.sql(
        "SELECT '1' AS code_iris, 0.5D AS n_prix_iris, 0.1D AS gap_iris, 0.5D AS score_commune"
    )
    assert quality.check_zones(zones)["nb_iris_scores"] == 1
    with pytest.raises(quality.CriticalRuleViolation, match="dupliques"):
        quality.check_zones(zones.unionByName(zones))
    with pytest.raises(quality.CriticalRuleViolation, match="empty"):
        quality.check_zones(zones.where("false"))
    rollup_row = spark.sql(
        "SELECT 12L AS n_avis, false AS low_data, 0.2D AS sentiment_global, array('a') AS wordcloud"
    )
    assert quality.check_reviews(rollup_row)["nb_communes_avis"] == 1
    with pytest.raises(quality.CriticalRuleViolation, match="low_data"):
        quality.check_reviews(rollup_row.withColumn("low_data", F.lit(True)))


def test_profile_approximate_matches_exact_on_small_data(spark):
    df = spark.range(200).select("id", (F.col("id") % 7).cast("string").alias("c"))
    exact, rough = (
        quality.profile_table(df, ["id"], exact=e).orderBy("position").collect()
        for e in (True, False)
    )
    assert [r.cardinalite for r in exact] == [200, 7]
    assert abs(rough[0].cardinalite - 200) < 20 and rough[1].cardinalite == 7
    assert exact[0].mediane == 99.5


def test_rule_packs_are_complete():
    assert len(quality.RULES) == 16
    assert sum(len(pack) for pack in quality.RULES.values()) == 62
    assert "commune_geom" not in quality.GATED


# --- storage -----------------------------------------------------------------


def test_semicolon_csv_skips_bad_rows_even_for_one_column(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w", encoding="utf-8") as out:
        out.write('a;b\n1;"x;y"\n2;3;4\n5\n6;7\n')
    assert [r.a for r in readers.semicolon_csv(spark, path).select("a").collect()] == ["1", "6"]


def test_sale_schema_has_forty_columns():
    schema = readers.sale_schema()
    assert len(schema) == 40
    assert [f.name for f in schema if f.dataType.simpleString() == "double"][:2] == [
        "valeur_fonciere",
        "lot1_surface_carrez",
    ]


def test_features_round_trip(spark, outlines, tmp_path):
    path = str(tmp_path / "features")
    writers.features(outlines, path, digits=4, split_by="code_commune")
    assert {d for d in os.listdir(path) if "=" in d} == {
        "code_commune=01001", "code_commune=01002", "code_commune=2A004"
    }
    back = readers.feature_lines(spark, path, "nom_commune string, surface_km2 double")
    got = {r.nom_commune: r.geom for r in back.collect()}
    expected = {r.nom_commune: r.geom for r in outlines.collect()}
    assert got == expected


def test_json_keeps_null_fields(spark, tmp_path):
    path = str(tmp_path / "json")
    writers.json(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS prix"), path)
    assert json.loads(spark.read.text(path).first()[0]) == {"a": 1, "prix": None}


def test_whole_and_binary_files(spark, tmp_path):
    (tmp_path / "x.data").write_text("un\ndeux")
    row = readers.whole_files(spark, str(tmp_path)).first()
    assert row.value == "un\ndeux" and row.path.endswith("x.data")
    file = readers.binary_files(spark, str(tmp_path)).first()
    assert file.length == 7 and len(file.sha256) == 64


def test_layout_and_optional_tables(spark, tmp_path):
    paths = Layout(str(tmp_path))
    assert paths.silver("ventes", 2024).endswith("silver/ventes/year=2024")
    assert paths.gold("score", "2024-01-01").endswith("gold/score/run_date=2024-01-01")
    assert readers.optional_parquet(spark, paths.latest("score")) is None
    assert readers.optional_parquet(spark, paths.latest("score"), "a int").count() == 0
    writers.parquet(spark.range(3), paths.latest("score"))
    assert readers.optional_parquet(spark, paths.latest("score")).count() == 3


def test_staged_lives_in_the_shared_folder(spark):
    frame = staged(spark.range(5))
    assert frame.count() == 5
    assert shared_folder(spark) in frame.inputFiles()[0].replace("file:", "").replace("//", "/")
    assert spread(frame.coalesce(1)).rdd.getNumPartitions() >= 4


def test_theme_pattern_needs_no_lookaround():
    assert "(?=" not in text.theme_pattern(("espace vert",))
    assert "(?<" not in text.theme_pattern(("espace vert",))


@pytest.fixture(scope="module")
def wordy(spark):
    """Segments of two communes with ties, repeated words, numbers in words and no words."""
    import random

    r = random.Random(5)
    words = [a + b for a in ("mar", "jard", "éco", "gar", "plag") for b in ("in", "ot", "ette", "x²", "es")] + ["les", "de", "ville"]
    rows = []
    for i in range(160):
        code = "01001" if i % 3 else "01002"
        for k in range(1 + i % 4):
            body = " ".join(r.choices(words, weights=range(1, len(words) + 1), k=12))
            rows.append((f"r{i}", code, DAY, k, "positif", body, r.sample(["calme", "bruit"], 1), 0.1, r.choice([0.5, -0.25]), True))
    rows.append(("r1", "01001", DAY, 9, "positif", None, [], None, 0.6, None))
    return spark.createDataFrame(rows, SEGMENT)


def test_token_counts_are_those_of_the_token_rows(wordy):
    expected = (
        reviews.extract_tokens(wordy)
        .groupBy("code_commune", "kind", "token")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("avis_id").alias("n_avis"))
    )
    got = reviews.token_counts(wordy.repartition(7))
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("size", [1, 3, 10, 40, 1000])
def test_leading_tokens_hold_the_whole_cloud(wordy, size):
    every, leading = reviews.extract_tokens(wordy), reviews.leading_tokens(wordy, size)
    assert leading.columns == every.columns and leading.dtypes == every.dtypes
    rows = {tuple(map(str, r)) for r in every.collect()}
    kept = [tuple(map(str, r)) for r in leading.collect()]
    assert set(kept) <= rows and len(set(kept)) == len(kept)
    assert size > 3 or len(kept) < len(rows) / 2
    cloud, expected = (sorted(map(str, reviews.cloud_words(t, size).collect())) for t in (leading, every))
    assert cloud == expected


def test_sales_profile_groups_every_column_once(spark, monkeypatch):
    """Sales and communes served their cardinalities too, but were grouped a second time."""
    from parcella.plans import sales_profile, views

    stored = {}

    def keep(df, name="staged"):
        stored[name] = df
        return staged(df, name)

    monkeypatch.setattr(sales_profile, "staged", keep)
    lines = views.view(spark, "/root/testdata/sf0.001", "sale_raw").drop("annee").limit(500).localCheckpoint()
    found = {(r.section, r.mesure): r.valeur for r in sales_profile.profile_sales(lines, error=1e-6).collect()}
    distinct = {c: lines.select(c).distinct().count() for c in sales_profile.CARDINALITIES}
    assert stored["grains"].count() == sum(distinct.values())
    assert {c: found["cardinalites", c] for c in distinct} == distinct
