"""Sales, spatial, score and export jobs on small golden cases."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from shapes import square

from parcella.functions import geo
from parcella.operators import indicators, nearest, sales, scores, spatial, territories
from parcella.operators.scores import DIMENSIONS
from parcella.plans import exports

RAW = (
    "id_mutation string, nature_mutation string, type_local string, valeur_fonciere string, "
    "surface_reelle_bati string, code_commune string, nom_commune string, "
    "code_departement string, longitude string, latitude string"
)


def sale(i, value="300000", surface="50", kind="Appartement", nature="Vente", lon="2.35"):
    return (str(i), nature, kind, value, surface, "75056", "Paris", "75", lon, "48.86")


@pytest.mark.parametrize("method", ["ranked", "state"])
def test_sales_end_to_end(spark, method):
    rows = [sale(i) for i in range(1, 6)] + [
        sale(6, "400000", "80", "Maison"),
        sale(7, "100000", "1"),  # implausible price and surface
        sale(8, nature="Echange"),
        sale(9, value="abc"),
    ]
    clean = sales.clean_sales(spark.createDataFrame(rows, RAW), method=method)
    row = sales.price_by_commune(clean, method=method).first()
    assert (row.code_commune, row.nb_transactions, row.fiable) == ("75056", 6, True)
    assert row.prix_m2_median == 6000.0


def test_dedup_rules(spark):
    rows = [
        sale(1, surface="30"),
        sale(1, surface="20", lon=None),
        sale(2),
        sale(2, value="999"),  # two values: left out
        sale(3),
        sale(3, kind="Maison"),  # two types: left out
    ]
    got = sales.dedup_sales(sales.clean_sale_lines(spark.createDataFrame(rows, RAW))).collect()
    assert [(r.id_mutation, r.surface_bati, r.prix_m2, r.longitude) for r in got] == [
        ("1", 50.0, 6000.0, 2.35)
    ]


def test_lines_of_a_sale_are_summed_without_sorting_them(spark):
    """Lines alike in type and place are added up by hash, dealt once; only what is left is sorted."""
    rows = [sale(i % 7, surface=str(10 + i), lon=(None, "2.35", "2.31", "abc")[i % 4]) for i in range(60)]
    lines = sales.clean_sale_lines(spark.createDataFrame(rows, RAW))
    found = sales.dedup_sales(lines)
    got = {r.id_mutation: (r.surface_bati, r.longitude) for r in found.collect()}
    assert got == {str(k): (sum(10.0 + i for i in range(60) if i % 7 == k), 2.35) for k in range(7)}
    steps = found._jdf.queryExecution().sparkPlan().toString().splitlines()
    first = next(s for s in reversed(steps) if "Aggregate" in s)
    assert "HashAggregate" in first
    planned = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert planned.count("Exchange ") == 1


def test_grouping_sets_conserve_counts(spark):
    df = spark.createDataFrame(
        [("01", "Maison", 1.0), ("01", "Maison", 3.0), ("01", None, 5.0), ("02", "Maison", 7.0)],
        "code_departement string, type_local string, prix_m2 double",
    )
    rows = sales.price_by_department(df).collect()
    total = {r.code_departement: r.nb_transactions for r in rows if r.tous_types}
    split = {}
    for r in rows:
        if not r.tous_types:
            split[r.code_departement] = split.get(r.code_departement, 0) + r.nb_transactions
    assert total == split == {"01": 3, "02": 1}


@pytest.fixture(scope="module")
def pooled(spark):
    return spark.createDataFrame(
        [
            ("2024-1", "01001", 0.0, 0.0, 1000.0, 2024),
            ("2024-2", "01001", 0.0, 0.0, 1100.0, 2024),
            ("2024-3", "01001", 0.0, 0.0, 1200.0, 2024),
            ("2024-4", "01002", 1.2, 0.5, 2000.0, 2024),
            ("2024-5", "01002", 1.8, 0.5, 4000.0, 2024),
            ("2024-6", "01002", 1.5, 0.5, 3000.0, 2024),
            ("2024-7", "99999", 0.5, 0.5, 9000.0, 2024),
            ("2021-1", "01001", 0.0, 0.0, 900.0, 2021),
            ("2021-2", "01001", 0.0, 0.0, 950.0, 2021),
            ("2021-3", "01002", 1.3, 0.2, 1800.0, 2021),
        ],
        "id_mutation string, code_commune string, longitude double, latitude double, "
        "prix_m2 double, annee int",
    )


@pytest.mark.parametrize("cell", [0.1, 0.25, 3.0])
def test_zone_prices_golden(pooled, zones, cell):
    assigned = territories.assign_to_zones(pooled, zones, cell=cell)
    rows = {r.code_iris: r for r in territories.zone_prices(assigned).collect()}
    alpha, west, east = (rows[c] for c in ("010010000", "010020101", "010020102"))
    assert (alpha.nb_transactions, alpha.fiable, alpha.prix_m2_median) == (5, True, 1000.0)
    assert (alpha.annee_min, alpha.annee_max, alpha.nb_millesimes) == (2021, 2024, 2)
    assert (west.nb_transactions, west.fiable) == (3, False)  # holds the border point
    assert east.nb_transactions == 1
    assert sum(r.nb_transactions for r in rows.values()) == 9


def test_zone_siblings(spark):
    geom = [square(0.0, 0.0, 1.0, 1.0)]
    raw = spark.createDataFrame(
        [
            ("1001", "A", "010010101", "a", "H", geom),
            ("01001", "A", "010010102", "b", "H", geom),
            ("01002", "B", None, "c", "Z", geom),
            ("01003", "C", "010030000", "d", "Z", None),
        ],
        "code_insee string, nom_commune string, code_iris string, nom_iris string, "
        "type_iris string, geom array<array<array<array<double>>>>",
    )
    rows = territories.zone_outlines(raw).collect()
    assert {(r.code_commune, r.nb_iris_commune) for r in rows} == {("01001", 2)}


@pytest.fixture(scope="module")
def commune_scores(spark):
    return spark.createDataFrame(
        [
            ("01001", "Alpha", "01", 0.6, 0.4, 0.5),
            ("01002", "Beta", "01", 0.3, 0.2, 0.8),
            ("75108", "Paris 8e", "75", 0.9, 0.95, 0.1),
        ],
        "code_commune string, nom_commune string, code_departement string, "
        "score_valeur double, n_prix double, n_access_fin double",
    )


def test_zone_score_golden(spark, zones, commune_scores):
    prices = spark.createDataFrame(
        [
            ("010010000", "01001", 8, 1000.0, True, 2021, 2024, 2),
            ("010020101", "01002", 6, 2000.0, True, 2021, 2024, 2),
            ("751080301", "75108", 12, 3000.0, True, 2021, 2024, 2),
            ("010020102", "01002", 2, 9000.0, False, 2024, 2024, 1),
            ("970010101", "97001", 7, 1500.0, True, 2021, 2024, 2),
        ],
        "code_iris string, code_commune string, nb_transactions long, prix_m2_median double, "
        "fiable boolean, annee_min int, annee_max int, nb_millesimes long",
    )
    rows = {r.code_iris: r for r in scores.zone_score(prices, zones, commune_scores).collect()}
    assert set(rows) == {"010010000", "010020101", "751080301"}
    assert [rows[c].n_prix_iris for c in sorted(rows)] == pytest.approx([0.0, 0.5, 1.0])
    assert rows["010020101"].gap_iris == pytest.approx(0.3 - 0.5)
    assert rows["010020101"].gap_pondere_iris == pytest.approx((0.3 - 0.5) * 0.8)
    assert rows["751080301"].nom_iris == "Europe"


def test_spatial_counts_against_brute_force(spark, outlines):
    rng = np.random.default_rng(3)
    points = [(float(x), float(y)) for x, y in rng.uniform(-0.5, 6.5, (400, 2))]
    points += [(1.0, 0.5), (0.0, 0.0), (3.5, 0.5)]
    df = spark.createDataFrame(points, "lon double, lat double")
    boxes = {"01001": [(0, 1)], "01002": [(1, 2)], "2A004": [(3, 4), (5, 6)]}
    expected = {
        code: sum(any(a < x < b and 0 < y < 1 for a, b in parts) for x, y in points)
        for code, parts in boxes.items()
    }
    got = spatial.count_points_in_polygons(
        df, outlines, x="lon", y="lat", code="code_commune", name="n", cell=0.3
    )
    assert {r.code_commune: r.n for r in got.collect()} == expected


def even_odd(shape, x, y):
    odd = False
    for ring in (r for part in shape for r in part):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def star(cx, cy, size, seed, points=17):
    """A concave ring around a centre."""
    r = np.random.default_rng(seed)
    reach = size * r.uniform(0.3, 1.0, points)
    turn = np.sort(r.uniform(0, 2 * np.pi, points))
    ring = [[float(cx + d * np.cos(t)), float(cy + d * np.sin(t))] for d, t in zip(reach, turn)]
    return [*ring, ring[0]]


@pytest.mark.parametrize("cell", [0.07, 0.5, 9.0])
def test_concave_holed_and_scattered_outlines(spark, cell):
    shapes = {
        "concave": [[star(0, 0, 2, 1)]],
        "holed": [[star(3, 3, 2, 2, 60), star(3, 3, 0.4, 3)]],
        "islands": [[star(-5, 2, 1, 4)], [star(40, -30, 0.5, 5)], [star(-5, 4.5, 1, 6), star(-5, 4.5, 0.2, 7)]],
        "none": [],
    }
    r = np.random.default_rng(8)
    points = [(float(x), float(y)) for x, y in r.uniform(-7, 6, (1500, 2))]
    points += [(float(x), float(y)) for x, y in r.normal([40, -30], 0.4, (200, 2))]
    frame = spark.createDataFrame(list(shapes.items()), f"code string, geom {geo.GEOMETRY}")
    got = spatial.points_in_polygons(
        spark.createDataFrame(points, "lon double, lat double"), frame, x="lon", y="lat", keep=["code"], cell=cell
    )
    want = {(c, x, y) for c, shape in shapes.items() for x, y in points if even_odd(shape, x, y)}
    assert {(g.code, g.lon, g.lat) for g in got.collect()} == want
    cells = spatial.polygon_cells(frame, "geom", cell, ["code"])
    assert cells.count() == cells.select("code", "_cx", "_cy").distinct().count()
    assert cells.where("code = 'islands'").count() <= 12 / cell**2 + 60


def haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = (
        math.sin((p2 - p1) / 2) ** 2
        + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def brute_nearest(left, right, cap):
    found = {}
    for k, la, lo in left:
        d, i = min((haversine(la, lo, ra, ro), i) for i, ra, ro in right)
        if d <= cap:
            found[k] = (i, d)
    return found


@pytest.mark.parametrize("places, left_rows", [(65_536, 1_000_000), (8, 25), (3, 7)])
def test_nearest_against_brute_force(spark, places, left_rows):
    """Dense cluster, far outliers, both sides of the date line, a pole, an exact hit; one tree
    and many ranges of the curve."""
    rng = np.random.default_rng(11)
    left = [(f"l{i}", *map(float, p)) for i, p in enumerate(rng.uniform([40, -5], [52, 9], (80, 2)))]
    left += [(f"m{i}", *map(float, p)) for i, p in enumerate(rng.normal([45, 5], 0.05, (60, 2)))]
    left += [("date", 10.0, 179.9), ("pole", 89.9, 0.0), ("hit", 45.0, 5.0), ("lost", -60.0, 0.0)]
    right = [(f"r{i:02d}", *map(float, p)) for i, p in enumerate(rng.normal([45, 5], 0.05, (40, 2)))]
    right += [(f"w{i:02d}", *map(float, p)) for i, p in enumerate(rng.uniform([-80, -180], [80, 180], (40, 2)))]
    right += [("far", 41.0, -4.0), ("east", 10.1, -179.9), ("north", 89.9, 180.0)]
    right += [("twin2", 45.0, 5.0), ("twin1", 45.0, 5.0)]
    nowhere = [("n1", None, 1.0), ("n2", float("nan"), 1.0)]
    got = nearest.nearest_join(
        spark.createDataFrame(left + nowhere, "k string, lat double, lon double"),
        spark.createDataFrame(right + nowhere, "id string, rlat double, rlon double"),
        key="k",
        left_at=("lat", "lon"),
        right_at=("rlat", "rlon"),
        right_id="id",
        keep=["id"],
        distance="km",
        max_km=500,
        places=places,
        left_rows=left_rows,
    )
    assert got.columns == ["k", "id", "km"]
    rows = got.collect()
    mine = {r.k: (r.id, r.km) for r in rows}
    expected = brute_nearest(left, right, 500)
    assert len(rows) == len(mine) and {k: v[0] for k, v in mine.items()} == {k: v[0] for k, v in expected.items()}
    assert all(abs(mine[k][1] - expected[k][1]) < 1e-9 for k in expected)
    assert mine["hit"] == ("twin1", 0.0)
    assert "lost" not in mine


def test_nearest_without_places(spark):
    left = spark.createDataFrame([(1, 45.0, 5.0)], "k long, lat double, lon double")
    right = left.selectExpr("k AS id", "lat AS a", "lon AS b").where("id > 1")
    for one, other in ((left, right), (left.where("k > 1"), left.selectExpr("k AS id", "lat AS a", "lon AS b"))):
        got = nearest.nearest_join(
            one, other, key="k", left_at=("lat", "lon"), right_at=("a", "b"), right_id="id", keep=["id"], distance="km", max_km=9
        )
        assert got.columns == ["k", "id", "km"] and got.count() == 0


@pytest.mark.parametrize("places", [65_536, 100])
def test_nearest_in_a_dense_spot(spark, places):
    """Both sides within a tenth of a metre, beside places far off."""
    r = np.random.default_rng(4)
    left, right = (r.normal([45, 5], 1e-6, (600, 2)) for _ in range(2))
    right[:200] = r.uniform([-80, -180], [80, 180], (200, 2))
    frames = [
        spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], f"{k} long, {k}la double, {k}lo double")
        for k, x in (("a", left), ("b", right))
    ]
    got = nearest.nearest_join(
        *frames, key="a", left_at=("ala", "alo"), right_at=("bla", "blo"), right_id="b", keep=["b"], distance="km", max_km=500, places=places, left_rows=150
    )
    best = {g.a: g.km for g in got.collect()}
    assert len(best) == 600
    for i in range(0, 600, 37):
        assert best[i] == pytest.approx(min(haversine(*left[i], *p) for p in right), rel=1e-6, abs=1e-12)


def test_few_rows_cross_into_other_ranges(spark):
    """The second pass gets a small constant of rows, the places few copies."""
    n = 4000
    at = "degrees(asin(2 * rand({0}) - 1)) AS lat", "360 * rand({1}) - 180 AS lon"
    left, right = (
        spark.range(n).selectExpr("id", *(x.format(k, k + 9) for x in at)) for k in (1, 2)
    )
    targets = right.selectExpr("lat AS _rlat", "lon AS _rlon", "id AS _rid", "struct(id) AS _kept")
    cuts = nearest._cuts(targets, n, 250)
    assert 10 <= len(cuts) < 16
    places = nearest._with_range(targets, "_rlat", "_rlon", cuts)
    largest = max(r["count"] for r in places.groupBy("_range").count().collect())
    assert largest < 3 * 250
    seen = []
    original = nearest._visit_ranges

    def visit(origin, *rest):
        seen.append(origin.count())
        return original(origin, *rest)

    nearest._visit_ranges = visit
    try:
        nearest.nearest_join(
            left, right.selectExpr("id AS r", "lat AS a", "lon AS b"), key="id", left_at=("lat", "lon"),
            right_at=("a", "b"), right_id="r", keep=["r"], distance="km", max_km=20_000, places=250,
        ).count()
    finally:
        nearest._visit_ranges = original
    assert seen[0] == n and seen[1] < 2 * n


def test_spatial_plans_use_no_cross_join(spark, outlines):
    df = spark.createDataFrame([(0.5, 0.5)], "lon double, lat double")
    joined = spatial.points_in_polygons(
        df, outlines, x="lon", y="lat", keep=["code_commune"]
    )
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_stops_are_distinct_and_bounded(spark):
    df = spark.createDataFrame(
        [("48.000001", "2.0"), ("48.000002", "2.0"), ("80.0", "2.0"), (None, "2.0")],
        "stop_lat string, stop_lon string",
    )
    assert [tuple(r) for r in indicators.transport_stops(df).collect()] == [(48.0, 2.0)]


def test_outlines_drop_degenerate(spark):
    raw = spark.createDataFrame(
        [("1001", "A", [square(0.0, 0.0, 1.0, 1.0)]), ("1002", "B", None),
         ("1003", "C", [square(0.0, 0.0, 0.0, 0.0)])],
        "code string, nom string, geom array<array<array<array<double>>>>",
    )
    assert [r.code_commune for r in territories.commune_outlines(raw).collect()] == ["01001"]


def test_levels_merge_keeps_first_attributes(spark):
    def level(*codes, name):
        return spark.createDataFrame(
            [(c, f"{name}-{c}", [square(0.0, 0.0, 1.0, 1.0)]) for c in codes],
            "code string, nom string, geom array<array<array<array<double>>>>",
        )

    merged = territories.merge_levels(
        {"low": level("a", name="low"), "high": level("a", "b", name="high")}, "code", ["nom"]
    )
    rows = {r.code: (r.nom, r.geom_low is None, r.geom_high is None) for r in merged.collect()}
    assert rows == {"a": ("low-a", False, False), "b": ("high-b", True, False)}


# --- exports -----------------------------------------------------------------


@pytest.fixture(scope="module")
def published(spark):
    prices = spark.createDataFrame(
        [
            ("01001", "Alpha", "01", 10, 2000.0, 1800.0, 2200.0, 2010.0, True),
            ("01002", "Beta", "01", 3, 1500.0, 1400.0, 1600.0, 1510.0, False),
        ],
        "code_commune string, nom_commune string, code_departement string, nb_transactions long, "
        "prix_m2_median double, prix_m2_p25 double, prix_m2_p75 double, prix_m2_moyen double, "
        "fiable boolean",
    )
    typed = spark.createDataFrame(
        [("01001", "Maison", 6, 2100.0, True), ("01001", "Appartement", 4, 1900.0, False)],
        "code_commune string, type_local string, nb_transactions long, prix_m2_median double, "
        "fiable boolean",
    )
    dims = "".join(f", {d} double" for d in DIMENSIONS)
    full = (0.4, 0.2, 0.5, 0.9, 0.1, 0.8, 0.3, 0.2, 0.5, 0.6, 0.7, 0.5)
    scored = spark.createDataFrame(
        [
            ("01001", "Alpha", "01", 10, 2000.0, 0.6, 0.1, 0.05, "D", *full),
            ("99999", "Fantome", "99", 5, 1000.0, 0.3, 0.05, 0.02, "E", *full),
        ],
        "code_commune string, nom_commune string, code_departement string, nb_transactions long, "
        "prix_m2_median double, score_valeur double, gap double, gap_pondere double, "
        "dpe_dominant string" + dims,
    )
    return prices, typed, scored


def test_commune_map(outlines, published):
    prices, typed, scored = published
    frame = exports.choropleth_communes(outlines, prices, typed, scored)
    rows = {r.code_commune: r for r in frame.collect()}
    assert set(rows) == {"01001", "01002", "2A004"}
    alpha, iles = rows["01001"], rows["2A004"]
    assert (alpha.maison_prix_m2_median, alpha.appart_fiable, alpha.n_emploi) == (2100.0, False, 0.6)
    assert (iles.prix_m2_median, iles.nb_transactions, iles.fiable) == (None, 0, False)
    assert (iles.code_departement, iles.n_prix) == ("2A", None)
    flat = exports.score_flat(frame).collect()
    assert [(r.code_commune, r.prix, r.dep) for r in flat] == [("01001", 2000, "01")]


def test_documents(spark, outlines, published):
    prices, typed, scored = published
    older = spark.createDataFrame(
        [("01001", 38, 1900.0)], "code_commune string, nb_transactions long, prix_m2_median double"
    )
    years = exports.pooled_years(prices, 2024, {2021: older})
    fields = {
        "revenus": "24000.0 AS revenu_median",
        "emploi": "6.0 AS taux_chomage, 0.9 AS taux_couverture_emploi, 500 AS pop_active",
        "transport": "1.5 AS densite_arrets_km2, 12 AS nb_arrets",
        "equipements": "3 AS nb_services_sante, 2 AS nb_loisirs_culture",
        "securite": "30.0 AS taux_delinquance_global, 800 AS insee_pop",
        "tourisme": "0.05 AS part_residences_secondaires",
        "risques": "2 AS nb_arretes_catnat",
        "climat": "1900.0 AS ensoleillement_h_an, 12.0 AS temperature_moy_annuelle",
        "proximite": "30.0 AS dist_metropole_km, 'Lyon' AS nom_metropole",
    }
    tables = {n: spark.sql(f"SELECT '01001' AS code_commune, {c}") for n, c in fields.items()}
    docs = exports.territory_documents(
        outlines, prices, typed, scored, exports.price_evolution(years), tables,
        exports.no_reviews(prices),
    )
    rows = {r.code_commune: r for r in docs.collect()}
    alpha, iles, ghost = rows["01001"], rows["2A004"], rows["99999"]
    assert alpha.prix.maison.median == 2100.0
    assert alpha.score.composantes.n_emploi == 0.6
    assert alpha.indicateurs.nom_metropole == "Lyon"
    assert [e.annee for e in alpha.evolution] == [2021, 2024]
    assert (iles.prix, iles.score, iles.avis) == (None, None, None)
    assert iles.indicateurs.surface_km2 == 8.0
    assert ghost.score.score_valeur == 0.3 and ghost.indicateurs.surface_km2 is None


def test_search_and_ranking(outlines, published):
    prices, _, scored = published
    index = [tuple(r) for r in exports.search_index(outlines, prices, scored).collect()]
    assert len(index) == 4
    assert index[0] == ("01001", "Alpha", "01", 2000, 0.6)
    assert index[3][0] == "99999"
    top = exports.ranking(scored).orderBy("rang").collect()
    assert [(r.rang, r.code_commune) for r in top] == [(1, "01001"), (2, "99999")]


def test_region_medians_come_from_sales(spark, published):
    _, _, scored = published
    rows = [("01001", "01", "Maison", p) for p in (1000.0, 2000.0, 3000.0, 4000.0, 5000.0)]
    rows += [("01001", "01", "Appartement", p) for p in (1500.0, 2500.0, 3500.0, 4500.0)]
    rows += [("2A004", "2A", "Maison", p) for p in (6000.0, 8000.0)]
    sold = spark.createDataFrame(
        rows, "code_commune string, code_departement string, type_local string, prix_m2 double"
    )
    regions = spark.createDataFrame(
        [(c, n, [square(0.0, 0.0, 1.0, 1.0)]) for c, n in
         (("84", "ARA"), ("94", "Corse"), ("11", "IDF"), ("ZZ", "Ailleurs"))],
        "code_region string, nom_region string, geom array<array<array<array<double>>>>",
    )
    got = {r.code_region: r for r in exports.choropleth_regions(regions, sold, scored).collect()}
    assert set(got) == {"84", "94", "11"}
    assert (got["84"].prix_m2_median, got["84"].nb_transactions) == (3000.0, 9)
    assert (got["84"].appart_nb_transactions, got["84"].nb_communes_scorees) == (4, 1)
    assert (got["94"].prix_m2_median, got["94"].fiable) == (7000.0, False)
    assert (got["11"].prix_m2_median, got["11"].nb_transactions) == (None, 0)


def test_price_series(spark, published):
    prices, _, _ = published
    older = spark.createDataFrame(
        [("01001", 8, 1800.0), ("01002", 2, 1400.0)],
        "code_commune string, nb_transactions long, prix_m2_median double",
    )
    years = exports.pooled_years(prices, 2024, {2021: older})
    national = {r.annee: r.national for r in exports.national_series(years).collect()}
    assert national == {2021: 1800.0, 2024: 2000.0}
    series = {r.code_commune: r.valeurs for r in exports.price_series(years, [2021, 2024]).collect()}
    assert series == {"01001": [1800.0, 2000.0]}


def test_zone_map(spark, zones):
    scored = spark.createDataFrame(
        [("010020101", 7, 2149.6, 2021, 2024, 0.5, 0.62, 0.1234, 0.0987)],
        "code_iris string, nb_transactions long, prix_m2_median double, annee_min int, "
        "annee_max int, n_prix_iris double, score_commune double, gap_iris double, "
        "gap_pondere_iris double",
    )
    rows = {r.code_iris: r for r in exports.choropleth_zones(zones, scored).collect()}
    assert set(rows) == {"010020101", "010020102", "974110102"}
    west, east = rows["010020101"], rows["010020102"]
    assert (west.prix_m2_median, west.gap_iris, west.fiable) == (2150, 0.123, True)
    assert (east.fiable, east.nb_transactions, east.gap_iris) == (False, 0, None)
    assert rows["974110102"].code_departement == "974"


def test_sample_repeats(spark):
    df = spark.createDataFrame(
        [(str(i), 4.001234567, 46.2, 1000.0 + i, "Maison") for i in range(50)],
        "id_mutation string, longitude double, latitude double, prix_m2 double, type_local string",
    )
    first, second = (sorted(map(tuple, exports.points_sample(df, 5).collect())) for _ in "ab")
    assert first == second and len(first) == 5
    assert {r[0] for r in first} == {4.0012}


def test_weights_add_up_to_one():
    assert sum(scores.WEIGHTS.values()) == pytest.approx(1.0)
    assert set(itertools.chain(scores.WEIGHTS)) <= set(DIMENSIONS)


def test_score_bounds(spark):
    rng = np.random.default_rng(5)
    columns = [
        "prix_m2_median", "densite_arrets_km2", "revenu_median", "nb_arretes_catnat",
        "part_residences_secondaires", "taux_delinquance_global", "insee_pop",
        "nb_services_sante", "nb_loisirs_culture", "ensoleillement_h_an", "taux_chomage",
        "taux_couverture_emploi", "dist_metropole_km",
    ]
    rows = []
    for i in range(60):
        values = [float(v) if rng.random() > 0.2 else None for v in rng.uniform(1, 100, len(columns))]
        values[0] = float(rng.uniform(1000, 9000))
        rows.append((f"{i:05d}", f"C{i}", f"{i % 5:02d}", 9, "ABCDEFG"[i % 7], *values))
    schema = (
        "code_commune string, nom_commune string, code_departement string, nb_transactions long, "
        "dpe_dominant string, " + ", ".join(f"{c} double" for c in columns)
    )
    out = scores.territory_score(spark.createDataFrame(rows, schema))
    bad = out.where(
        F.expr("NOT (score_valeur BETWEEN 0 AND 1) OR NOT (gap BETWEEN -1 AND 1)")
    ).count()
    assert out.count() == 60 and bad == 0
