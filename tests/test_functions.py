from __future__ import annotations

import datetime
import json
import math

import pytest
from pyspark.sql import functions as F
from shapes import square

from parcella.functions import codes, geo, numbers, text
from parcella.functions.regions import region_rows

GEOM = "geom array<array<array<array<double>>>>"


def values(df):
    return [tuple(r) for r in df.collect()]


def test_department_codes_are_padded_never_cut(spark):
    df = spark.createDataFrame([("1",), ("01",), ("2A",), ("971",), (" 974 ",)], "c string")
    got = [r[0] for r in df.select(codes.department_code("c")).collect()]
    assert got == ["01", "01", "2A", "971", "974"]


def test_department_of_commune(spark):
    df = spark.createDataFrame([("01001",), ("2A004",), ("2B033",), ("97411",)], "c string")
    assert [r[0] for r in df.select(codes.department_of("c")).collect()] == [
        "01",
        "2A",
        "2B",
        "974",
    ]


def test_territory_codes(spark):
    df = spark.createDataFrame([("1001",), ("123456",)], "c string")
    got = values(df.select(codes.territory_code("c"), codes.zero_filled("c")))
    assert got == [("01001", "01001"), ("12345", "123456")]


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("12,5",), ("x",), ("12.7",), ("-2.5",), (None,)], "c string")
    got = values(df.select(numbers.real_comma("c"), numbers.whole("c")))
    assert got == [(12.5, None), (None, None), (12.7, 13), (-2.5, -3), (None, None)]


def test_region_table_is_complete():
    rows = region_rows()
    assert len(rows) == 101
    assert len({r[1] for r in rows}) == 18


@pytest.mark.parametrize(
    ("x", "y", "inside", "touching"),
    [
        (0.5, 0.5, True, True),
        (1.5, 0.5, False, False),
        (1.0, 0.5, False, True),
        (0.0, 0.0, False, True),
        (2.5, 2.5, False, False),  # in the hole
        (2.0, 2.5, False, True),  # on the hole's edge
        (3.5, 2.5, True, True),
    ],
)
def test_point_in_polygon(spark, x, y, inside, touching):
    holed = [*square(1.5, 1.5, 4.0, 4.0), *square(2.0, 2.0, 3.0, 3.0)]
    df = spark.createDataFrame([([square(0.0, 0.0, 1.0, 1.0), holed], x, y)], GEOM + ", x double, y double")
    got = df.select(geo.contains("geom", "x", "y"), geo.intersects("geom", "x", "y")).first()
    assert tuple(got) == (inside, touching)


def test_centroid_and_area(spark):
    holed = [*square(0.0, 0.0, 4.0, 4.0), *square(0.0, 0.0, 2.0, 2.0)]
    df = spark.createDataFrame([([holed],), ([square(0.0, 0.0, 1.0, 1.0)],)], GEOM)
    rows = df.select(
        geo.centroid("geom").alias("c"), geo.area_km2("geom", ellipsoid=False).alias("a")
    ).collect()
    # 4x4 square minus its lower-left quarter.
    assert rows[0].c.lon == pytest.approx((16 * 2 - 4 * 1) / 12)
    assert rows[0].c.lat == pytest.approx((16 * 2 - 4 * 1) / 12)
    # A degree cell at the equator is about 12,364 km2 on the sphere of equal area.
    assert rows[1].a == pytest.approx(12_364, rel=1e-3)


def test_area_on_the_ellipsoid_matches_its_integral(spark):
    """Quadrangles against the integral of the ellipsoid's surface element (WGS 84)."""
    a, e2 = 6378.137, geo.ECCENTRICITY**2
    boxes = [(0, 0, 1, 1), (2, 45, 3, 46), (-5, 48.25, -4.5, 48.5), (10, -80, 12, -79), (0, -30, 5, 60), (0, 89, 90, 90)]
    df = spark.createDataFrame([([square(*map(float, b))],) for b in boxes], GEOM)
    for (x0, y0, x1, y1), row in zip(boxes, df.select(geo.area_km2("geom").alias("a")).collect()):
        n = 20_000
        step = math.radians(y1 - y0) / n
        total = 0.0
        for k in range(n):
            s = math.sin(math.radians(y0) + (k + 0.5) * step)
            total += math.sqrt(1 - s * s) / (1 - e2 * s * s) ** 2
        whole = a * a * (1 - e2) * math.radians(x1 - x0) * total * step
        assert row.a == pytest.approx(whole, rel=1e-7)


def test_distance_is_stable_for_same_point(spark):
    row = spark.range(1).select(
        geo.arc_km(F.lit(48.85), F.lit(2.35), F.lit(48.85), F.lit(2.35)).alias("zero"),
        geo.arc_km(F.lit(48.8566), F.lit(2.3522), F.lit(45.764), F.lit(4.8357)).alias("lyon"),
    ).first()
    assert row.zero == 0.0
    assert row.lyon == pytest.approx(391.5, abs=0.5)


def test_snapping_drops_collapsed_islands(spark):
    island = [[[2.001, 2.001], [2.003, 2.001], [2.002, 2.003], [2.001, 2.001]]]
    df = spark.createDataFrame([([square(0.0, 0.0, 1.0, 1.0), island],), ([island],)], GEOM)
    got = [r[0] for r in df.select(geo.to_geojson(geo.snapped("geom", 2))).collect()]
    assert json.loads(got[0])["type"] == "Polygon"
    assert [0.0, 0.0] in json.loads(got[0])["coordinates"][0]
    assert got[1] is None


def test_nested_collection_keeps_polygons(spark):
    ring1 = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    ring2 = [[3, 3], [4, 3], [4, 4], [3, 4], [3, 3]]
    nested = {
        "type": "GeometryCollection",
        "geometries": [
            {
                "type": "GeometryCollection",
                "geometries": [
                    {"type": "MultiPolygon", "coordinates": [[ring1], [ring2]]},
                    {"type": "LineString", "coordinates": [[5, 5], [5, 6]]},
                ],
            },
            {"type": "MultiLineString", "coordinates": [[[6, 6], [6, 7]]]},
        ],
    }
    point = {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [2, 2]}]}
    df = spark.createDataFrame([(json.dumps(nested),), (json.dumps(point),), (None,)], "g string")
    got = [r[0] for r in df.select(geo.to_geojson(geo.from_geojson(F.col("g")))).collect()]
    assert json.loads(got[0]) == {"type": "MultiPolygon", "coordinates": [[ring1], [ring2]]}
    assert got[1:] == [None, None]


def test_dates(spark):
    df = spark.createDataFrame([("15-03-2024",), ("",), ("31-02-2024",), (None,)], "d string")
    got = [r[0] for r in df.select(text.day_month_year("d")).collect()]
    assert got == [datetime.date(2024, 3, 15), None, None, None]


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        (
            "→ Deux lignes de tram au pied.\n→ Le port se visite à vélo.",
            ["Deux lignes de tram au pied.", "Le port se visite à vélo."],
        ),
        (
            "Peu de voitures le dimanche. On nage dans la baie en juillet !",
            ["Peu de voitures le dimanche.", "On nage dans la baie en juillet !"],
        ),
        ("Non", []),
        (None, []),
        ("Bof. Une plage à dix minutes.", ["Une plage à dix minutes."]),
        ("Une    plage\t\tà   dix minutes", ["Une plage à dix minutes"]),
    ],
)
def test_segments(spark, source, expected):
    df = spark.createDataFrame([(source,)], "t string")
    assert df.select(text.segments("t")).first()[0] == expected


def test_themes_in_canonical_order(spark):
    df = spark.createDataFrame(
        [
            ("Supermarché à côté, rue tranquille, gare en face.",),
            ("Ni déchets ni pollution au bord du canal.",),
            ("Le train passe deux fois par heure.",),
            ("Un volcan et un barrage au loin.",),
        ],
        "t string",
    )
    got = [r[0] for r in df.select(text.themes("t")).collect()]
    assert got == [["calme", "transports", "commerces"], ["environnement"], ["transports"], []]


def test_tokens_once_per_text(spark):
    df = spark.createDataFrame([("Prix élevés, prix élevés dans la ville",)], "t string")
    flagged = df.select(text.flagged_words("t").alias("w"))
    got = [tuple(t) for t in flagged.select(text.tokens("w")).first()[0]]
    assert got == [
        ("prix", "nom"),
        ("élevés", "nom"),
        ("prix élevés", "bigramme"),
        ("élevés prix", "bigramme"),
    ]


def test_stars_and_blend(spark):
    row = spark.range(1).select(
        text.stars_to_score(F.array(*[F.lit(float(v)) for v in (0, 0, 1, 0, 0)])),
        text.stars_to_score(F.array(*[F.lit(float(v)) for v in (0, 0, 0, 0, 1)])),
        text.stars_to_score(F.array(*[F.lit(float(v)) for v in (1, 0, 0, 0, 0)])),
        text.blended(F.lit(1.0), F.lit(None).cast("double")),
        text.blended(F.lit(-1.0), F.lit(None).cast("double")),
        text.blended(F.lit(1.0), F.lit(0.3)),
        text.blended(F.lit(1.0), F.lit(-0.8)),
    ).first()
    assert list(row)[:3] == [0.0, 1.0, -1.0]
    assert row[3] == pytest.approx(0.6)
    assert row[4] == pytest.approx(-0.6)
    assert row[5] == pytest.approx(0.35 + 0.65 * 0.3)
    assert row[6] == pytest.approx(0.35 - 0.65 * 0.8)


def test_stars_need_five_classes(spark):
    with pytest.raises(Exception, match="five star"):
        spark.range(1).select(text.stars_to_score(F.array(F.lit(0.5), F.lit(0.5)))).collect()


def test_title_case_after_apostrophe(spark):
    df = spark.createDataFrame([("saint-denis d'oc",)], "t string")
    assert df.select(text.title_case("t")).first()[0] == "Saint-Denis D'Oc"
