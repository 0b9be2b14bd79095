"""Communal indicators, cleaned from heterogeneous open-data files.

Every job takes the raw file (text columns under their published headers) and
the reference of known communes, and keeps only communes of the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcella.functions import geo
from parcella.functions.codes import territory_code
from parcella.functions.numbers import ratio, real, real_comma, rounded_int, whole
from parcella.operators.nearest import nearest_join
from parcella.operators.spatial import DEFAULT_CELL, count_points_in_polygons
from parcella.operators.stats import one_row

CODE = "code_commune"

# Plausibility bounds and thresholds of the indicators.
INCOME_RANGE = (5_000, 80_000)
CRIME_RATE_RANGE = (0, 2_000)
UNEMPLOYMENT_RANGE = (0, 50)
JOB_COVERAGE_RANGE = (0, 50)
SUNSHINE_RANGE = (500, 3_200)
HOURS_PER_SUNNY_DAY = 6.5
STATION_MAX_KM = 150
CITY_MIN_POPULATION = 50_000
CITY_MAX_KM = 500
ENERGY_LABELS = ("A", "B", "C", "D", "E", "F", "G")
SERVICE_DOMAINS = ("A", "B", "C", "D")
LEISURE_DOMAIN = "F"
FLOOD_WORDS = ("inondation", "coulée")
STOPS_LON_RANGE = (-62.0, 56.0)
STOPS_LAT_RANGE = (-22.0, 51.5)


def _known(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Inner join on the reference codes: unknown communes go, and a code the
    reference holds twice counts twice, as an inner join does."""
    return df.join(reference.select(CODE), CODE)


def incomes(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Median disposable income; masked or implausible communes are dropped."""
    shaped = raw.where(F.col("Code géographique").isNotNull()).select(
        territory_code("Code géographique").alias(CODE),
        F.col("Libellé géographique").alias("nom_commune"),
        real("[DISP] Médiane (€)").alias("revenu_median"),
        real("[DISP] 1ᵉʳ quartile (€)").alias("revenu_q1"),
    )
    return _known(shaped.where(F.col("revenu_median").between(*INCOME_RANGE)), reference)


def risks(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Natural-disaster orders per commune, floods apart."""
    text = F.lower("lib_risque_jo")
    flood = F.lit(False)
    for word in FLOOD_WORDS:
        flood = flood | text.contains(word)
    counts = (
        raw.where(F.col(CODE).isNotNull())
        .groupBy(territory_code(CODE).alias(CODE))
        .agg(
            F.count(F.lit(1)).alias("nb_arretes_catnat"),
            F.count_if(flood).alias("nb_arretes_inondation"),
        )
    )
    return _known(counts, reference)


def second_homes(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Housing stock and share of second homes, summed over sub-areas."""
    sums = (
        raw.where(F.col("COM").isNotNull())
        .groupBy(territory_code("COM").alias(CODE))
        .agg(
            F.sum(real("P21_LOG")).alias("nb_logements"),
            F.sum(real("P21_RSECOCC")).alias("_second"),
        )
    )
    shares = sums.select(
        CODE, "nb_logements", ratio("_second", "nb_logements").alias("part_residences_secondaires")
    )
    return _known(
        shares.where(
            (F.col("nb_logements") > 0) & F.col("part_residences_secondaires").between(0, 1)
        ),
        reference,
    )


def crime_rates(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Published offence rates of the latest year, summed per commune."""
    shaped = raw.where(F.col("CODGEO_2025").isNotNull()).select(
        territory_code("CODGEO_2025").alias(CODE),
        whole("annee").alias("annee"),
        "est_diffuse",
        real_comma("taux_pour_mille").alias("taux"),
        whole("insee_pop").alias("insee_pop"),
    )
    latest = one_row(shaped.agg(F.max("annee").alias("annee")))
    rates = (
        shaped.withColumn("_latest", latest["annee"])
        .where(
            (F.col("annee") == F.col("_latest"))
            & (F.col("est_diffuse") == "diff")
            & F.col("taux").isNotNull()
        )
        .groupBy(CODE)
        .agg(
            F.sum("taux").alias("taux_delinquance_global"),
            F.count(F.lit(1)).alias("nb_indicateurs_diffuses"),
            F.max("insee_pop").alias("insee_pop"),
        )
    )
    return _known(rates.where(F.col("taux_delinquance_global").between(*CRIME_RATE_RANGE)), reference)


def facilities(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Facility counts by family; a commune without any keeps its zeros."""
    amount = real("OBS_VALUE")
    sums = (
        raw.where((F.col("GEO_OBJECT") == "COM") & F.col("GEO").isNotNull())
        .groupBy(territory_code("GEO").alias(CODE))
        .agg(
            _sum_where(amount, F.col("FACILITY_DOM").isin(*SERVICE_DOMAINS)).alias(
                "nb_services_sante"
            ),
            _sum_where(amount, F.col("FACILITY_DOM") == LEISURE_DOMAIN).alias(
                "nb_loisirs_culture"
            ),
        )
    )
    return _known(
        sums.where((F.col("nb_services_sante") >= 0) & (F.col("nb_loisirs_culture") >= 0)),
        reference,
    )


def _sum_where(amount: Column, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0.0))


def employment(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Unemployment rate (two decimals) and job coverage (three decimals)."""
    active = real("P21_ACT1564")
    rates = raw.where(F.col("CODGEO").isNotNull() & (active > 0)).select(
        territory_code("CODGEO").alias(CODE),
        whole("P21_ACT1564").alias("pop_active"),
        F.round(ratio(real("P21_CHOM1564"), active) * 100, 2).alias("taux_chomage"),
        F.round(ratio(real("P21_EMPLT"), active), 3).alias("taux_couverture_emploi"),
    )
    return _known(
        rates.where(
            F.col("taux_chomage").between(*UNEMPLOYMENT_RANGE)
            & F.col("taux_couverture_emploi").between(*JOB_COVERAGE_RANGE)
        ),
        reference,
    )


def energy_labels(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Energy labels A to G, one row per diagnosis."""
    shaped = raw.where(F.col("code_insee_ban").isNotNull()).select(
        territory_code("code_insee_ban").alias(CODE),
        F.upper(F.trim("etiquette_dpe")).alias("etiquette_dpe"),
    )
    return _known(shaped.where(F.col("etiquette_dpe").isin(*ENERGY_LABELS)), reference)


def _with_centre(outlines: DataFrame) -> DataFrame:
    centre = geo.centroid("geom")
    return outlines.select(CODE, centre["lat"].alias("_lat"), centre["lon"].alias("_lon"))


def sunshine(stations: DataFrame, outlines: DataFrame) -> DataFrame:
    """Climate of the nearest station, at most 150 km from the commune's centroid."""
    hours = real("ensoleillement_h_an")
    usable = stations.select(
        "num_poste",
        real("lat").alias("lat"),
        real("lon").alias("lon"),
        hours.alias("ensoleillement_h_an"),
        rounded_int(hours / HOURS_PER_SUNNY_DAY).alias("jours_ensoleilles"),
        real("temperature_moy_annuelle").alias("temperature_moy_annuelle"),
    ).where(F.col("num_poste").isNotNull() & F.col("ensoleillement_h_an").isNotNull())
    nearest = nearest_join(
        _with_centre(outlines),
        usable,
        key=CODE,
        left_at=("_lat", "_lon"),
        right_at=("lat", "lon"),
        right_id="num_poste",
        keep=["ensoleillement_h_an", "jours_ensoleilles", "temperature_moy_annuelle"],
        distance="dist_station_km",
        max_km=STATION_MAX_KM,
    )
    return nearest.where(F.col("ensoleillement_h_an").between(*SUNSHINE_RANGE))


def city_proximity(cities: DataFrame, outlines: DataFrame) -> DataFrame:
    """Nearest city of at least 50,000 inhabitants, at most 500 km away."""
    large = cities.where(whole("population", "bigint") >= CITY_MIN_POPULATION).select(
        F.trim("code_insee").alias("code_metropole"),
        F.trim("nom_standard").alias("nom_metropole"),
        real("latitude_centre").alias("lat"),
        real("longitude_centre").alias("lon"),
    )
    return nearest_join(
        _with_centre(outlines),
        large,
        key=CODE,
        left_at=("_lat", "_lon"),
        right_at=("lat", "lon"),
        right_id="code_metropole",
        keep=["nom_metropole"],
        distance="dist_metropole_km",
        max_km=CITY_MAX_KM,
    )


def transport_stops(raw: DataFrame) -> DataFrame:
    """Distinct stop positions (five decimals) inside the French bounding box."""
    return (
        raw.select(
            F.round(real("stop_lat"), 5).alias("lat"), F.round(real("stop_lon"), 5).alias("lon")
        )
        .where(
            F.col("lon").between(*STOPS_LON_RANGE) & F.col("lat").between(*STOPS_LAT_RANGE)
        )
        .dropDuplicates(["lat", "lon"])
    )


def stop_density(
    stops: DataFrame, outlines: DataFrame, *, cell: float = DEFAULT_CELL
) -> DataFrame:
    """Stops strictly inside each commune and their density per km2."""
    counted = count_points_in_polygons(
        stops, outlines, x="lon", y="lat", code=CODE, name="nb_arrets", cell=cell
    )
    return counted.select(
        CODE,
        "surface_km2",
        "nb_arrets",
        ratio("nb_arrets", "surface_km2").alias("densite_arrets_km2"),
    )

