"""Published tables: maps, documents, indexes, rankings, charts.

All frames here have territory grain; their joins share one key and are left to
Spark, which broadcasts what it measures as small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcella.functions import geo
from parcella.functions.codes import department_of
from parcella.functions.numbers import rounded_int
from parcella.functions.regions import region_mapping
from parcella.operators.quantiles import weighted_median
from parcella.operators.sales import RELIABLE_FROM, price_with_all_types
from parcella.operators.scores import DIMENSIONS
from parcella.operators.stats import histogram, seeded_sample, top_ranked

CODE = "code_commune"
DEPT = "code_departement"

# How dwelling types appear in flat column names and compact codes.
TYPE_PREFIXES = {"Maison": "maison", "Appartement": "appart"}
MEASURES = ("prix_m2_median", "nb_transactions", "fiable")
COORDINATE_DIGITS = {"low": 2, "mid": 3, "high": 4}


def _by_type(prices: DataFrame, key: str) -> DataFrame:
    """Both dwelling types of a price table as flat columns, in one aggregation."""
    return prices.groupBy(key).agg(
        *[
            F.max(F.when(F.col("type_local") == kind, F.col(m))).alias(f"{prefix}_{m}")
            for kind, prefix in TYPE_PREFIXES.items()
            for m in MEASURES
        ]
    )


def _defaults(prefix: str = "") -> list[Column]:
    """Price columns of a map row: a missing side counts zero and is unreliable."""
    return [
        F.col(f"{prefix}prix_m2_median"),
        F.coalesce(f"{prefix}nb_transactions", F.lit(0).cast("long")).alias(
            f"{prefix}nb_transactions"
        ),
        F.coalesce(f"{prefix}fiable", F.lit(False)).alias(f"{prefix}fiable"),
    ]


def _all_price_columns() -> list[Column]:
    return [*_defaults(), *[c for p in TYPE_PREFIXES.values() for c in _defaults(f"{p}_")]]


def choropleth_communes(
    outlines: DataFrame, prices: DataFrame, prices_by_type: DataFrame, scores: DataFrame
) -> DataFrame:
    """Commune map: outline, prices by type, score and its rounded dimensions."""
    scored = scores.select(
        CODE,
        "score_valeur",
        "gap_pondere",
        F.round("gap", 3).alias("gap"),
        "dpe_dominant",
        *[F.round(d, 3).alias(d) for d in DIMENSIONS],
    )
    return (
        outlines.select(CODE, F.col("nom_commune").alias("nom"), "geom")
        .join(prices.select(CODE, *MEASURES), CODE, "left")
        .join(_by_type(prices_by_type, CODE), CODE, "left")
        .join(scored, CODE, "left")
        .select(
            CODE,
            "nom",
            department_of(CODE).alias(DEPT),
            *_all_price_columns(),
            "score_valeur",
            "gap_pondere",
            "gap",
            "dpe_dominant",
            *DIMENSIONS,
            "geom",
        )
    )


def _score_medians(scores: DataFrame, key: str) -> DataFrame:
    """Medians of the scored communes of each larger territory."""
    return scores.groupBy(key).agg(
        F.count(F.lit(1)).alias("nb_communes_scorees"),
        F.round(F.median("score_valeur"), 3).alias("score_median"),
        F.round(F.median("gap_pondere"), 3).alias("gap_pondere_median"),
        *[F.round(F.median(d), 3).alias(d) for d in DIMENSIONS],
    )


_SCORE_COLUMNS = ("score_median", "gap_pondere_median")


def _territory_map(
    outlines: DataFrame, key: str, prices: DataFrame, medians: DataFrame, extra: Sequence[str]
) -> DataFrame:
    all_types = prices.where("tous_types").select(key, *MEASURES)
    typed = _by_type(prices.where("NOT tous_types"), key)
    return (
        outlines.join(all_types, key, "left")
        .join(typed, key, "left")
        .join(medians, key, "left")
        .select(
            key,
            "nom",
            *extra,
            *_all_price_columns(),
            *_SCORE_COLUMNS,
            F.coalesce("nb_communes_scorees", F.lit(0).cast("long")).alias("nb_communes_scorees"),
            *DIMENSIONS,
            "geom",
        )
    )


def choropleth_departments(
    outlines: DataFrame, prices: DataFrame, scores: DataFrame
) -> DataFrame:
    """Department map with its region, price medians and medians of the scores."""
    shapes = outlines.select(DEPT, F.col("nom_departement").alias("nom"), "geom").join(
        region_mapping(outlines.sparkSession), DEPT, "left"
    )
    medians = _score_medians(scores, DEPT)
    return _territory_map(shapes, DEPT, prices, medians, ["code_region", "nom_region"])


def choropleth_regions(
    outlines: DataFrame, sales: DataFrame, scores: DataFrame, *, method: str = "bracketed"
) -> DataFrame:
    """Region map; medians come from the sales themselves, never from other medians."""
    mapping = region_mapping(outlines.sparkSession).select(DEPT, "code_region")
    prices = price_with_all_types(sales.join(mapping, DEPT), "code_region", method=method)
    medians = _score_medians(scores.join(mapping, DEPT), "code_region")
    shapes = outlines.select("code_region", F.col("nom_region").alias("nom"), "geom").join(
        mapping, "code_region", "left_semi"
    )
    return _territory_map(shapes, "code_region", prices, medians, [])


def choropleth_zones(zones: DataFrame, scores: DataFrame) -> DataFrame:
    """Neighbourhood map of communes with several zones; unscored zones stay."""
    scored = scores.select(
        "code_iris",
        F.lit(True).alias("_scored"),
        rounded_int("prix_m2_median").alias("prix_m2_median"),
        "nb_transactions",
        *[
            F.round(c, 3).alias(c)
            for c in ("n_prix_iris", "score_commune", "gap_iris", "gap_pondere_iris")
        ],
        "annee_min",
        "annee_max",
    )
    return (
        zones.where(F.col("nb_iris_commune") > 1)
        .join(scored, "code_iris", "left")
        .select(
            "code_iris",
            CODE,
            F.col("nom_iris").alias("nom"),
            "nom_commune",
            "type_iris",
            department_of(CODE).alias(DEPT),
            "prix_m2_median",
            F.coalesce("nb_transactions", F.lit(0).cast("long")).alias("nb_transactions"),
            F.col("_scored").isNotNull().alias("fiable"),
            "n_prix_iris",
            "score_commune",
            "gap_iris",
            "gap_pondere_iris",
            "annee_min",
            "annee_max",
            "geom",
        )
    )


def choropleth_flat(outlines: DataFrame, aggregates: DataFrame, key: str) -> DataFrame:
    """Outlines at several levels of detail joined to price aggregates by type."""
    columns = ("prix_m2_median", "prix_m2_p25", "prix_m2_p75", "nb_transactions", "fiable")
    return outlines.join(aggregates.select(key, "type_local", *columns), key).select(
        *[c for c in outlines.columns if not c.startswith("geom_")],
        "type_local",
        *columns,
        *[c for c in outlines.columns if c.startswith("geom_")],
    )


# --- time series and charts --------------------------------------------------


def pooled_years(current: DataFrame, year: int, others: Mapping[int, DataFrame]) -> DataFrame:
    """Yearly commune prices under one another; a year that is absent is just absent."""
    frames = {**others, year: current}
    parts = [
        frame.select(
            CODE, F.lit(y).alias("annee"), "prix_m2_median", "nb_transactions"
        )
        for y, frame in sorted(frames.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def price_evolution(years: DataFrame) -> DataFrame:
    """Year-ordered list of prices per commune (one entry per year)."""
    entry = F.struct("annee", "prix_m2_median", "nb_transactions")
    return years.groupBy(CODE).agg(F.sort_array(F.collect_list(entry)).alias("evolution"))


def price_series(
    years: DataFrame, all_years: Sequence[int], minimum: int = RELIABLE_FROM
) -> DataFrame:
    """Rounded yearly medians per commune in ``all_years`` order, NULL under ``minimum``
    sales. Communes that never reach it are left out."""
    enough = years.where(F.col("nb_transactions") >= minimum)
    cells = [
        F.max(F.when(F.col("annee") == y, F.round("prix_m2_median"))) for y in sorted(all_years)
    ]
    return enough.groupBy(CODE).agg(F.array(*cells).alias("valeurs"))


def national_series(years: DataFrame, *, key: str = "annee") -> DataFrame:
    """Yearly national price: the median of commune medians weighted by sales."""
    found = weighted_median(years, [key], "prix_m2_median", "nb_transactions")
    return found.select(key, F.round("weighted_median").alias("national"))


def price_histogram(sales: DataFrame, bins: int = 60, *, method: str = "ranked") -> DataFrame:
    """Price distribution: all sales, houses, flats."""
    kind = F.col("type_local")
    series = {
        "tous": F.lit(True),
        "maison": kind == "Maison",
        "appartement": kind == "Appartement",
    }
    return histogram(sales, "prix_m2", series, bins, method=method)


# --- documents and indexes ---------------------------------------------------


def known_communes(outlines: DataFrame, scores: DataFrame) -> DataFrame:
    """Communes with an outline, plus scored ones that have none."""
    shaped = outlines.select(CODE, "nom_commune")
    extra = scores.join(outlines.select(CODE), CODE, "left_anti").select(CODE, "nom_commune")
    return shaped.unionByName(extra).distinct()


# Indicator fields of a commune document: field -> (table, column type).
DOCUMENT_FIELDS = {
    "revenu_median": "revenus",
    "taux_chomage": "emploi",
    "taux_couverture_emploi": "emploi",
    "pop_active": "emploi",
    "densite_arrets_km2": "transport",
    "nb_arrets": "transport",
    "nb_services_sante": "equipements",
    "nb_loisirs_culture": "equipements",
    "taux_delinquance_global": "securite",
    "insee_pop": "securite",
    "part_residences_secondaires": "tourisme",
    "nb_arretes_catnat": "risques",
    "ensoleillement_h_an": "climat",
    "temperature_moy_annuelle": "climat",
    "dist_metropole_km": "proximite",
    "nom_metropole": "proximite",
}


def _attach(df: DataFrame, side: DataFrame, name: str, value: Column) -> DataFrame:
    """Left join a struct built on the right side: absent rows give a NULL struct."""
    return df.join(side.select(CODE, value.alias(name)), CODE, "left")


def territory_documents(
    outlines: DataFrame,
    prices: DataFrame,
    prices_by_type: DataFrame,
    scores: DataFrame,
    evolution: DataFrame,
    indicators: Mapping[str, DataFrame],
    reviews: DataFrame,
) -> DataFrame:
    """One nested document per commune; a side that is absent is a NULL struct."""
    doc = known_communes(outlines, scores)
    doc = doc.join(outlines.select(CODE, "surface_km2"), CODE, "left")

    sides = {
        kind: F.max(
            F.when(
                F.col("type_local") == kind,
                F.struct(F.col("prix_m2_median").alias("median"), "nb_transactions"),
            )
        )
        for kind in TYPE_PREFIXES
    }
    typed = prices_by_type.groupBy(CODE).agg(
        sides["Maison"].alias("maison"), sides["Appartement"].alias("appartement")
    )
    price = F.struct(
        F.col("prix_m2_median").alias("median"),
        F.col("prix_m2_p25").alias("p25"),
        F.col("prix_m2_p75").alias("p75"),
        F.col("prix_m2_moyen").alias("moyen"),
        "nb_transactions",
        "fiable",
        "maison",
        "appartement",
    )
    doc = _attach(doc, prices.join(typed, CODE, "left"), "prix", price)
    doc = doc.join(evolution, CODE, "left")
    score = F.struct(
        "score_valeur",
        "gap",
        "gap_pondere",
        "dpe_dominant",
        F.struct(*DIMENSIONS).alias("composantes"),
    )
    doc = _attach(doc, scores, "score", score)

    by_table: dict[str, list[str]] = {}
    for field, table in DOCUMENT_FIELDS.items():
        by_table.setdefault(table, []).append(field)
    for table, fields in by_table.items():
        doc = doc.join(indicators[table].select(CODE, *fields), CODE, "left")
    review = F.struct(
        "n_avis",
        F.round("sentiment_global", 2).alias("sentiment_global"),
        F.struct(F.col("date_min").alias("debut"), F.col("date_max").alias("fin")).alias("periode"),
        "low_data",
        F.col("wordcloud_preview").alias("mini_cloud"),
    )
    doc = _attach(doc, reviews, "avis", review)
    return doc.select(
        CODE,
        "nom_commune",
        department_of(CODE).alias(DEPT),
        "prix",
        "evolution",
        "score",
        F.struct(*DOCUMENT_FIELDS, "surface_km2").alias("indicateurs"),
        "avis",
    )


REVIEW_ROLLUP_SCHEMA = (
    "code_commune string, nom_ville string, n_avis bigint, date_min date, date_max date, "
    "sentiment_global double, low_data boolean, "
    "themes array<struct<theme:string,n_segments:bigint,pct_positive:double,"
    "pct_negative:double,score:double>>, "
    "wordcloud array<struct<word:string,weight:bigint,sentiment:string,themes:array<string>>>, "
    "wordcloud_preview array<struct<word:string,weight:bigint,sentiment:string>>, "
    "verbatims array<struct<text:string,label:string,theme:string,mois:string,source:string>>"
)


def no_reviews(like: DataFrame) -> DataFrame:
    """Typed empty roll-up, for runs without review analysis."""
    return like.sparkSession.createDataFrame([], REVIEW_ROLLUP_SCHEMA)


def review_export(rollup: DataFrame, source: str) -> DataFrame:
    """Review analysis per commune; themes are hidden where data is too thin."""
    return rollup.select(
        CODE,
        department_of(CODE).alias(DEPT),
        "nom_ville",
        "n_avis",
        F.struct(F.col("date_min").alias("debut"), F.col("date_max").alias("fin")).alias("periode"),
        F.round("sentiment_global", 2).alias("sentiment_global"),
        "low_data",
        F.when(~F.col("low_data"), F.col("themes")).alias("themes"),
        "wordcloud",
        "verbatims",
        F.lit(source).alias("source"),
    )


def review_index(export: DataFrame, outlines: DataFrame) -> DataFrame:
    """Communes covered by reviews, with the centre of their outline."""
    centre = geo.centroid("geom")
    placed = outlines.select(
        CODE,
        F.round(centre["lon"], 4).alias("lng"),
        F.round(centre["lat"], 4).alias("lat"),
    )
    return (
        export.join(placed, CODE)
        .select(F.col(CODE).alias("c"), F.col("nom_ville").alias("n"), "n_avis", "lng", "lat")
        .orderBy("c")
    )


def search_index(outlines: DataFrame, prices: DataFrame, scores: DataFrame) -> DataFrame:
    """Compact search index over the same communes as the documents."""
    return (
        known_communes(outlines, scores)
        .join(prices.select(CODE, "prix_m2_median"), CODE, "left")
        .join(scores.select(CODE, "score_valeur"), CODE, "left")
        .select(
            F.col(CODE).alias("c"),
            F.col("nom_commune").alias("n"),
            department_of(CODE).alias("d"),
            rounded_int("prix_m2_median").alias("p"),
            F.round("score_valeur", 2).alias("s"),
        )
        .orderBy("c")
    )


def ranking(scores: DataFrame, n: int = 100) -> DataFrame:
    """Most undervalued communes by weighted gap, ties by code."""
    return top_ranked(scores, "gap_pondere", [CODE], n).select(
        "rang",
        CODE,
        "nom_commune",
        DEPT,
        "prix_m2_median",
        F.round("score_valeur", 4).alias("score_valeur"),
        F.round("gap_pondere", 4).alias("gap_pondere"),
    )


def points_sample(sales: DataFrame, n: int = 100_000, key: str = "id_mutation") -> DataFrame:
    """Repeatable sample of located sales in compact form."""
    return seeded_sample(sales, key, n).select(
        F.round("longitude", 4).alias("lon"),
        F.round("latitude", 4).alias("lat"),
        rounded_int("prix_m2").alias("prix"),
        F.when(F.col("type_local") == "Maison", "M").otherwise("A").alias("t"),
    )


# Rounded statistics of a scored commune: column -> (table, decimals or None).
STATS_FIELDS = {
    "taux_chomage": ("emploi", 2),
    "taux_couverture_emploi": ("emploi", 2),
    "revenu_median": ("revenus", 0),
    "ensoleillement_h_an": ("climat", 0),
    "jours_ensoleilles": ("climat", None),
    "temperature_moy_annuelle": ("climat", 1),
    "part_residences_secondaires": ("tourisme", 4),
    "dist_metropole_km": ("proximite", 1),
    "nb_arrets": ("transport", None),
    "densite_arrets_km2": ("transport", 2),
}


def territory_stats(scores: DataFrame, indicators: Mapping[str, DataFrame]) -> DataFrame:
    """Raw indicator values of every scored commune."""
    out = scores.select(
        CODE,
        F.col("nom_commune").alias("nom"),
        F.col(DEPT).alias("dep"),
        F.round("prix_m2_median").alias("prix_m2_median"),
        "nb_transactions",
    )
    head = out.columns
    by_table: dict[str, list[Column]] = {}
    for field, (table, digits) in STATS_FIELDS.items():
        value = F.col(field) if digits is None else F.round(field, digits).alias(field)
        by_table.setdefault(table, []).append(value)
    for table, fields in by_table.items():
        out = out.join(indicators[table].select(CODE, *fields), CODE, "left")
    return out.select(*head, *STATS_FIELDS).orderBy(CODE)


def score_flat(communes_map: DataFrame) -> DataFrame:
    """Scored communes of the map under the older flat names."""
    return communes_map.where(F.col("score_valeur").isNotNull()).select(
        CODE,
        "nom",
        F.col(DEPT).alias("dep"),
        rounded_int("prix_m2_median").alias("prix"),
        "nb_transactions",
        F.col("dpe_dominant").alias("dpe"),
        F.round("score_valeur", 3).alias("score_valeur"),
        "gap",
        F.round("gap_pondere", 3).alias("gap_pondere"),
        *DIMENSIONS,
        "geom",
    )
