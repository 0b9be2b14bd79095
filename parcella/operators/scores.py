"""Composite quality score and its gap to price, per commune and neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcella.functions.numbers import ratio
from parcella.operators.stats import (
    dominant,
    impute_by_group_median,
    impute_by_median,
    normalise,
    weighted_mean_of_available,
)

CODE = "code_commune"

# Weights of the quality score; they add up to 1.
WEIGHTS = {
    "n_emploi": 0.30,
    "n_proximite": 0.18,
    "n_transport": 0.15,
    "n_securite": 0.12,
    "n_services": 0.12,
    "n_loisirs": 0.07,
    "n_ensoleillement": 0.04,
    "n_risques": 0.01,
    "n_tourisme": 0.01,
}

# Rank of an energy label, and the rank of an unknown one.
LABEL_RANKS = {"A": 6, "B": 5, "C": 4, "D": 3, "E": 2, "F": 1, "G": 0}
UNKNOWN_LABEL_RANK = 3

# The published score dimensions, in publication order.
DIMENSIONS = (
    "n_prix",
    "n_transport",
    "n_access_fin",
    "n_risques",
    "n_tourisme",
    "n_securite",
    "n_services",
    "n_loisirs",
    "n_ensoleillement",
    "n_emploi",
    "n_proximite",
    "n_dpe",
)

# Which columns each indicator table brings to the score.
INDICATOR_COLUMNS = {
    "transport": ("densite_arrets_km2",),
    "revenus": ("revenu_median",),
    "risques": ("nb_arretes_catnat",),
    "tourisme": ("part_residences_secondaires",),
    "securite": ("taux_delinquance_global", "insee_pop"),
    "equipements": ("nb_services_sante", "nb_loisirs_culture"),
    "climat": ("ensoleillement_h_an",),
    "emploi": ("taux_chomage", "taux_couverture_emploi"),
    "proximite": ("dist_metropole_km",),
}


def score_base(
    prices: DataFrame, labels: DataFrame, indicators: dict[str, DataFrame]
) -> DataFrame:
    """Reliable communes with every indicator attached by left joins.

    All joins share one key and territory-sized sides, so Spark broadcasts the
    ones it measures as small and otherwise keeps one partitioning throughout.
    """
    base = prices.where("fiable").select(
        CODE, "nom_commune", "code_departement", "nb_transactions", "prix_m2_median"
    )
    base = base.join(dominant(labels, CODE, "etiquette_dpe", "dpe_dominant"), CODE, "left")
    for name, columns in INDICATOR_COLUMNS.items():
        base = base.join(indicators[name].select(CODE, *columns), CODE, "left")
    return base.withColumn("insee_pop", F.col("insee_pop").cast("double"))


def score_inputs(base: DataFrame) -> DataFrame:
    """Imputed and log-scaled inputs of the normalisation."""

    def per_thousand(count: str):
        return F.coalesce(ratio(count, "insee_pop_imp") * 1000, F.lit(0.0))

    def log_of(c: str):
        return F.log1p(F.coalesce(F.col(c).cast("double"), F.lit(0.0)))

    populated = impute_by_group_median(base, "code_departement", "insee_pop", "insee_pop_imp")
    priced = populated.withColumn(
        "inaccessibilite_brute", ratio("prix_m2_median", "revenu_median")
    )
    filled = impute_by_median(
        priced,
        {
            "inaccessibilite": "inaccessibilite_brute",
            "ensoleillement_impute": "ensoleillement_h_an",
            "_chomage": "taux_chomage",
            "_couverture": "taux_couverture_emploi",
            "dist_metropole_imputee": "dist_metropole_km",
        },
    )
    rank = F.create_map(*[F.lit(v) for pair in LABEL_RANKS.items() for v in pair])
    return filled.withColumns(
        {
            "log_transport": log_of("densite_arrets_km2"),
            "log_risques": log_of("nb_arretes_catnat"),
            "tourisme_brut": F.coalesce("part_residences_secondaires", F.lit(0.0)),
            "log_securite": log_of("taux_delinquance_global"),
            "log_services": F.log1p(per_thousand("nb_services_sante")),
            "log_loisirs": F.log1p(per_thousand("nb_loisirs_culture")),
            "log_chomage": F.log1p("_chomage"),
            "log_couverture": F.log1p("_couverture"),
            "dpe_rang": F.coalesce(
                F.try_element_at(rank, F.col("dpe_dominant")), F.lit(UNKNOWN_LABEL_RANK)
            ).cast("double"),
        }
    ).drop("_chomage", "_couverture")


def normalised_dimensions(inputs: DataFrame) -> DataFrame:
    """The twelve dimensions on 0..1, higher is better except for the price."""
    scaled = normalise(
        inputs,
        {
            "n_prix": ("prix_m2_median", False),
            "n_access_fin": ("inaccessibilite", True),
            "n_risques": ("log_risques", True),
            "n_tourisme": ("tourisme_brut", False),
            "n_securite": ("log_securite", True),
            "n_services": ("log_services", False),
            "n_loisirs": ("log_loisirs", False),
            "n_ensoleillement": ("ensoleillement_impute", False),
            "_plein_emploi": ("log_chomage", True),
            "_couverture": ("log_couverture", False),
            "n_proximite": ("dist_metropole_imputee", True),
        },
        {"n_transport": "log_transport", "n_dpe": "dpe_rang"},
    )
    return scaled.withColumn("n_emploi", (F.col("_plein_emploi") + F.col("_couverture")) / 2)


def with_gaps(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Add the composite score, its gap to price and the affordability-weighted gap."""
    scored = df.withColumn("score_valeur", weighted_mean_of_available(weights or WEIGHTS))
    return scored.withColumn("gap", F.col("score_valeur") - F.col("n_prix")).withColumn(
        "gap_pondere", F.col("gap") * F.col("n_access_fin")
    )


def territory_score(base: DataFrame) -> DataFrame:
    """Score of every commune of ``score_base``.

    ``base`` is read several times (medians, quantiles, rows): hand in a stored
    table, see ``sources.staging.staged``.
    """
    return with_gaps(normalised_dimensions(score_inputs(base))).select(
        CODE,
        "nom_commune",
        "code_departement",
        "nb_transactions",
        "prix_m2_median",
        "dpe_dominant",
        *DIMENSIONS,
        "score_valeur",
        "gap",
        "gap_pondere",
    )


def zone_score(prices: DataFrame, zones: DataFrame, scores: DataFrame) -> DataFrame:
    """Neighbourhood gap: own price against the quality inherited from the commune.

    Zones are restricted to reliable ones of scored communes *before* the price
    is normalised, so that only published zones shape the scale.
    """
    published = prices.where("fiable").join(scores.select(CODE), CODE, "left_semi")
    priced = normalise(published, {"n_prix_iris": ("prix_m2_median", False)})
    inherited = scores.select(
        CODE,
        "nom_commune",
        "code_departement",
        F.col("score_valeur").alias("score_commune"),
        F.col("n_prix").alias("n_prix_commune"),
        F.col("n_access_fin").alias("n_access_fin_commune"),
    )
    gap = F.col("score_commune") - F.col("n_prix_iris")
    return (
        priced.join(
            zones.select("code_iris", "nom_iris", "type_iris", "nb_iris_commune"), "code_iris"
        )
        .join(inherited, CODE)
        .select(
            "code_iris",
            CODE,
            "nom_iris",
            "type_iris",
            "nb_iris_commune",
            "nom_commune",
            "code_departement",
            "nb_transactions",
            "prix_m2_median",
            "annee_min",
            "annee_max",
            "nb_millesimes",
            "n_prix_iris",
            "score_commune",
            "n_prix_commune",
            "n_access_fin_commune",
            gap.alias("gap_iris"),
            (gap * F.col("n_access_fin_commune")).alias("gap_pondere_iris"),
        )
    )
