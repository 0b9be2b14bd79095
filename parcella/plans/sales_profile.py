"""Profile of raw sale lines: the five sections of the exploration report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parcella.operators.quality import missing_share
from parcella.operators.sales import DWELLING_TYPES, RELIABLE_FROM
from parcella.sources.staging import staged

CARDINALITIES = (
    "id_mutation",
    "code_commune",
    "code_departement",
    "nature_mutation",
    "type_local",
)


def _tall(row: DataFrame, section: str) -> DataFrame:
    """A one-row frame of figures as (section, mesure, valeur) rows."""
    lines = [
        F.struct(F.lit(n).alias("mesure"), F.col(n).cast("double").alias("valeur"))
        for n in row.columns
    ]
    return row.select(F.inline(F.array(*lines))).select(
        F.lit(section).alias("section"), "mesure", "valeur"
    )


def profile_sales(
    lines: DataFrame,
    types: Sequence[str] = DWELLING_TYPES,
    threshold: int = RELIABLE_FROM,
    error: float = 1e-4,
) -> DataFrame:
    """Completeness, cardinalities, sale structure, outliers, single-dwelling prices
    and geography as one tall table, from two reads of ``lines``."""
    built = F.col("type_local").isin(*types)
    surface = F.when(built, F.col("surface_reelle_bati"))

    tails, quarters = {"p1": 0.01, "p50": 0.5, "p99": 0.99}, {"p25": 0.25, "mediane": 0.5, "p75": 0.75}

    def sketch(column, shares: dict):
        """All quantiles of a column from one sketch."""
        return F.percentile_approx(column, list(shares.values()), int(1 / error))

    def marks(name: str) -> list:
        return [F.col(f"_marks_{name}")[i].alias(f"{name}_{label}") for i, label in enumerate(tails)]

    # first read: all figures of the whole table in one row
    missing = [
        F.round(missing_share(f.name, isinstance(f.dataType, StringType)), 4).alias(f"_{f.name}")
        for f in lines.schema.fields
    ]
    whole = staged(
        lines.agg(
            *missing,
            F.count(F.lit(1)).alias("lignes"),
            F.count_if(F.col("valeur_fonciere").isNull()).alias("valeur_nulle"),
            F.count_if(F.col("valeur_fonciere") <= 0).alias("valeur_zero_ou_negative"),
            sketch("valeur_fonciere", tails).alias("_marks_valeur"),
            F.count_if(built & F.coalesce(F.col("surface_reelle_bati") <= 0, F.lit(True))).alias(
                "surface_nulle_ou_zero"
            ),
            sketch(surface, tails).alias("_marks_surface"),
            F.count_if(F.col("longitude").isNull() | F.col("latitude").isNull()).alias(
                "sans_coordonnees"
            ),
        ),
        "whole",
    )
    completeness = whole.select(*[F.col(f"_{f}").alias(f) for f in lines.columns])
    outliers = whole.select(
        "lignes", "valeur_nulle", "valeur_zero_ou_negative", *marks("valeur"),
        "surface_nulle_ou_zero", *marks("surface"), "sans_coordonnees",
    )

    # second read: one expansion to all grains (sale, commune, distinct values), one
    # map-side combined count by (grain, key) with states that every grain can use
    # (sales and communes are also the distinct values of their columns)
    keys = [F.struct(F.lit(c).alias("grain"), F.col(c).cast("string").alias("key")) for c in CARDINALITIES]
    states = staged(
        lines.select("*", F.inline(F.array(*keys)))
        .groupBy("grain", "key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("valeur_fonciere").alias("v0"),
            F.max("valeur_fonciere").alias("v1"),
            F.min("numero_disposition").alias("d0"),
            F.max("numero_disposition").alias("d1"),
            F.count_if(built).alias("n_built"),
            F.min(F.when(built, F.col("type_local"))).alias("type_local"),
            F.min(F.when(built, F.col("valeur_fonciere"))).alias("v"),
            F.min(surface).alias("s"),
            *[F.max((F.col("type_local") == t).cast("int")).alias(f"has{i}") for i, t in enumerate(types)],
        ),
        "grains",
    )
    cardinalities = (
        states.groupBy(F.col("grain").alias("mesure"))
        .agg(F.count("key").cast("double").alias("valeur"))
        .select(F.lit("cardinalites").alias("section"), "mesure", "valeur")
    )
    per_sale = states.where("grain = 'id_mutation'")
    structure = per_sale.agg(
        F.avg("n").alias("lignes_moyenne"),
        F.percentile_approx("n", 0.5, int(1 / error)).alias("lignes_mediane"),
        F.max("n").alias("lignes_max"),
        F.count_if(F.col("v0") != F.col("v1")).alias("valeur_non_constante"),
        F.count_if(F.col("d0") != F.col("d1")).alias("multi_disposition"),
    )
    single = per_sale.where((F.col("n_built") == 1) & (F.col("s") > 0) & (F.col("v") > 0)).select(
        "type_local", (F.col("v") / F.col("s")).alias("prix_m2")
    )
    prices = single.groupBy("type_local").agg(
        F.count(F.lit(1)).alias("n"), sketch("prix_m2", quarters).alias("_marks")
    ).select("type_local", "n", *[F.col("_marks")[i].alias(label) for i, label in enumerate(quarters)])
    figures = F.array(
        *[
            F.struct(
                F.concat("type_local", F.lit(f"_{c}")).alias("mesure"),
                F.col(c).cast("double").alias("valeur"),
            )
            for c in ("n", "p25", "mediane", "p75")
        ]
    )
    single_prices = prices.select(F.inline(figures)).select(
        F.lit("prix_m2").alias("section"), "mesure", "valeur"
    )

    kinds = reduce(add, (F.coalesce(f"has{i}", F.lit(0)) for i in range(len(types))))
    geography = states.where("grain = 'code_commune'").agg(
        F.count(F.lit(1)).alias("communes_actives"),
        F.sum(kinds).alias("communes_x_types"),
        F.count_if(F.col("n") < threshold).alias("communes_peu_actives"),
    )
    return (
        _tall(completeness, "manquants")
        .unionByName(cardinalities)
        .unionByName(_tall(structure, "mutations"))
        .unionByName(_tall(outliers, "aberrations"))
        .unionByName(single_prices)
        .unionByName(_tall(geography, "geographie"))
    )
