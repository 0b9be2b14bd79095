"""Administrative outlines and neighbourhoods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcella.functions import geo
from parcella.functions.codes import department_code, territory_code
from parcella.operators.quantiles import group_quantiles
from parcella.operators.sales import PRICE, RELIABLE_FROM
from parcella.operators.spatial import DEFAULT_CELL, points_in_polygons


def usable_outlines(df: DataFrame) -> DataFrame:
    """Outlines with a geometry and a positive, finite area."""
    area = F.col("surface_km2")
    return df.where(
        F.col("geom").isNotNull() & area.isNotNull() & ~F.isnan(area) & (area > 0)
    )


def commune_outlines(raw: DataFrame) -> DataFrame:
    """Commune outlines with area; unusable ones are dropped."""
    return usable_outlines(
        raw.select(
            territory_code("code").alias("code_commune"),
            F.col("nom").alias("nom_commune"),
            "geom",
            geo.area_km2("geom").alias("surface_km2"),
        )
    )


def named_outlines(raw: DataFrame, code: str, name: str) -> DataFrame:
    """Department or region outlines under the given column names."""
    return raw.select(department_code("code").alias(code), F.col("nom").alias(name), "geom")


def aligned_outlines(variant: DataFrame, reference: DataFrame, code: str) -> DataFrame:
    """A level-of-detail variant restricted to the codes of the cleaned reference."""
    return variant.join(reference.select(code), code, "left_semi")


def commune_variant(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Simplified commune outlines aligned on the cleaned ones."""
    shaped = raw.select(
        territory_code("code").alias("code_commune"), F.col("nom").alias("nom_commune"), "geom"
    )
    return aligned_outlines(shaped, reference, "code_commune")


def zone_outlines(raw: DataFrame) -> DataFrame:
    """Neighbourhood outlines with the number of zones in their commune.

    Never filtered on commune outlines: zones of city districts carry district
    codes those do not know.
    """
    shaped = raw.where(F.col("geom").isNotNull() & F.col("code_iris").isNotNull()).withColumn(
        "code_commune", territory_code("code_insee")
    )
    # Counted apart and joined back: outlines need not meet in one task per commune.
    siblings = shaped.groupBy(F.col("code_commune").alias("_commune")).agg(
        F.count(F.lit(1)).alias("nb_iris_commune")
    )
    return shaped.join(siblings, F.expr("code_commune <=> _commune")).select(
        "code_iris",
        "code_commune",
        "nom_commune",
        "nom_iris",
        "type_iris",
        "nb_iris_commune",
        "geom",
    )


def assign_to_zones(
    points: DataFrame, zones: DataFrame, *, cell: float = DEFAULT_CELL
) -> DataFrame:
    """Sale points to neighbourhoods, one zone per sale.

    Communes with a single zone need no geometry. Elsewhere the zone must belong
    to the sale's commune and hold the point, border included; a point on a
    shared border goes to the smallest zone code. Sales without zone are lost.
    """
    sale = ["id_mutation", PRICE, "annee"]
    single = zones.where(F.col("nb_iris_commune") == 1).select("code_commune", "code_iris")
    several = zones.where(F.col("nb_iris_commune") > 1)
    direct = points.join(single, "code_commune").select(*sale, "code_iris", "code_commune")
    tested = points_in_polygons(
        points,
        several,
        x="longitude",
        y="latitude",
        keep=["code_iris"],
        key="code_commune",
        border=True,
        cell=cell,
    ).select(*sale, "code_iris", "code_commune")
    first = F.min(F.struct("code_iris", "code_commune", "annee", PRICE)).alias("_first")
    return (
        direct.unionByName(tested)
        .groupBy("id_mutation")
        .agg(first)
        .select("id_mutation", *[f"_first.{c}" for c in (PRICE, "annee", "code_iris", "code_commune")])
    )


def zone_prices(
    assigned: DataFrame, *, threshold: int = RELIABLE_FROM, method: str = "bracketed"
) -> DataFrame:
    """Pooled price statistics per neighbourhood with the span of vintages used."""
    facts = {
        "code_commune": (F.min("code_commune"), F.min),
        "nb_transactions": (F.count(F.lit(1)), F.sum),
        "annee_min": (F.min("annee"), F.min),
        "annee_max": (F.max("annee"), F.max),
        "_years": (
            F.collect_set("annee"),
            F.collect_set,
            lambda sets: F.array_distinct(F.flatten(sets)),
        ),
    }
    stats = group_quantiles(
        assigned, ["code_iris"], PRICE, {"prix_m2_median": 0.5}, facts=facts, method=method
    )
    return stats.select(
        "code_iris",
        "code_commune",
        "nb_transactions",
        "prix_m2_median",
        (F.col("nb_transactions") >= threshold).alias("fiable"),
        "annee_min",
        "annee_max",
        F.size("_years").cast("long").alias("nb_millesimes"),
    )


def merge_levels(
    levels: dict[str, DataFrame], key: str, attributes: list[str]
) -> DataFrame:
    """One row per key with a geometry column per level of detail.

    ``levels`` maps a level name to outlines, in order of precedence: attributes
    come from the first level that knows the key.
    """
    merged: DataFrame | None = None
    for level, frame in levels.items():
        part = frame.select(
            key,
            F.struct(*attributes).alias(f"_attr_{level}"),
            F.col("geom").alias(f"geom_{level}"),
        )
        merged = part if merged is None else merged.join(part, key, "full_outer")
    source = F.coalesce(*[F.col(f"_attr_{level}") for level in levels])
    return merged.withColumn("_attr", source).select(
        key, *[F.col(f"_attr.{a}").alias(a) for a in attributes], *[f"geom_{v}" for v in levels]
    )
