"""Sale records: from raw lines to prices per square metre."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcella.functions.codes import department_code, territory_code
from parcella.functions.numbers import ratio, real
from parcella.operators.quantiles import group_quantiles

# The market studied and the plausibility bounds.
SALE_NATURE = "Vente"
DWELLING_TYPES = ("Maison", "Appartement")
PRICE_M2_RANGE = (100, 50_000)
SURFACE_RANGE = (9, 1_000)
RELIABLE_FROM = 5

PRICE = "prix_m2"

# Turns a frame into a stored table with the same rows.
Store = Callable[[DataFrame], DataFrame]


def clean_sale_lines(raw: DataFrame) -> DataFrame:
    """Dwelling sale lines with typed numbers and padded codes.

    The two equality filters come first and on raw columns, so that a Parquet
    source receives them as pushed filters. Extra columns such as a vintage
    ``annee`` are kept.
    """
    surface, value = real("surface_reelle_bati"), real("valeur_fonciere")
    kept = [c for c in ("annee",) if c in raw.columns]
    return raw.where(
        (F.col("nature_mutation") == SALE_NATURE)
        & F.col("type_local").isin(*DWELLING_TYPES)
        & (surface > 0)
        & (value > 0)
    ).select(
        "id_mutation",
        "nature_mutation",
        "type_local",
        value.alias("valeur_fonciere"),
        surface.alias("surface_bati"),
        territory_code("code_commune").alias("code_commune"),
        "nom_commune",
        department_code("code_departement").alias("code_departement"),
        real("longitude").alias("longitude"),
        real("latitude").alias("latitude"),
        *kept,
    )


def _best_line(*fields: str) -> Column:
    """One representative line per sale: with coordinates if any line has them,
    then with a name, then the largest code. Taking all attributes from a single
    line keeps longitude and latitude together and makes the pick repeatable."""
    located = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    return F.max(
        F.struct(
            located.alias("_located"),
            F.col("nom_commune").isNotNull().alias("_named"),
            *[F.col(f) for f in fields],
        )
    )


def dedup_sales(lines: DataFrame, keys: Sequence[str] = ("id_mutation",)) -> DataFrame:
    """One row per sale; sales with several values or several types are left out.

    ``min = max`` stands for "exactly one distinct value", so no distinct
    aggregate and no row expansion is needed. All attributes ride in one struct:
    every consumer of the result then asks for the same aggregate, which lets
    Spark reuse its shuffle when the sales are read more than once.

    Lines are dealt by sale once. Those of one type and place are first summed by
    hash, as numbers are all their state; texts as state make Spark sort, so only
    what is left of a sale is sorted, not its lines.
    """
    place = ("code_commune", "nom_commune", "code_departement", "longitude", "latitude")
    alike = lines.repartition(*keys).groupBy(*keys, "type_local", *place).agg(
        F.min("valeur_fonciere").alias("_v0"),
        F.max("valeur_fonciere").alias("_v1"),
        F.sum("surface_bati").alias("surface_bati"),
    )
    grouped = alike.groupBy(*keys).agg(
        F.min("_v0").alias("_v0"),
        F.max("_v1").alias("_v1"),
        F.min("type_local").alias("_t0"),
        F.max("type_local").alias("_t1"),
        F.sum("surface_bati").alias("surface_bati"),
        _best_line(*place).alias("_place"),
    )
    return grouped.where((F.col("_v0") == F.col("_v1")) & (F.col("_t0") == F.col("_t1"))).select(
        *keys,
        F.col("_t0").alias("type_local"),
        F.col("_v0").alias("valeur_fonciere"),
        "surface_bati",
        *[F.col(f"_place.{c}").alias(c) for c in place],
        ratio("_v0", "surface_bati").alias(PRICE),
    )


def bound_sales(sales: DataFrame) -> DataFrame:
    """Absolute plausibility bounds on surface, coordinates and price."""
    return sales.where(
        F.col("surface_bati").between(*SURFACE_RANGE)
        & F.col("longitude").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col(PRICE).between(*PRICE_M2_RANGE)
    )


def clip_by_group(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    low: float = 0.01,
    high: float = 0.99,
    *,
    method: str = "bracketed",
) -> DataFrame:
    """Keep rows whose value lies between two quantiles of their group, inclusive."""
    bounds = group_quantiles(df, keys, value, {"_low": low, "_high": high}, method=method)
    return (
        df.join(bounds, list(keys))
        .where(F.col(value).between(F.col("_low"), F.col("_high")))
        .select(*df.columns)
    )


def clean_sales(
    raw: DataFrame, *, method: str = "bracketed", store: Store | None = None
) -> DataFrame:
    """Raw lines to clean sales: filter, de-duplicate, bound, clip p1-p99.

    ``store`` (such as ``sources.staging.staged``) keeps the bounded sales and
    the result as tables. Several passes read them, and a stored table is read
    narrow and has a known size; without it one lazy plan does everything.
    """
    keep = store or (lambda df: df)
    bounded = keep(bound_sales(dedup_sales(clean_sale_lines(raw))))
    return keep(clip_by_group(bounded, ["code_departement", "type_local"], PRICE, method=method))


def _price_facts(*attributes: str, mean: bool = False) -> dict:
    facts = {
        "nb_transactions": (F.count(F.lit(1)), F.sum),
        **{a: (F.min(a), F.min) for a in attributes},
    }
    if mean:
        facts["_sum"] = (F.sum(PRICE), F.sum)
    return facts


def _reliable(threshold: int) -> Column:
    return (F.col("nb_transactions") >= threshold).alias("fiable")


def price_by_commune(
    sales: DataFrame, *, threshold: int = RELIABLE_FROM, method: str = "bracketed"
) -> DataFrame:
    """Count, median, quartiles and mean per commune; small samples are only flagged."""
    stats = group_quantiles(
        sales,
        ["code_commune"],
        PRICE,
        {"prix_m2_median": 0.5, "prix_m2_p25": 0.25, "prix_m2_p75": 0.75},
        facts=_price_facts("nom_commune", "code_departement", mean=True),
        method=method,
    )
    return stats.select(
        "code_commune",
        "nom_commune",
        "code_departement",
        "nb_transactions",
        "prix_m2_median",
        "prix_m2_p25",
        "prix_m2_p75",
        (F.col("_sum") / F.col("nb_transactions")).alias("prix_m2_moyen"),
        _reliable(threshold),
    )


def price_by_commune_and_type(
    sales: DataFrame, *, threshold: int = RELIABLE_FROM, method: str = "bracketed"
) -> DataFrame:
    """Count and median per commune and dwelling type."""
    stats = group_quantiles(
        sales,
        ["code_commune", "type_local"],
        PRICE,
        {"prix_m2_median": 0.5},
        facts=_price_facts("nom_commune", "code_departement"),
        method=method,
    )
    return stats.select(
        "code_commune",
        "type_local",
        "nom_commune",
        "code_departement",
        "nb_transactions",
        "prix_m2_median",
        _reliable(threshold),
    )


def price_with_all_types(
    sales: DataFrame,
    key: str,
    *,
    threshold: int = RELIABLE_FROM,
    method: str = "bracketed",
) -> DataFrame:
    """Grouping sets (key) and (key, type): ``type_local`` is NULL on the all-types rows.

    ``tous_types`` tells those rows from data whose type is missing.
    """
    both = sales.select(
        key, "type_local", PRICE, F.explode(F.array(F.lit(True), F.lit(False))).alias("tous_types")
    ).withColumn("type_local", F.when(~F.col("tous_types"), F.col("type_local")))
    stats = group_quantiles(
        both,
        [key, "type_local", "tous_types"],
        PRICE,
        {"prix_m2_median": 0.5},
        facts=_price_facts(),
        method=method,
    )
    return stats.select(
        key, "type_local", "nb_transactions", "prix_m2_median", _reliable(threshold), "tous_types"
    )


def price_by_department(sales: DataFrame, **options) -> DataFrame:
    """Department medians, all types together and by type."""
    return price_with_all_types(sales, "code_departement", **options)


def vintage_sales(
    raw: DataFrame, *, method: str = "bracketed", store: Store | None = None
) -> DataFrame:
    """Clean sales of every vintage in ``raw`` (column ``annee``) in a single job."""
    keep = store or (lambda df: df)
    keys = ("id_mutation", "annee")
    bounded = keep(bound_sales(dedup_sales(clean_sale_lines(raw), keys)))
    return keep(
        clip_by_group(bounded, ["annee", "code_departement", "type_local"], PRICE, method=method)
    )


def vintage_points(sales: DataFrame) -> DataFrame:
    """Located sales of all vintages, the input of the neighbourhood prices."""
    return sales.select(
        "annee", "id_mutation", "code_commune", "longitude", "latitude", PRICE, "type_local"
    )


def vintage_prices(sales: DataFrame, *, method: str = "bracketed") -> DataFrame:
    """Count and median per vintage and commune."""
    stats = group_quantiles(
        sales,
        ["annee", "code_commune"],
        PRICE,
        {"prix_m2_median": 0.5},
        facts=_price_facts(),
        method=method,
    )
    return stats.select("annee", "code_commune", "nb_transactions", "prix_m2_median")


# --- single-dwelling variant -------------------------------------------------


def to_bronze(raw: DataFrame) -> DataFrame:
    """Typed date. The partitions stay as they are: a source that cannot be split is
    spread where it is read (``readers.gzip_csv``)."""
    return raw.withColumn("date_mutation", F.try_to_date(F.col("date_mutation"), "yyyy-MM-dd"))


def filter_quality(df: DataFrame, natures: Sequence[str] = (SALE_NATURE,)) -> DataFrame:
    """Rows of the given natures with a positive value."""
    return df.where(F.col("nature_mutation").isin(*natures) & (F.col("valeur_fonciere") > 0))


def mutations(clean: DataFrame, types: Sequence[str] = DWELLING_TYPES) -> DataFrame:
    """One characterised row per sale, whatever it contains.

    Values are constant per sale, so ``min`` is a repeatable "first non-null".
    """
    built = F.col("type_local").isin(*types)
    constant = (
        "date_mutation",
        "nature_mutation",
        "valeur_fonciere",
        "code_commune",
        "nom_commune",
        "code_departement",
    )
    point = F.min(
        F.when(
            F.col("longitude").isNotNull() & F.col("latitude").isNotNull(),
            F.struct("longitude", "latitude"),
        )
    )

    def tally(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    return (
        clean.groupBy("id_mutation")
        .agg(
            *[F.min(c).alias(c) for c in constant],
            point.alias("_point"),
            tally(built).alias("nb_locaux_batis"),
            tally(F.col("type_local") == "Maison").alias("nb_maisons"),
            tally(F.col("type_local") == "Appartement").alias("nb_appartements"),
            F.sum(F.when(built, F.col("surface_reelle_bati"))).alias("surface_bati_totale"),
            F.min(F.when(built, F.col("type_local"))).alias("type_local"),
        )
        .select(
            "id_mutation",
            *constant,
            F.col("_point.longitude").alias("longitude"),
            F.col("_point.latitude").alias("latitude"),
            "nb_locaux_batis",
            "nb_maisons",
            "nb_appartements",
            "surface_bati_totale",
            "type_local",
        )
    )


def single_dwelling_price(
    sales: DataFrame,
    dwellings: int = 1,
    low: float = 0.01,
    high: float = 0.99,
    *,
    method: str = "approx",
) -> DataFrame:
    """Price per m2 of sales with exactly ``dwellings`` dwellings, clipped per
    department and type. ``method='approx'`` keeps a bounded sketch per group,
    ``'discrete'`` takes the exact prices at those ranks;
    ``'ranked'`` makes the bounds exact and interpolated."""
    priced = sales.where(
        (F.col("nb_locaux_batis") == dwellings) & (F.col("surface_bati_totale") > 0)
    ).withColumn(PRICE, ratio("valeur_fonciere", "surface_bati_totale"))
    return clip_by_group(
        priced, ["code_departement", "type_local"], PRICE, low, high, method=method
    )


def _spread(df: DataFrame, keys: Sequence[str], threshold: int, method: str) -> DataFrame:
    facts = {
        **_price_facts(mean=True),
        "prix_m2_min": (F.min(PRICE), F.min),
        "prix_m2_max": (F.max(PRICE), F.max),
    }
    quantiles = {"prix_m2_median": 0.5, "prix_m2_p25": 0.25, "prix_m2_p75": 0.75}
    return group_quantiles(df, keys, PRICE, quantiles, facts=facts, method=method).select(
        *keys,
        "nb_transactions",
        *quantiles,
        F.round(F.col("_sum") / F.col("nb_transactions"), 2).alias("prix_m2_moyen"),
        "prix_m2_min",
        "prix_m2_max",
        _reliable(threshold),
    )


def spread_by_commune(
    df: DataFrame, threshold: int = RELIABLE_FROM, *, method: str = "approx"
) -> DataFrame:
    """Price spread per commune and dwelling type."""
    keys = ["code_departement", "code_commune", "nom_commune", "type_local"]
    return _spread(df, keys, threshold, method)


def spread_by_department(
    df: DataFrame, threshold: int = RELIABLE_FROM, *, method: str = "approx"
) -> DataFrame:
    """Price spread per department and dwelling type."""
    return _spread(df, ["code_departement", "type_local"], threshold, method)


def transactions(df: DataFrame) -> DataFrame:
    """Individual priced sales, the columns a search service filters on."""
    return df.select(
        "id_mutation",
        "date_mutation",
        "type_local",
        "valeur_fonciere",
        F.col("surface_bati_totale").alias("surface_bati"),
        F.round(PRICE, 2).alias(PRICE),
        "code_commune",
        "nom_commune",
        "code_departement",
        "longitude",
        "latitude",
    )
