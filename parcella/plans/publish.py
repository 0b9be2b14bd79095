"""Publication: every artefact of a run, the manifest last.

A run's artefacts go to a folder of their own; ``meta.json`` names that folder as ``base``
and is renamed into place when all of them stand, so a reader follows it to a whole run, the
old or the new one. Every artefact is one JSON document, or one a department.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcella.plans import exports
from parcella.sources import readers, snapshots, writers
from parcella.sources.layout import Layout
from parcella.sources.staging import staged

SCHEMA_VERSION = 1


def publish_latest(layout: Layout, table: str, run_date: str, spark: SparkSession) -> None:
    """Make a run's table the one that readers of the stable path get (``snapshots.table``)."""
    frame = readers.parquet(spark, layout.gold(table, run_date))
    snapshots.replace(frame, layout.latest(table), run_date)


def _fresh_base(spark: SparkSession, layout: Layout, run_date: str) -> str:
    """Folder of the run below the web root; a repeated run gets a number."""
    base, n = f"runs/{run_date}", 1
    while snapshots.exists(spark, f"{layout.web()}/{base}"):
        n += 1
        base = f"runs/{run_date}.{n}"
    return base


def publish_web(
    tables: Mapping[str, DataFrame],
    layout: Layout,
    *,
    year: int,
    run_date: str,
    vintages: Mapping[int, DataFrame] | None = None,
    sample: int = 250_000,
    review_source: str = "avis",
) -> DataFrame:
    """Write all artefacts of a run and return its manifest.

    ``tables`` holds the silver and gold tables by name. ``regions``, ``zones``
    with ``zone_scores``, and ``reviews`` are optional: without them the run is
    simply narrower.
    """
    out = tables["communes"]
    spark = out.sparkSession
    base = _fresh_base(spark, layout, run_date)
    root = f"{layout.web()}/{base}"
    scores, prices, typed = tables["scores"], tables["prices"], tables["prices_by_type"]
    digits, code, dept = exports.COORDINATE_DIGITS, exports.CODE, exports.DEPT

    if "regions" in tables:
        regions = staged(
            exports.choropleth_regions(tables["regions"], tables["sales"], scores), "regions"
        )
        writers.feature_collections(
            regions, f"{root}/choropleth/regions-low", digits=digits["low"], order=["code_region"]
        )
        writers.json_documents(regions.drop("geom"), f"{root}/stats/regions", order=["code_region"])
    for level, name in (("low", "departments_low"), ("mid", "departments_mid")):
        shapes = tables.get(name, tables["departments"])
        departments = exports.choropleth_departments(shapes, tables["prices_by_department"], scores)
        writers.feature_collections(
            departments, f"{root}/choropleth/departements-{level}", digits=digits[level], order=[dept]
        )

    mid = staged(
        exports.choropleth_communes(tables.get("communes_mid", out), prices, typed, scores), "mid"
    )
    writers.feature_collections(mid, f"{root}/choropleth/communes-mid", digits=digits["mid"], order=[code])
    high = mid if "communes_mid" not in tables else exports.choropleth_communes(out, prices, typed, scores)
    writers.feature_collections(
        high, f"{root}/choropleth/communes-high", digits=digits["high"], order=[code], split_by=dept
    )
    zones = None
    if "zones" in tables and "zone_scores" in tables:
        zones = staged(exports.choropleth_zones(tables["zones"], tables["zone_scores"]), "zones")
        writers.feature_collections(
            zones, f"{root}/choropleth/iris-high", digits=digits["high"], order=["code_iris"], split_by=dept
        )

    reviews = tables.get("reviews")
    rollup = exports.no_reviews(scores) if reviews is None else reviews
    years = exports.pooled_years(prices, year, vintages or {})
    documents = staged(
        exports.territory_documents(
            out,
            prices,
            typed,
            scores,
            exports.price_evolution(years),
            {name: tables[name] for name in set(exports.DOCUMENT_FIELDS.values())},
            rollup,
        ),
        "documents",
    )
    writers.json_documents(documents, f"{root}/communes", order=[code], split_by=dept)
    export = staged(exports.review_export(rollup, review_source), "reviews")
    if reviews is not None:
        writers.json_documents(export, f"{root}/avis", order=[code], split_by=dept)
        writers.json_documents(exports.review_index(export, out), f"{root}/avis/index", order=["c"])

    writers.json_documents(
        exports.search_index(out, prices, scores), f"{root}/search/index", order=["c"]
    )
    writers.json_documents(
        exports.ranking(scores), f"{root}/classements/gap-pondere", order=["rang"]
    )
    writers.json_documents(
        exports.points_sample(tables["sales"], sample),
        f"{root}/points/transactions-sample",
        order=["lon", "lat", "prix", "t"],
    )
    stats_tables = {table for table, _ in exports.STATS_FIELDS.values()}
    writers.json_documents(
        exports.territory_stats(scores, {name: tables[name] for name in stats_tables}),
        f"{root}/charts/stats_communes",
        order=[code],
    )
    writers.json_documents(
        exports.price_histogram(tables["sales"]), f"{root}/charts/prix_distribution", order=["bin"]
    )
    all_years = sorted({year, *(vintages or {})})
    writers.json_documents(
        exports.price_series(years, all_years), f"{root}/charts/prix_series/communes", order=[code]
    )
    writers.json_documents(
        exports.national_series(years), f"{root}/charts/prix_series/national", order=["annee"]
    )
    writers.feature_collections(
        exports.score_flat(mid), f"{root}/score", digits=digits["mid"], order=[code]
    )

    manifest = staged(_manifest(documents, export, zones, year, run_date, base), "manifest")
    meta = manifest.select(F.to_json(F.struct("*"))).first()[0]  # one row
    snapshots.write_small(spark, f"{layout.web()}/meta.json", meta)
    return manifest


def published_base(spark: SparkSession, layout: Layout) -> str | None:
    """Folder of the run that ``meta.json`` names; None before the first."""
    meta = snapshots.read_small(spark, f"{layout.web()}/meta.json")
    return f"{layout.web()}/{json.loads(meta)['base']}" if meta else None


#: Artefact -> (its file or folder of files below the base, whether items are features).
ARTEFACTS = {
    "regions-low": ("choropleth/regions-low.geojson", True),
    "regions": ("stats/regions.json", False),
    "departements-low": ("choropleth/departements-low.geojson", True),
    "departements-mid": ("choropleth/departements-mid.geojson", True),
    "communes-mid": ("choropleth/communes-mid.geojson", True),
    "communes-high": ("choropleth/communes-high/*.geojson", True),
    "iris-high": ("choropleth/iris-high/*.geojson", True),
    "communes": ("communes/*.json", False),
    "avis": ("avis/[0-9]*.json", False),
    "avis-index": ("avis/index.json", False),
    "search": ("search/index.json", False),
    "classement": ("classements/gap-pondere.json", False),
    "points": ("points/transactions-sample.json", False),
    "stats": ("charts/stats_communes.json", False),
    "distribution": ("charts/prix_distribution.json", False),
    "series": ("charts/prix_series/communes.json", False),
    "national": ("charts/prix_series/national.json", False),
    "score": ("score.geojson", True),
}


def read_artefact(spark: SparkSession, base: str, name: str, item: str) -> DataFrame:
    """Items of a published artefact, ``item`` the DDL of what is wanted of each, and ``file``."""
    path, features = ARTEFACTS[name]
    fields = writers.nested_ddl(item)
    schema = f"features array<struct<properties:struct<{fields}>>>" if features else item
    rows = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schema).json(f"{base}/{path}")
    file = F.col("_metadata.file_name").alias("file")
    if not features:
        return rows.select("*", file)
    return rows.select(F.explode("features.properties").alias("_p"), file).select("_p.*", "file")


def _manifest(
    documents: DataFrame, reviews: DataFrame, zones: DataFrame | None, year: int, run_date: str, base: str
) -> DataFrame:
    """One row describing the run, counted on the tables just published."""
    counts = documents.agg(
        F.count(F.lit(1)).alias("nb_communes"), F.count("score").alias("nb_communes_scorees")
    ).withColumn(
        "nb_communes_avis",
        reviews.agg(F.count(F.lit(1)).alias("n")).scalar(),
    )
    if zones is not None:
        zone_counts = zones.agg(
            F.struct(F.count(F.lit(1)).alias("n"), F.count("gap_iris").alias("scored")).alias("z")
        ).scalar()
        counts = counts.withColumn("nb_iris", zone_counts["n"]).withColumn(
            "nb_iris_scores", zone_counts["scored"]
        )
    return counts.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(run_date).alias("run_date"),
        F.lit(year).alias("year"),
        F.lit(base).alias("base"),
        "*",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"),
    )
