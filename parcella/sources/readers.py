"""Typed readers. Schemas are always given, never inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcella.functions import geo

# Columns and types of the published sale records, in file order.
SALE_COLUMNS = (
    ("id_mutation", "string"),
    ("date_mutation", "string"),
    ("numero_disposition", "string"),
    ("nature_mutation", "string"),
    ("valeur_fonciere", "double"),
    ("adresse_numero", "string"),
    ("adresse_suffixe", "string"),
    ("adresse_nom_voie", "string"),
    ("adresse_code_voie", "string"),
    ("code_postal", "string"),
    ("code_commune", "string"),
    ("nom_commune", "string"),
    ("code_departement", "string"),
    ("ancien_code_commune", "string"),
    ("ancien_nom_commune", "string"),
    ("id_parcelle", "string"),
    ("ancien_id_parcelle", "string"),
    ("numero_volume", "string"),
    ("lot1_numero", "string"),
    ("lot1_surface_carrez", "double"),
    ("lot2_numero", "string"),
    ("lot2_surface_carrez", "double"),
    ("lot3_numero", "string"),
    ("lot3_surface_carrez", "double"),
    ("lot4_numero", "string"),
    ("lot4_surface_carrez", "double"),
    ("lot5_numero", "string"),
    ("lot5_surface_carrez", "double"),
    ("nombre_lots", "string"),
    ("code_type_local", "string"),
    ("type_local", "string"),
    ("surface_reelle_bati", "double"),
    ("nombre_pieces_principales", "double"),
    ("code_nature_culture", "string"),
    ("nature_culture", "string"),
    ("code_nature_culture_speciale", "string"),
    ("nature_culture_speciale", "string"),
    ("surface_terrain", "double"),
    ("longitude", "double"),
    ("latitude", "double"),
)


def sale_schema() -> StructType:
    """The 40-column sale schema; codes stay text to keep their zeros."""
    schema = StructType()
    for name, kind in SALE_COLUMNS:
        schema.add(name, kind)
    return schema


def text_csv(spark: SparkSession, path: str, *, sep: str = ",", **options: object) -> DataFrame:
    """CSV with a header, every column as text. Gzip is recognised by its suffix."""
    return (
        spark.read.options(header=True, sep=sep, quote='"', escape='"', inferSchema=False, **options)
        .csv(path)
    )


def semicolon_csv(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon CSV; rows that do not fit the header are skipped.

    Column pruning is off, or a query of few columns would not notice bad rows.
    """
    return text_csv(spark, path, sep=";", mode="DROPMALFORMED", columnPruning=False)


def gzip_csv(
    spark: SparkSession, path: str, partitions: int, schema: StructType | None = None
) -> DataFrame:
    """Gzip CSV, spread over ``partitions`` if the unsplittable files give fewer."""
    frame = typed_csv(spark, path, schema) if schema else text_csv(spark, path)
    return frame.repartition(partitions) if frame.rdd.getNumPartitions() < partitions else frame


def typed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header under an explicit schema."""
    return spark.read.options(header=True, quote='"', escape='"').schema(schema).csv(path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON Lines under an explicit schema; unreadable lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def feature_collection(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """GeoJSON FeatureCollection files, one row per feature.

    ``properties`` is the DDL of the wanted properties; they become columns next
    to ``geom``. A file is one record, so split very large collections upstream
    or use ``feature_lines``.
    """
    schema = f"features array<struct<properties:struct<{_ddl_fields(properties)}>,geometry:string>>"
    rows = spark.read.option("multiLine", True).schema(schema).json(path)
    return _flat_features(rows.select(F.explode("features").alias("_f")))


def feature_lines(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """GeoJSON text sequence (one feature per line), which splits across tasks."""
    schema = f"properties struct<{_ddl_fields(properties)}>, geometry string"
    rows = spark.read.schema(schema).json(path)
    return _flat_features(rows.select(F.struct("properties", "geometry").alias("_f")))


def _ddl_fields(properties: str) -> str:
    return ",".join(":".join(part.split()) for part in properties.split(","))


def _flat_features(rows: DataFrame) -> DataFrame:
    return rows.select("_f.properties.*", geo.from_geojson(F.col("_f.geometry")).alias("geom"))


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table."""
    return spark.read.parquet(path)


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """Text files as (path, value), one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    """Files as (path, length, sha256, content)."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select("path", "length", F.sha2("content", 256).alias("sha256"), "content")
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def optional_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame | None:
    """A table that may not have been produced: an empty typed frame, or None
    when no schema is given, so that callers narrow their result."""
    if exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema) if schema is not None else None
