"""Writers. Each one is a single distributed job, however many files result."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.functions import geo


def parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, overwritten; partitioned by columns when given."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def csv(df: DataFrame, path: str) -> None:
    """CSV with a header, overwritten."""
    df.write.mode("overwrite").option("header", True).csv(path)


def json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """JSON Lines, NULL fields written out, optionally one folder per key."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def as_json(columns: Sequence[str | Column]) -> Column:
    """One JSON object per row with its NULL fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def feature(properties: Sequence[str | Column], geom: Column | str, digits: int) -> Column:
    """GeoJSON Feature text with coordinates rounded to ``digits`` and repaired."""
    shape = F.coalesce(geo.to_geojson(geo.snapped(geom, digits)), F.lit("null"))
    return F.concat(
        F.lit('{"type":"Feature","properties":'),
        as_json(properties),
        F.lit(',"geometry":'),
        shape,
        F.lit("}"),
    )


def features(
    df: DataFrame, path: str, *, digits: int, geom: str = "geom", split_by: str | None = None
) -> None:
    """GeoJSON text sequence; ``split_by`` gives one folder per key value.

    A split is one write, see ``keyed_split``.
    """
    properties = [c for c in df.columns if c != geom]
    lines = df.withColumn("_line", feature(properties, geom, digits))
    if split_by is None:
        lines.select(F.col("_line").alias("value")).write.mode("overwrite").text(path)
        return
    keyed_split(lines.select(split_by, F.col("_line").alias("value")), split_by).write.mode(
        "overwrite"
    ).partitionBy(split_by).text(path)


ARRAY = ("[", "]")
COLLECTION = ('{"type":"FeatureCollection","features":[', "]}")


def documents(
    rows: DataFrame,
    path: str,
    *,
    order: Sequence[str],
    split_by: str | None = None,
    ends: tuple[str, str] = ARRAY,
    suffix: str = "json",
) -> int:
    """Whole JSON documents from rows of JSON text (``value``), and their number.

    One file ``path/<key>.<suffix>`` a value of ``split_by``, or one file ``path.<suffix>``.
    A document's rows are sorted into one task and stream through it: head, items, tail,
    without a row or a buffer that holds the document. A document is what one client loads
    at once, so its size is bounded by that, not by the table. Files are renamed into place
    when all are written; a null key gets no document, and a single one without rows is empty.
    """
    spark = rows.sparkSession
    key = split_by or "_document"
    named = rows if split_by else rows.withColumn(key, F.lit("all"))
    place = Window.partitionBy(key).orderBy(*order)
    item = F.concat(
        F.when(F.row_number().over(place) == 1, F.lit(ends[0])).otherwise(F.lit(",")),
        "value",
        F.when(F.lead(F.lit(1)).over(place).isNull(), F.lit(ends[1])).otherwise(F.lit("")),
    )
    beside = f"{path}.{uuid.uuid4().hex}.parts"
    parts = named.where(F.col(key).isNotNull()).select(key, item.alias("value"))
    parts.write.partitionBy(key).option("maxRecordsPerFile", 0).text(beside)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    at = spark._jvm.org.apache.hadoop.fs.Path
    folders = fs.globStatus(at(f"{beside}/{key}=*")) or []
    if split_by:
        fs.mkdirs(at(path))
    done = 0
    for folder in folders:  # one for each document
        name = folder.getPath().getName().partition("=")[2]
        files = [f for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
        if len(files) != 1:
            raise RuntimeError(f"document {name} came in {len(files)} files")
        goal = f"{path}/{name}.{suffix}" if split_by else f"{path}.{suffix}"
        fs.delete(at(goal), False)
        if not fs.rename(files[0].getPath(), at(goal)):
            raise RuntimeError(f"{goal} could not be put in place")
        done += 1
    if not done and not split_by:
        out = fs.create(at(f"{path}.{suffix}"), True)
        out.write("".join(ends).encode())
        out.close()
        done = 1
    fs.delete(at(beside), True)
    return done


def nested_ddl(columns: str) -> str:
    """``a int, b string`` as the fields of a struct type: ``a:int,b:string``."""
    return ",".join(":".join(part.split(None, 1)) for part in columns.split(", "))


def json_documents(
    df: DataFrame, path: str, *, order: Sequence[str], split_by: str | None = None
) -> int:
    """JSON arrays of the rows, NULL fields written out; see ``documents``."""
    lines = df.withColumn("value", as_json(df.columns))
    wanted = dict.fromkeys(c for c in ([split_by] if split_by else []) + [*order])
    return documents(lines.select(*wanted, "value"), path, order=order, split_by=split_by)


def feature_collections(
    df: DataFrame, path: str, *, digits: int, order: Sequence[str], geom: str = "geom", split_by: str | None = None
) -> int:
    """GeoJSON FeatureCollections; see ``documents``."""
    properties = [c for c in df.columns if c != geom]
    lines = df.withColumn("value", feature(properties, geom, digits))
    wanted = dict.fromkeys(([split_by] if split_by else []) + [*order])
    return documents(
        lines.select(*wanted, "value"), path, order=order, split_by=split_by, ends=COLLECTION, suffix="geojson"
    )


def keyed_split(df: DataFrame, key: str) -> DataFrame:
    """Partitioning for a ``partitionBy(key)`` write: few files, no hot task.

    Spark rebalances by measured size: small keys share a task, a key of any size is
    split over as many as it needs.
    """
    return df.hint("rebalance", F.col(key)).sortWithinPartitions(key)


def jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Overwrite a database table but keep its definition, indexes and grants."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, truncate=True, **properties)
        .mode("overwrite")
        .save()
    )
