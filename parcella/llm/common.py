"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, lengthened until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem
