"""Training corpus from raw documents: five stages, each over all the stage before kept.

Defined cases of the stages, by the operators they call: a document of null or wordless text
has no known language and goes in the first; null ids, sources and languages are values like
any other; repeated rows stay until the near-duplicate stage, which keeps one; an empty table
stays empty; texts are read whole; extra columns are handed on, whatever their names, until
the last stage, which returns ids, source, tokens and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcella.llm import language, mixing, near_dups, pieces, quality
from parcella.llm.common import table
from parcella.sources.staging import staged

#: Least calibrated probability of the language that a document is kept with.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with enough certainty."""
    columns = docs.columns
    judged = language.predict(docs, language.fit(language.training(docs)), pack=True)
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(
        *(F.col("row")[c].alias(c) for c in columns)
    )


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule, from hosts that pass."""
    return quality.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return near_dups.kept_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document of the mix, held against SentencePiece."""
    return pieces.encode(docs, keep=("doc_id", "source")).select(
        "doc_id", "source", "n_tokens", "ids_crc32", "round_trip", "parity", "ids", "decoded"
    )


STAGES = [
    ("language", identify_language),
    ("quality", apply_quality_rules),
    ("near_dups", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: MinHash, the fitted classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
