"""Training-data pipeline over ``documents``: five stages, each one operator.

``STAGES`` lists ``(name, function)``; every function takes ``(spark, docs,
sf_dir)`` and returns a frame that is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventtrails.llm import shared
from eventtrails.llm.exact_dedup import drop_exact_duplicates
from eventtrails.llm.ngram_join import drop_near_duplicates
from eventtrails.llm.quality import keep_quality
from eventtrails.llm.sentencepiece_codec import encode_documents
from eventtrails.llm.source_mix import mixed_documents


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (0.8 or more) one stays."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3, at most three times each; repeats are rows."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document of the mix."""
    return encode_documents(docs)


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", exact_dedup),
    ("near duplicates", near_dedup),
    ("mix sources", mix),
    ("encode", encode),
]

#: Three stages (classifier, near duplicates, encoding) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = shared.table(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
