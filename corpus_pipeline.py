"""From raw documents to token ids, in stages that each write what they keep.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
what it keeps of ``docs``, in the same columns (the last one: token ids). ``run``
writes every result below the cluster's checkpoint folder and goes on from there, so a
lost executor costs no more than a part of one stage.

The stages set the session's ``spark.sql.execution.arrow.maxRecordsPerBatch``.

Rows that are null or empty, repeated, without id or with columns of their own are
treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardlens.llm import jaccard_join, language_id, mixing, quality, sentencepiece_codec
from cardlens.llm.tables import table
from cardlens.sources.scratch import store

# Documents can be long: rows that an executor and its Python worker hold at once.
BATCH_ROWS = 1_000


def _short_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and texts that are like no language with some certainty, go."""
    _short_batches(spark)
    return language_id.language_stage(docs)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half go; learns from ``labels`` of ids that are still there."""
    _short_batches(spark)
    return quality.quality_stage(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, the one with the smallest id stays."""
    return jaccard_join.jaccard_stage(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, none to three times."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    _short_batches(spark)
    return sentencepiece_codec.sentencepiece_stage(docs, sentencepiece_codec.default_model_path(spark))


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]

# SQL has no support vector machines, boosted tables or piece models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
