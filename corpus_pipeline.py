"""Clean a corpus and pack it: five stages, each over all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm import ngram_jaccard, packing, pii, quality_classifier, suffix_dedup
from tallywell.llm.common import bounded_batches, settled, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: SQL can express neither the training of the classifier nor the packing.
ORACLE_SQL: str | None = None


def _stage(make: Stage) -> Stage:
    """``make`` with Arrow batches of bounded size in the session, whose executors run all stages."""

    @wraps(make)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return make(spark, docs, sf_dir)

    return bounded


def _counted(docs: DataFrame) -> DataFrame:
    """With ``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    judged = quality_classifier.judge(docs, labels, keep_text=True)
    return judged.where("predicted = 1").select(*docs.columns)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, that with the smallest id."""
    return ngram_jaccard.deduplicate(docs)


@_stage
def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stretches of at least 200 bytes that stand anywhere else go; documents stay."""
    return _counted(suffix_dedup.deduplicate(docs))


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it become labels."""
    return _counted(pii.sanitise(docs))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_bytes),
    ("PII", personal_data), ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
