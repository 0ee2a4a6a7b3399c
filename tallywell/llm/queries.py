"""Queries of this package over the test tables, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm import (
    bbit_minhash,
    bitplane_clusters,
    collocations,
    exact_topk,
    lm_scoring,
    ngram_jaccard,
    packing,
    pieces,
    pii,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    url_rules,
)
from tallywell.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


@query("op1_quality_classifier")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_classifier.judge(docs, table(spark, folder, "labels").select("doc_id", "quality"))


@query("op2_pii")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_exact_topk")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return exact_topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op4_lm_scoring")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn(
        "learn", F.crc32(F.col("doc_id").cast("string")) % 10 != 0)
    return lm_scoring.score(docs, "learn").select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op5_quality_rules")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    trusted = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return quality_rules.judge(docs, quality_rules.fit(docs, trusted))


@query("op6_ngram_jaccard")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard.link(table(spark, folder, "documents").select("doc_id", "text"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.report(table(spark, folder, "documents").select("doc_id", "text"))


@query("op9_url_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(table(spark, folder, "pages").select("page_id", "url"))


@query("op10_sentencepiece")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest(table(spark, folder, "documents").select("doc_id", "text"))


@query("op11_bbit_minhash")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return bbit_minhash.link(table(spark, folder, "documents").select("doc_id", "text"))


@query("op12_collocations")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents").select("text", "lang"))


@query("op13_bitplane_clusters")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return bitplane_clusters.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))
