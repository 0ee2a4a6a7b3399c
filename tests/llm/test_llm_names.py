"""Columns whose names operators use inside, through every operator that keeps columns and every stage."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywell.llm import anchors, ngram_jaccard, pii, suffix_dedup
from tallywell.llm.common import ARROW_LIMIT, BASE, _powers, bounded_batches, buckets, cuts_of, powers, tidied

FOLDER = "/root/testdata/sf0.001"
CLASHING = ("_row", "_w", "places", "_places", "_base", "_added", "_key", "_bucket", "_n", "row", "base", "salt", "hot", "quality", "score",
            "predicted", "held_out", "sequence_id", "class", "root", "Keys")


@pytest.fixture(scope="module")
def named(docs):
    """Every text with its id and what its other columns hold: the id and the place of the column."""
    return docs.select("doc_id", "text", *(F.concat_ws("/", F.lit(i), "doc_id").alias(c) for i, c in enumerate(CLASHING)))


def intact(df):
    return all(getattr(r, c) == "/".join([str(i), *([] if r.doc_id is None else [str(r.doc_id)])])
               for r in df.collect() for i, c in enumerate(CLASHING))


@pytest.mark.parametrize("run", [ngram_jaccard.deduplicate, suffix_dedup.deduplicate, pii.sanitise])
def test_clashing_names(named, docs, run):
    got = run(named).cache()
    assert got.columns == named.columns and intact(got)
    plain = run(docs.select("doc_id", "text"))
    assert sorted(map(repr, got.select("doc_id", "text").collect())) == sorted(map(repr, plain.collect()))


def test_stages_keep_clashing_columns(spark, named):
    docs = named
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == named.columns and intact(docs), name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_no_table_stays_in_the_catalog(spark, docs):
    before = {t.name for t in spark.catalog.listTables()}
    ngram_jaccard.link(docs).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_buckets_of_any_frame(spark):
    df = spark.createDataFrame([(1, "é" * 500), (2, None), (3, "x" * 1000)], "doc_id long, text string")
    twice = df.union(df).join(df.withColumnRenamed("text", "more"), "doc_id")
    assert buckets(df, 0.001, "text") == 2 and buckets(twice, 0.001, "text") == 4
    assert buckets(df.limit(0), 1, "text") == 1 and buckets(df, 1e-9, "text") == 2_000_000


def test_bounds_of_sorted_parts():
    live, cuts = cuts_of(np.array([0, 0, 3, 7, 7, 7]))
    assert live.tolist() == [0, 3, 7] and cuts.tolist() == [0, 2, 3, 6]
    assert cuts_of(np.zeros(0, np.int64))[1].tolist() == [0]


@pytest.mark.parametrize("stretch", [1, 7, 64, 500])
def test_stretches_give_the_same_keys(stretch):
    rnd = np.random.default_rng(3)
    data = rnd.integers(97, 100, 700).astype(np.uint8)
    offsets = np.array([0, 15, 15, 300, 330, 700])

    def keys(found):
        return [(t, first + i, k) for t, first, n, k in zip(*(x.tolist() for x in found), strict=True) for i in range(n)]

    assert keys(anchors.runs(data, offsets, 20, 6, stretch)) == keys(anchors.runs(data, offsets, 20, 6))


def test_arrow_batches_are_bounded_and_smaller_limits_stay(spark):
    before = spark.conf.get(ARROW_LIMIT)
    try:
        for limit, want in (("64m", "16m"), ("2m", "2m")):
            spark.conf.set(ARROW_LIMIT, limit)
            bounded_batches(spark)
            assert spark.conf.get(ARROW_LIMIT) == want
    finally:
        spark.conf.set(ARROW_LIMIT, before)


def test_a_tidied_function_gives_all_batches_and_frees_tables():
    powers(BASE, 10)
    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    assert list(tidied(iter)(iter(batches))) == batches
    assert not _powers
