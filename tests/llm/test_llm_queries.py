import pytest

import __spark_entry__ as contract
import corpus_pipeline
from compare import difference, duck
from tallywell.llm import collocations
from tallywell.llm.oracle import ORACLE_SQL
from tallywell.llm.queries import QUERIES
from test_llm_collocations import plain

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLE_SQL) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL and n != "op12_collocations"])
def test_runs_over_whole_tables(spark, name):
    table = "pages" if name.startswith("op9") else "documents"
    n = spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    got = QUERIES[name](spark, FOLDER)
    assert got.count() >= n if name.startswith("op7") else got.count() == n


def test_collocations_of_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text", "lang").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_collocations"](spark, FOLDER).collect())
    assert got and got == plain(rows, collocations.Settings())


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == before, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4]
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.select("doc_id").distinct().count() == counts[-1]


def test_pipeline_of_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
