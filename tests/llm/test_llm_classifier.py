import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.llm import quality_classifier as qc


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        good = i % 5 != 0
        words = [rnd.choice("red green blue some more plain words here".split()) for _ in range(rnd.randrange(5, 60))]
        rows.append((i, " ".join(words if good else [w.upper() + "!!" for w in words])))
        labels.append((i, int(good)))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))


def test_held_out_accuracy_and_split(labelled):
    docs, labels = labelled
    got = qc.judge(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and np.mean([r.predicted == r.quality for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_labels_of_held_out_rows_teach_nothing(labelled):
    docs, labels = labelled
    other = labels.withColumn("quality", F.when(qc.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in qc.judge(docs, labels).collect()}
    b = {r.doc_id: r.score for r in qc.judge(docs, other).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_odd_rows(docs, rows, nothing, labelled):
    got = qc.judge(docs, labelled[1])
    assert got.count() == len(rows) and got.where("score IS NULL OR predicted IS NULL OR held_out IS NULL").count() == 0
    assert qc.judge(nothing, labelled[1]).count() == 0
    assert {r.score for r in qc.judge(docs, labelled[1].limit(0)).collect()} == {0.5}
    kept = qc.judge(docs, labelled[1], keep_text=True)
    assert set(docs.columns) <= set(kept.columns)


def test_dot_products_match_a_plain_sum():
    s = qc.Settings(bits=10)
    weights = np.random.default_rng(0).normal(size=(1 << 10) + 1)
    data = np.frombuffer(b"One two two!!one two", np.uint8)
    (a, b) = qc.features(data, np.array([0, 12, 20]), s)
    assert len(a[0]) and abs(weights[a[0]] @ a[1] - sum(weights[p] * v for p, v in zip(*a))) < 1e-9
    assert len(b[0]) < len(a[0])


def test_scores_do_not_depend_on_the_layout(labelled):
    docs, labels = labelled
    few = qc.Settings(shard_rows=100)
    found = [{r.doc_id: r.score for r in qc.judge(docs.repartition(n), labels.repartition(n), few).collect()} for n in (1, 3, 7)]
    assert found[0] == found[1] == found[2]


def test_few_labels_are_learnt_by_few_shards(labelled):
    docs, labels = labelled
    got = qc.judge(docs, labels.where("doc_id < 80")).join(labels, "doc_id").where("held_out AND quality = 0").collect()
    assert np.mean([r.predicted == 0 for r in got]) > 0.8
