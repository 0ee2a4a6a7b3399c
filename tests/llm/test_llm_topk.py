import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.llm import exact_topk


def brute(rows, k=5):
    sound = {}
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in good if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 8192])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(exact_topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", max(2, block // 3))
    rnd = random.Random(3)
    rows = [(i, [round(rnd.gauss(0, 1), 1) * rnd.randrange(2) for _ in range(6)]) for i in range(320)]
    rows += [(400, [0.0] * 6), (401, [1.0] * 6), (401, [1.0] * 6), (450, [1.0] * 6), (450, [1.0] * 6), (500, None), (550, [None] * 6),
             (600, [float("nan")] * 6), (650, [float("inf")] * 6), (None, [1.0] * 6), (700, [2.0]), (750, [])]
    df = spark.createDataFrame([(i, v, "c", "b") for i, v in rows], "vec_id long, embedding array<float>, c string, h string")
    got = sorted(tuple(r) for r in exact_topk.search(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])


def test_empty_and_lonely(spark):
    schema = "vec_id long, embedding array<float>"
    assert exact_topk.search(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    assert exact_topk.search(spark.createDataFrame([(50, [1.0])], schema), F.lit(True)).count() == 0
    two = spark.createDataFrame([(50, [1.0]), (51, [0.5])], schema)
    assert [tuple(r) for r in exact_topk.search(two, F.col("vec_id") == 50).collect()] == [(50, 1, 51, 32768)]
