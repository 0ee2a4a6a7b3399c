import math
import re
from collections import Counter


from pyspark.sql import functions as F

from tallywell.llm import quality_rules


def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))
    mark = [0] * len(w)
    for i in range(len(w) - 4):
        if seen[tuple(w[i: i + 5])] > 1:
            mark[i: i + 5] = [1] * 5
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(mark)


def test_counts_against_brute_force(docs, rows):
    got = quality_rules.judge(docs, [0.0] * 64, quality_rules.Settings(buckets=64))
    found = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                    for r in got.collect()), key=repr)
    want = []
    for i, text in rows:
        c = counts(text)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want.append((i, *c, failed, not failed))
    assert found == sorted(want, key=repr)


def test_ratio_tells_a_target_apart(spark):
    good = [(i, f"plain words about nature and music number {i} in rows") for i in range(200)]
    bad = [(i, f"cheap|| pills&& casino%% win## now!! number&& {i} in## rows||") for i in range(200, 260)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 200, 2)] + [(None,), (4,)], "doc_id long")
    got = quality_rules.judge(docs, quality_rules.fit(docs, trusted))
    assert got.where("kept <> (doc_id < 200)").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_every_trusted_document_counts(spark):
    s = quality_rules.Settings(buckets=64)
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word number"), "id", F.lit(" end")).alias("text"))
    raw = [0] * s.buckets
    for r in docs.select(quality_rules.words_of(F.col("text")).alias("w")).select(
            F.explode(quality_rules._grams("w", s.buckets)).alias("b")).groupBy("b").count().collect():
        raw[r.b] = r["count"]
    weight = s.smoothing * s.buckets
    size = sum(raw) + weight
    want = [math.log((r + weight * (r + s.smoothing) / size) / (r + s.smoothing)) for r in raw]
    assert all(abs(a - b) < 1e-9 for a, b in zip(quality_rules.fit(docs, docs, s), want, strict=True))


def test_empty_inputs(docs, nothing, rows):
    s = quality_rules.Settings()
    assert quality_rules.judge(nothing, quality_rules.fit(nothing, nothing)).count() == 0
    ratios = quality_rules.fit(docs, nothing)
    assert set(ratios) == {0.0} and quality_rules.judge(docs, ratios, s).count() == len(rows)
