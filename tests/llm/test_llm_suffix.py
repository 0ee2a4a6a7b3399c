import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallywell.llm import suffix_dedup
from tallywell.llm.suffix_array import Shard


def brute(rows, length):
    seen = Counter()
    for _, text in rows:
        b = (text or "").encode()
        seen.update(b[i: i + length] for i in range(len(b) - length + 1))
    out = []
    for i, text in rows:
        b = (text or "").encode()
        mark = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j: j + length]] > 1:
                mark[j: j + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark) if not m)
        spans = sum(mark[j] and (j == 0 or not mark[j - 1]) for j in range(len(mark)))
        out.append((i, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot, size", [(16_000, 3 << 20), (2, 500)])
def test_against_brute_force(docs, rows, hot, size):
    s = suffix_dedup.Settings(hot=hot, shard_bytes=size)
    got = sorted((tuple(r) for r in suffix_dedup.report(docs, s).collect()), key=repr)
    assert got == [r[:5] for r in brute(rows, 200)]


def test_texts_are_cut(docs, rows):
    got = suffix_dedup.deduplicate(docs)
    assert got.columns == docs.columns
    want = Counter((i, kept.decode("utf-8", "ignore") if removed else kept.decode()) for i, _, removed, _, _, kept in brute(rows, 200))
    assert Counter((r.doc_id, r.text or "") for r in got.collect()) == want


def test_repeats_in_one_text(spark):
    rnd = random.Random(5)
    part = "".join(rnd.choice("abc ") for _ in range(230))
    rows = [(1, part + "x" + part), (2, "y" * 199), (3, "z" * 200), (4, "z" * 199 + "q"), (5, "w" * 201), (6, "pq" * 101)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (460, 2), 2: (0, 0), 3: (0, 0), 4: (0, 0), 5: (201, 1), 6: (202, 1)}


def test_a_passage_of_all_texts_is_joined_once_a_chunk(spark):
    rnd = random.Random(6)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage, s = text(300), suffix_dedup.Settings(hot=50)
    rows = [(i, text(rnd.randrange(5, 90)) + passage + text(rnd.randrange(5, 90))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    keyed = suffix_dedup._with_row(docs, "doc_id", "text", "row").select("row", "text")
    marked = suffix_dedup._marked(keyed, suffix_dedup._repeated_keys(keyed, 2, s), s)
    found = suffix_dedup._occurrences(marked, s, None).collect()
    often = Counter((x.key, x.same) for r in found for x in r.stretches)
    assert max(often.values()) <= len(found) < 20
    got = sorted((tuple(r) for r in suffix_dedup.report(docs, s).collect()), key=repr)
    assert got == [r[:5] for r in brute(rows, 200)]


def test_spans_are_merged_by_row():
    places = np.array([(7, 0, 0), (7, 10, 1), (5, 3, 0), (7, 400, 0), (5, 0, 2), (9, 0, 3)], suffix_dedup.PLACE)
    ranges = pa.array([[0, 1, 4, 6], [0, 2], []], pa.list_(pa.int32()))
    got = suffix_dedup.merged(places, np.array([0, 1, 3]), ranges, 5)
    assert [tuple(x) for x in np.stack(got, 1).tolist()] == [(5, 3, 13), (7, 0, 16), (7, 400, 410)]


def test_empty_table(nothing):
    assert suffix_dedup.report(nothing).count() == 0 and suffix_dedup.deduplicate(nothing).count() == 0


@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_suffix_arrays_against_sorting(kind):
    rnd = np.random.default_rng(1)
    for _ in range(60):
        parts = []
        for _ in range(rnd.integers(1, 8)):
            parts += [rnd.integers(1, rnd.integers(2, 5), rnd.integers(1, 25)).astype(kind) * (64 if kind is np.uint16 else 1), np.zeros(1, kind)]
        t = np.concatenate(parts)
        ends = np.flatnonzero(t == 0)
        end = [int(ends[np.searchsorted(ends, i)]) for i in range(len(t))]
        want = sorted(range(len(t)), key=lambda i: ((*t[i: end[i]].tolist(), -1), end[i]))
        shard = Shard(t)
        order = shard.order()
        assert order.tolist() == want
        common = shard.common(order)
        for a, b, n in zip(want[:-1], want[1:], common[1:].tolist()):
            x, y = t[a: end[a]].tolist(), t[b: end[b]].tolist()
            assert n == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
