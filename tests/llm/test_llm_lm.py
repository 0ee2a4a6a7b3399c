import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.llm import lm_scoring
from tallywell.llm.ppm_model import END, MASK, ORDER, START, WIDTH, log_probabilities


def tokens(text):
    return [w for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))] + [None]


def brute(rows, learn):
    base, total = Counter(), 0
    counts = [defaultdict(Counter) for _ in range(ORDER + 1)]
    for (_, text), used in zip(rows, learn):
        if used:
            base.update(tokens(text))
            total += len(tokens(text))
            x = [START] * ORDER + list((text or "").encode()) + [END]
            for i in range(ORDER, len(x)):
                for k in range(ORDER + 1):
                    counts[k][tuple(x[i - k: i])][x[i]] += 1

    def one(context, symbol):
        out, excluded = 0.0, set()
        for k in range(ORDER, -1, -1):
            seen = {s: n for s, n in counts[k].get(tuple(context[ORDER - k:]), {}).items() if s not in excluded}
            if not seen:
                continue
            size = sum(seen.values()) + len(seen)
            if symbol in seen:
                return out + math.log10(seen[symbol] / size)
            out += math.log10(len(seen) / size)
            excluded |= set(seen)
        return out - math.log10(257 - len(excluded))

    for (i, text) in rows:
        words = tokens(text)
        x = [START] * ORDER + list((text or "").encode()) + [END]
        yield (i, len(words), sum(base[w] > 0 for w in words), total,
               sum(math.log10((base[w] + 0.1) / (total + 0.1 * (len(base) + 1))) for w in words),
               sum(one(x[j - ORDER: j], x[j]) for j in range(ORDER, len(x))))


@pytest.mark.parametrize("rule", ["doc_id % 3 != 0", "false"])
def test_against_brute_force(docs, rows, rule):
    rows = [r for r in rows if r[0] != 40]
    learn = [i is not None and rule != "false" and i % 3 != 0 for i, _ in rows]
    got = lm_scoring.score(docs.where("doc_id IS NULL OR doc_id <> 40").withColumn("learn", F.expr(rule)), "learn",
                           lm_scoring.Settings(bucket_mb=0.001)).collect()
    key = lambda r: (repr(r[0]), r[1], round(r[5], 3))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    want = sorted(brute(rows, learn), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-9)


def test_probabilities_of_a_context_add_up():
    rnd = np.random.default_rng(0)
    symbols = rnd.integers(97, 100, 4000)
    code = []
    for i in range(ORDER, len(symbols)):
        c = int(symbols[i])
        for back in range(1, ORDER + 1):
            c |= int(symbols[i - back]) << (WIDTH * (ORDER + 1 - back))
        code.append(c)
    seen, n = np.unique(np.array(code), return_counts=True)
    pairs, inverse = np.unique(((seen >> (WIDTH * ORDER)) << WIDTH) | (seen & MASK), return_inverse=True)
    context = seen[5] >> WIDTH
    every = (context << WIDTH) | np.arange(257)
    asked = np.union1d(seen, every)
    counts = np.zeros(len(asked), np.int64)
    counts[np.searchsorted(asked, seen)] = n
    p = log_probabilities(asked, counts, pairs, np.bincount(inverse, n).astype(np.int64))
    assert abs((10 ** p[np.isin(asked, every)]).sum() - 1) < 1e-9


def test_empty_table(nothing):
    assert lm_scoring.score(nothing.withColumn("learn", F.lit(True)), "learn").count() == 0
