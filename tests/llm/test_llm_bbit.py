"""b-bit MinHash links against all pairs compared by whole sets."""

import random
import re

import numpy as np
import pytest
from fixtures import as_rows, frame

from tallywell.llm import bbit_minhash as bm
from tallywell.llm.common import U, stream


def shingles(text, size=5):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i: i + size]) for i in range(len(words) - size + 1))


def plain(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(top(i), []).append(rows[i][0])
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [x for x in members[top(i)] if x is not None]
        name = min(ids, default=None)
        out.append((key, len(sets[i]), name, key == name))
    return sorted(out, key=repr)


def got(spark, rows, settings=bm.Settings()):
    return as_rows(bm.link(frame(spark, rows), settings), "doc_id", "n_shingles", "component_id", "kept")


def near_copies(n, edits, seed=5, size=150):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(size)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            own[rnd.randrange(size)] = f"x{rnd.randrange(10**6)}"
        out.append((i, " ".join(own)))
    return out


def test_links_equal_all_pairs(spark, rows):
    assert got(spark, rows) == plain(rows)


@pytest.mark.parametrize("block", [8, 1024])
def test_group_of_near_copies_around_the_threshold(spark, block):
    rows = near_copies(160, 6) + near_copies(60, 3, seed=9, size=700)
    assert got(spark, rows, bm.Settings(block=block, run=16)) == plain(rows)


def test_no_star_reaches_a_chain(spark):
    """Each text differs a little from the one before it, so that the ends of the chain are far apart."""
    rnd = random.Random(3)
    text, rows = [f"w{rnd.randrange(5000)}" for _ in range(120)], []
    for i in range(60):
        rows.append((i, " ".join(text)))
        text[(i * 7) % 120] = f"y{i}"
    assert got(spark, rows) == plain(rows)


def test_empty_table_and_no_words(spark, nothing):
    assert bm.link(nothing).collect() == []
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, ""), (4, "a"), (5, "A")]
    assert got(spark, rows) == plain_blank(rows)


def plain_blank(rows):
    return sorted(((i, 0, i, True) if not (t or "").strip() else (i, 1, 4, i == 4) for i, t in rows), key=repr)


def test_estimate_is_near_the_similarity():
    s, rng = bm.Settings(), np.random.default_rng(2)
    for share in (0.5, 0.85, 0.95):
        errors = []
        for _ in range(40):
            both = int(1000 * share)
            a = rng.integers(0, 1 << 63, both).astype(U)
            more = [rng.integers(0, 1 << 63, (1000 - both) // 2).astype(U) for _ in range(2)]
            sets = [np.concatenate([a, m]) for m in more]
            found = bm.minima(np.concatenate(sets), np.array([0, len(sets[0])]), s)
            marks = bm.signatures(found, s)
            errors.append(bm.similarity(bm.equal_minima(marks[0], marks[1], s), s) - share)
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.2


def test_profiles_never_exceed_the_difference():
    s, grams = bm.Settings(profile_bits=256), stream(4000, 1)
    for n in (10, 60, 200):
        a, b = grams[:200], grams[n: 200 + n]
        x, y = bm.parity(a, s), bm.parity(b, s)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
    wide = bm.parity(grams, bm.Settings())
    assert len(wide) == 256 and (bm.fold(wide[None, :], 4)[0] == bm.parity(grams, s)).all()
