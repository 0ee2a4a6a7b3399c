"""Clustering on bit planes against plain whole-number arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest

from tallywell.llm import bitplane_clusters as bp

SCHEMA = "vec_id long, embedding array<float>, id string, packed string, numbers string, cluster string, distance string, n string"
EXTRA = ("a", "b", "c", "d", "e", "f")


def plain(rows, settings=bp.Settings()):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha) as the definition says, slowly."""
    kept = [(i, [math.floor(settings.scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{settings.seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in order[: settings.clusters]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), k) for k, c in enumerate(centres))

    for _ in range(settings.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, members in groups.items():
            centres[k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, k, d in placed:
        inertia[k] = inertia.get(k, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), sha[k]) for i, k, d in placed), key=repr)


def made(n, seed=0, spread=1.0):
    rnd = random.Random(seed)
    return [(i, [rnd.uniform(-spread, spread) for _ in range(64)]) for i in range(n)]


def got(spark, rows, settings=bp.Settings()):
    df = spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], SCHEMA).repartition(3)
    out = bp.cluster(df, settings)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_planes_give_exact_dots_sums_and_norms():
    rng = np.random.default_rng(1)
    for top in (1, 3, 64, 1000, bp.LARGEST):
        a, b = rng.integers(-top, top, (7, 64)), rng.integers(-top, top, (5, 64))
        planes = int(top).bit_length() + 1
        x, y = bp.to_planes(a, planes), bp.to_planes(b, planes)
        assert (bp.dots(x, y) == a @ b.T).all()
        assert (bp.norms(x) == (a * a).sum(1)).all()
        assert (bp.sums(x) == a.sum(0)).all()


@pytest.mark.parametrize("spread", [0.02, 1.0, 500.0])
def test_clusters_equal_plain_arithmetic(spark, spread):
    rows = made(120, spread=spread)
    assert got(spark, rows) == plain(rows)


def test_odd_vectors(spark):
    good = made(30, 3)
    same = [(100 + i, good[0][1]) for i in range(20)] + [good[1], good[1], (None, good[2][1])]
    bad = [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63),
           (205, [float("nan")] + [1.0] * 63), (206, [float("inf")] * 64), (207, [float("-inf")] + [0.0] * 63)]
    rows = good + same + bad
    assert got(spark, rows) == plain(rows)


def test_few_equal_and_no_vectors(spark):
    few = made(5, 4)
    assert got(spark, few) == plain(few)
    zeros = [(i, [0.0] * 64) for i in range(40)]
    assert got(spark, zeros) == plain(zeros)
    assert got(spark, []) == []
    assert got(spark, [(None, [0.5] * 64)]) == []


def test_values_beyond_the_bound_are_held_at_it(spark):
    rows = [(1, [1e30] * 64), (2, [-1e30] * 64), (3, [0.0] * 64)]
    found = got(spark, rows, bp.Settings(clusters=1, rounds=0))
    assert all(r[2] >= 0 for r in found) and len(found) == 3
