"""K-means with bounds against the plain algorithm in whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException

from marlstone.llm import hamerly

SCHEMA = "vec_id bigint, embedding array<float>, cluster int, distance string"


def plain(rows, k, rounds, size, scale=256):
    """Assignments and centroids in Python's integers."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(range(len(kept)), key=lambda j: (hashlib.sha256(f"2:{'null' if kept[j][0] is None else kept[j][0]}".encode()).hexdigest(), kept[j][1]))
    centroids = [kept[j][1] for j in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for n in range(rounds + 1):
        of = [min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c)) for _, v in kept]
        if n < rounds:
            groups = [[v for (_, v), o in zip(kept, of, strict=True) if o == c] for c in range(len(centroids))]
            centroids = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centroids, strict=True)]
    return [(i, o, far(v, centroids[o])) for (i, v), o in zip(kept, of, strict=True)], centroids


@pytest.mark.parametrize("seed, k, spread", [(1, 5, 1.0), (2, 12, 0.02), (3, 40, 0.2), (4, 300, 1.0)])
def test_clusters(spark, seed, k, spread):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(6, 8))
    rows = [(i, [float(x) for x in (middles[i % 6] + spread * r.normal(size=8)).astype(np.float32)]) for i in range(250)]
    rows += [(7, rows[7][1])] * 40 + [(None, rows[3][1]), (900, None), (901, [1.0] * 7), (902, [1.0] * 7 + [None]), (903, [float("nan")] * 8), (904, [float("inf")] * 8), (905, []), (906, [0.0] * 8), (907, [0.0] * 8)]
    df = spark.createDataFrame([(*x, 1, "clash") for x in rows], SCHEMA).repartition(5)
    got = hamerly.clusters(df, k=k, rounds=5, size=8).collect()
    want, centroids = plain(rows, k, 5, 8)
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((x.vec_id, x.cluster, x.distance) for x in got), key=key) == sorted(want, key=key)
    for x in got:
        assert x.cluster_inertia == sum(d for _, c, d in want if c == x.cluster) and x.inertia == sum(d for _, _, d in want)
        assert x.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[x.cluster])).encode()).hexdigest()


def test_bounds_spare_scans():
    """After a round of small moves few vectors are held against all centroids, and none wrongly."""
    r = np.random.default_rng(5)
    middles = r.integers(-2000, 2000, (20, 16))
    v = np.repeat(middles, 100, axis=0) + r.integers(-40, 40, (2000, 16))
    cluster, upper, lower, scanned = hamerly.Bounds(middles, None).assign(v, np.full(2000, -1), np.zeros(2000), np.zeros(2000))
    assert scanned == 2000
    before = middles
    for _ in range(6):
        after = before + r.integers(-5, 6, before.shape)
        cluster, upper, lower, scanned = hamerly.Bounds(after, before).assign(v, cluster, upper, lower)
        assert scanned < 100 and (cluster == hamerly.distances(v, after).argmin(axis=1)).all()
        before = after


def test_empty_and_large(spark):
    df = spark.createDataFrame([(1, [1e9] * 64, 0, "")], SCHEMA)
    assert hamerly.clusters(df.limit(0)).count() == 0
    assert hamerly.clusters(df.selectExpr("vec_id", "cast(null as array<float>) embedding")).count() == 0
    with pytest.raises(SparkRuntimeException):
        hamerly.clusters(df).collect()
