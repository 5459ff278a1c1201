"""Centroid clustering and whitening against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflens.llm import centroid_clusters, whitening

ODD = [
    (None,), ([None] + [0.5] * 5,), ([float("nan")] * 6,), ([float("inf")] + [0.0] * 5,), ([],), ([0.1] * 5,),
]


def _table(spark, rows):
    """Vectors with columns whose names clash with the operators' own."""
    return spark.createDataFrame(
        [(i, v, "x", -1) for i, v in rows], "vec_id long, embedding array<float>, v string, cluster int"
    ).repartition(5)


def _sound(v, dim):
    return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)


def _clusters(rows, k, rounds, dim, scale, seed):
    """Rows of the report, one vector after another."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if _sound(v, dim)]
    rank = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in rank[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, vs in groups.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    per = {c: sum(d for _, d, e in found if e == c) for c in range(k)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, per[c], total, sha[c]) for i, d, c in found]


@pytest.mark.parametrize("k,rounds", [(5, 3), (1, 1), (7, 0), (400, 2)])
def test_clusters(spark, k, rounds):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(4, 6))
    rows = [(i, [float(x) for x in centre[i % 4] + 0.4 * rng.normal(size=6)]) for i in range(150)]
    rows += [(1000 + i, rows[2][1]) for i in range(75)]  # a third of all rows is one vector
    rows += [rows[5], rows[5], (None, rows[6][1]), (None, None), (-7, [-0.001] * 6), (-8, [0.0, -0.0] * 3)]
    rows += [(3000 + n, v[0]) for n, v in enumerate(ODD)]
    found = centroid_clusters.cluster(_table(spark, rows), k=k, rounds=rounds, dim=6, scale=8, seed="s")
    got = sorted(map(tuple, centroid_clusters.clustering_report(found).collect()), key=repr)
    assert got == sorted(_clusters(rows, k, rounds, 6, 8, "s"), key=repr)


def test_empty_cluster_keeps_its_centroid(spark):
    """Two starting centroids are equal: the later one never gets a vector."""
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [5.0, 0.0]), (3, [9.0, 0.0])]
    found = centroid_clusters.cluster(_table(spark, rows), k=4, dim=2, scale=1)
    ids = sorted([1, 1, 2, 3], key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())
    assert found.centroids == [[{1: 1, 2: 5, 3: 9}[i], 0] for i in ids]
    assert {r.cluster for r in found.rows.where("vec_id = 1").collect()} == {ids.index(1)}


def test_clusters_of_nothing(spark):
    for rows in ([], [(1, None), (2, [0.5])]):
        report = centroid_clusters.clustering_report(centroid_clusters.cluster(_table(spark, rows)))
        assert report.collect() == []
        assert dict(report.dtypes)["cluster"] == "int" and dict(report.dtypes)["distance"] == "bigint"


def test_too_long_for_exact_distances(spark):
    rows = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too long for exact"):
        centroid_clusters.cluster(rows, k=2, dim=2)
    far = spark.createDataFrame([(1, [2.0**29, 0.0]), (2, [-(2.0**29), 0.0])], "vec_id long, embedding array<double>")
    found = centroid_clusters.cluster(far, k=1, rounds=1, dim=2, scale=1)
    assert found.rows.agg(F.sum("distance")).first()[0] == 2**59


def _whole(rows, scale=256):
    sound = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in sound]


def _check_whitening(spark, rows, want_components):
    frame = _table(spark, rows)
    models = whitening.fit(frame)
    got = whitening.whiten(frame, models).collect()
    whole = _whole(rows)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.dim), []).append(r)
    assert {len(v) for _, v in whole} == set(want_components)
    for dim in set(want_components) - {0}:
        distinct = np.array(sorted({tuple(v) for _, v in whole if len(v) == dim}), float).reshape(-1, dim)
        n = len(distinct)
        centred = distinct - distinct.mean(0)
        e, u = np.linalg.eigh(centred.T @ centred / n)
        e, u = e[::-1], u[:, ::-1]
        kept = want_components[dim]
        ids = [i for i, v in whole if len(v) == dim]
        assert sum(len(by_row.get((i, dim), [])) for i in set(ids)) == kept * len(ids)
        if not kept:
            continue
        sums = [sum(int(x) for x in column) for column in distinct.T]
        signs = {}
        for i, v in whole:
            if len(v) != dim or ids.count(i) > 1:
                continue
            found = sorted(by_row[i, dim], key=lambda r: r.component)
            assert [r.component for r in found] == list(range(1, kept + 1))
            for r in found:
                c = r.component - 1
                want = (np.array(v) - distinct.mean(0)) @ u[:, c] / math.sqrt(e[c])
                assert abs(abs(r.whitened) - abs(want)) < 1e-9 * max(1, abs(want))
                if abs(want) > 1e-6:
                    assert signs.setdefault(c, np.sign(r.whitened * want)) == np.sign(r.whitened * want)
                assert r.deviation == sum((n * int(x) - s) ** 2 for x, s in zip(v, sums))
                assert r.n == n and abs(r.explained - e[c] / e.sum()) < 1e-9 and r.identity_error < 1e-9


def test_whitening(spark):
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(6, 6)) @ np.diag([3, 2, 1.2, 0.8, 0.4, 0.1])
    rows = [(i, [float(x) for x in spread @ rng.normal(size=6)]) for i in range(200)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)]  # copies are fitted once
    rows += [rows[3], (-1, [0.0] * 6), (-2, [-0.0] * 6), (None, rows[4][1])]
    rows += [(3000 + n, v[0]) for n, v in enumerate(ODD)]
    _check_whitening(spark, rows, {6: 4, 0: 0, 5: 0})


def test_whitening_apart_by_length_and_without_full_rank(spark):
    rng = np.random.default_rng(6)
    flat = [(i, [float(a), 2.0, float(a), float(b), float(a + b), 0.0]) for i, (a, b) in enumerate(rng.normal(size=(60, 2)))]
    flat = [(i, [v[0], v[1], v[0], v[3], float(np.float32(v[0])) , v[5]]) for i, v in flat]
    narrow = [(100 + i, [float(x) for x in rng.normal(size=3)]) for i in range(30)]
    one = [(200, [1.0, 2.0]), (201, [1.0, 2.0])]
    _check_whitening(spark, flat + narrow + one, {6: 2, 3: 3, 2: 0})


def test_whitening_of_nothing(spark):
    frame = _table(spark, [])
    models = whitening.fit(frame)
    out = whitening.whiten(frame, models)
    assert models == [] and out.collect() == [] and dict(out.dtypes)["deviation"] == "bigint"


def test_large_entries(spark):
    """Exact sums and deviations as far as 64 bits reach, null beyond."""
    big = [float(2**40 + i * 2**20) for i in range(6)] + [1e30]
    frame = spark.createDataFrame([(i, [b, float(i % 3)]) for i, b in enumerate(big)], "vec_id long, embedding array<double>")
    models = whitening.fit(frame, scale=1)
    rows = whitening.whiten(frame, models, scale=1).collect()
    assert models[0].sums[0] == sum(int(b) for b in big)
    assert all(r.deviation is None for r in rows) and all(math.isfinite(r.whitened) for r in rows)
    x, model = np.array([[2.0**31, 1.0], [2.0**31 + 2**29, 0.0]]), whitening.Whitening(2, 1, (0, 0), None, None, 0.0, 0.0)
    assert whitening.deviations(x, model).to_pylist() == [2**62 + 1, (2**31 + 2**29) ** 2]
    assert whitening.deviations(2 * x, model).to_pylist() == [None, None]
    edge = np.array([[3037000499.0, 76.0], [3037000500.0, 0.0]])
    assert whitening.deviations(edge, model).to_pylist() == [3037000499**2 + 76**2, None]


def test_factor_of_gram_matrix():
    """The composed factor has the singular values of the rows, though their condition is past that of one Gram matrix."""
    rng = np.random.default_rng(8)
    left, _ = np.linalg.qr(rng.normal(size=(500, 5)))
    right, _ = np.linalg.qr(rng.normal(size=(5, 5)))
    want = np.array([1.0, 1e-2, 1e-5, 1e-8, 1e-9])
    rows = (left * want) @ right.T
    factors = []
    for _ in range(whitening.PASSES):
        q = whitening.orthogonal_rows(rows, tuple(factors))
        factors.append(whitening.shifted_cholesky(q.T @ q, 500, shifted=not factors))
    r = np.linalg.multi_dot([*factors[::-1], np.eye(5)])
    assert np.allclose(np.linalg.svd(r)[1], want, rtol=1e-6)
    assert np.allclose(q.T @ q, np.eye(5), atol=1e-12)
