import hashlib
import random

import numpy as np
import pytest

from tableferry.llm.centroids import cluster


def by_hand(rows, dims, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    place = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"3:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (place(r[0]), r[1]))[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    placed = [(i, *nearest(v)) for i, v in kept]
    sums = {}
    for _, d, n in placed:
        sums[n] = sums.get(n, 0) + d
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return [(-1 if i is None else i, n, d, sums[n], sum(sums.values()), digest(centroids[n])) for i, d, n in placed]


@pytest.mark.parametrize(("n", "dims", "rounds"), [(5, 3, 10), (120, 3, 10), (120, 64, 2)])
def test_against_a_plain_loop(spark, n, dims, rounds):
    draw = random.Random(n + dims)
    rows = [(i, [draw.choice([-0.7, -0.1, 0.0, 0.001, 0.3, draw.uniform(-1, 1)]) for _ in range(dims)]) for i in range(n)]
    rows += [rows[0], (3, rows[1][1]), (None, rows[2][1]), (900, None), (901, [None] * dims), (902, [float("nan")] * dims), (903, [float("-inf")] * dims), (904, [0.1] * (dims + 1)), (905, [])]
    frame = spark.createDataFrame([(i, v, 5) for i, v in rows], "vec_id long, embedding array<double>, cluster int")
    got = cluster(spark, frame, dims=dims, rounds=rounds)
    found = [(-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got.collect()]
    assert sorted(found) == sorted(by_hand(rows, dims, rounds=rounds))


def test_all_alike_and_none(spark):
    kinds = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(i, [0.5, -0.5]) for i in range(20)], kinds)
    assert {(r.cluster, r.distance, r.inertia) for r in cluster(spark, same, dims=2).collect()} == {(0, 0, 0)}
    empty = cluster(spark, spark.createDataFrame([], kinds))
    assert empty.count() == 0 and empty.schema.simpleString() == cluster(spark, same, dims=2).schema.simpleString()
    with pytest.raises(ValueError, match="beyond a long"):
        cluster(spark, spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), dims=2)


def test_work_stays_in_the_jvm(spark, capsys):
    from tableferry.llm.centroids import assign

    rows = spark.range(3).selectExpr("array(id, id + 1) v", "id * id + (id + 1) * (id + 1) own")
    assign(rows, [[0, 0], [1, 1]]).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "zip_with" in plan and "array_min" in plan
