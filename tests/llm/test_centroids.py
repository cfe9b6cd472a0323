import hashlib

import numpy as np
import pytest

from loanpanel.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in vectors], SCHEMA)


def brute(vectors, k, rounds, dim, scale=64, seed=1):
    """(id, cluster, distance) and the centroids, with Python's own numbers."""
    rows = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in vectors]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [list(v) for _, v in sorted(rows, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        mine = [[] for _ in centres]
        for _, v in rows:
            mine[nearest(v)[1]].append(v)
        centres = [[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(mine, centres)]
    return [(i, *reversed(nearest(v))) for i, v in rows], centres


def check(spark, vectors, dim, **options):
    found = centroids.clustered(frame(spark, vectors), dim=dim, **options).collect()
    expected, centres = brute(vectors, options.get("k", 16), options.get("rounds", 3), dim)
    order = lambda r: (r[0] is None, r)
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in found], key=order) == sorted(expected, key=order)
    long = lambda x: x if x < 2**63 else None
    total = long(sum(d for _, _, d in expected))
    for r in found:
        assert r.inertia == total
        assert r.cluster_inertia == long(sum(d for _, c, d in expected if c == r.cluster))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def random_vectors(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, (rng.standard_normal(dim) * rng.uniform(0.1, 3) + rng.uniform(-2, 2)).tolist()) for i in range(n)]


def test_against_plain_arithmetic(spark):
    check(spark, random_vectors(300, 64), 64)


def test_ties_go_to_the_smaller_number(spark):
    # a grid of few values: many equal distances and equal means
    rng = np.random.default_rng(5)
    check(spark, [(i, (rng.integers(-1, 2, 4) / 64).tolist()) for i in range(200)], 4, k=7)


def test_repeated_rows_and_null_ids(spark):
    vectors = random_vectors(5, 8) + [(None, [0.5] * 8), (None, [0.25] * 8)]
    check(spark, vectors + vectors[:3] * 10, 8, k=4)


def test_fewer_rows_than_centroids(spark):
    check(spark, random_vectors(3, 8), 8)


def test_large_components_are_exact(spark):
    limit = centroids.largest_component(64) // 64
    rng = np.random.default_rng(2)
    vectors = [(i, (limit * rng.choice([-1, 1, 0.999999, 1e-6], 64)).tolist()) for i in range(60)]
    check(spark, vectors, 64, k=5)


@pytest.mark.parametrize(
    "vector", [None, [], [1.0] * 3, [1.0] * 5, [1.0, None, 1.0, 1.0], [float("nan")] * 4, [float("-inf"), 1.0, 1.0, 1.0], [1e300] * 4]
)
def test_rows_that_take_no_part(spark, vector):
    good = random_vectors(6, 4)
    assert centroids.clustered(frame(spark, [*good, (99, vector)]), k=2, dim=4).count() == 6
    alone = centroids.clustered(frame(spark, [(99, vector)]), k=2, dim=4)
    assert alone.count() == 0
    assert alone.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_types_do_not_depend_on_rows(spark):
    some = centroids.clustered(frame(spark, random_vectors(6, 4)), k=2, dim=4)
    none = centroids.clustered(frame(spark, []), k=2, dim=4)
    assert some.dtypes == none.dtypes


def test_search_passes_centroids_over():
    rng = np.random.default_rng(0)
    search = centroids.Search(rng.integers(-60, 60, (64, 64)) + 40 * np.arange(64)[:, None])
    v = rng.integers(-60, 60, (500, 64)) + 40 * rng.integers(0, 64, 500)[:, None]
    found, distance = search(v)
    all_ = ((v[:, None, :] - search.centroids[np.argsort(search.numbers)][None]) ** 2).sum(2)
    assert (found == all_.argmin(1)).all() and (distance == all_.min(1)).all()
    assert search.measured < 0.1 * 500 * 64
