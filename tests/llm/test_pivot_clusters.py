import hashlib

import numpy as np
import pytest

from demandloom.llm import pivot_clusters as pc
from demandloom.llm._vectors import largest_component

NAN, INF = float("nan"), float("inf")


def brute(kept, dims, centroids, rounds, factor, seed=2):
    """kept: (key, vector) of usable rows."""
    vectors = [[int(np.floor(factor * float(x))) for x in v] for _, v in kept]
    order = sorted(range(len(kept)), key=lambda i: (
        kept[i][0] is None, hashlib.sha256(f"{seed}:{kept[i][0]}".encode()).hexdigest(), kept[i][1]))
    centres = [vectors[i] for i in order[:centroids]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        found = [nearest(v)[0] for v in vectors]
        for c in set(found):
            mine = [v for v, f in zip(vectors, found, strict=True) if f == c]
            centres[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return [(k, *nearest(v)) for (k, _), v in zip(kept, vectors, strict=True)], centres


def test_bounds_are_never_above_the_distance():
    rng = np.random.default_rng(1)
    for scale in (1, 300, largest_component(8)):
        vectors = rng.integers(-scale, scale + 1, (400, 8))
        centres = rng.integers(-scale, scale + 1, (30, 8))
        centres[:5] = vectors[:5]
        pivots = pc.choose_pivots(centres)
        bounds = pivots.lower_bounds(pivots.distances(vectors), pivots.distances(centres))
        true = [[sum(int(d) ** 2 for d in v - c) for c in centres] for v in vectors]
        assert all(b * b <= t for row, found in zip(true, bounds.tolist(), strict=True)
                   for t, b in zip(row, found, strict=True))


def test_nearest_with_ties_goes_to_the_smaller_number():
    vectors = np.array([[0, 0], [4, 0], [2, 0], [2, 2]])
    centres = np.array([[9, 9], [4, 0], [0, 0], [4, 0], [0, 0]])
    pivots = pc.choose_pivots(centres)
    best, apart, _ = pc.nearest_centroids(vectors, pivots.distances(vectors), centres, pivots)
    assert best.tolist() == [2, 1, 1, 1] and apart.tolist() == [0, 0, 4, 8]


def test_most_distances_of_clustered_vectors_are_not_computed():
    rng = np.random.default_rng(2)
    centres = rng.integers(-2000, 2000, (40, 64))
    vectors = centres[rng.integers(0, 40, 3000)] + rng.integers(-40, 41, (3000, 64))
    pivots = pc.choose_pivots(centres)
    best, apart, computed = pc.nearest_centroids(vectors, pivots.distances(vectors), centres, pivots)
    every = ((vectors[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (apart == every.min(axis=1)).all()
    assert computed < 0.3 * every.size


def table_of(spark, listed):
    return spark.createDataFrame([(k, v, 1, "x", 2.0) for k, v in listed],
                                 "vec_id long, embedding array<float>, cluster int, _v string, distance double")


def test_tables(spark, rows):
    rng = np.random.default_rng(3)
    listed = [(i, rng.normal(0, 0.3, 4).astype("f4").tolist()) for i in range(60)]
    listed += [(i, [0.25, 0.5, -0.5, 0.0]) for i in range(60, 80)]
    listed += [(5, listed[5][1]), (5, listed[6][1]), (None, listed[7][1])]
    bad = [(90, None), (91, []), (92, [0.1] * 3), (93, [0.1] * 5), (94, [0.1, None, 0.1, 0.1]),
           (95, [0.1, NAN, 0.1, 0.1]), (96, [0.1, INF, 0.1, 0.1]), (97, [-INF] * 4)]
    kept = [(k, [float(np.float32(x)) for x in v]) for k, v in listed]
    found, centres = pc.cluster(table_of(spark, listed + bad).repartition(5), dims=4, centroids=7, rounds=4)
    expected, expected_centres = brute(kept, 4, 7, 4, pc.FACTOR)
    assert rows(found) == sorted(expected, key=repr)
    assert centres.tolist() == expected_centres
    made = pc.inertia_table(table_of(spark, listed + bad), dims=4, centroids=7, rounds=4).collect()
    assert {r["inertia"] for r in made} == {sum(d for _, _, d in expected)}
    for r in made:
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == r["cluster"])
        listed_centre = ",".join(map(str, expected_centres[r["cluster"]]))
        assert r["centroid_sha256"] == hashlib.sha256(listed_centre.encode()).hexdigest()


def test_few_equal_or_no_vectors(spark, rows):
    one = [(i, [0.5, -0.5]) for i in range(3)]
    found, centres = pc.cluster(table_of(spark, one), dims=2)
    assert rows(found) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)] and len(centres) == 3
    none = table_of(spark, [(1, None), (2, [1.0])])
    assert pc.inertia_table(none, dims=2).collect() == []
    assert pc.inertia_table(none.limit(0), dims=2).collect() == []


def test_components_without_an_exact_distance_are_an_error(spark):
    with pytest.raises(OverflowError, match="exact distance"):
        pc.cluster(table_of(spark, [(1, [1e30, 0.0])]), dims=2)
