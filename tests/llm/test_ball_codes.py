import hashlib

import numpy as np
import pytest

from demandloom.llm import ball_codes as bc

NAN, INF = float("nan"), float("inf")


def brute(kept, parts, entries, rounds, factor):
    """kept: (key, vector) of usable rows; codes and errors in their order, and the codebooks."""
    width = len(kept[0][1]) // parts
    cut = [[[int(np.floor(factor * float(x))) for x in v[p * width:(p + 1) * width]] for p in range(parts)]
           for _, v in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        found = [[nearest(p, row[p])[0] for p in range(parts)] for row in cut]
        new = [[list(e) for e in book] for book in books]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [row[p] for row, f in zip(cut, found, strict=True) if f[p] == e]
                if mine:
                    new[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
        books = new
    coded = [[nearest(p, row[p]) for p in range(parts)] for row in cut]
    return ["".join(f"{e:02x}" for e, _ in row) for row in coded], [sum(d for _, d in row) for row in coded], books


def test_nearest_from_any_home():
    rng = np.random.default_rng(1)
    entries = rng.integers(-900, 900, (16, 8))
    entries[3] = entries[9]
    parts = np.concatenate([rng.integers(-900, 900, (500, 8)), entries, (entries[:8] + entries[8:]) // 2])
    every = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for home in (np.zeros(len(parts), np.int64), rng.integers(0, 16, len(parts)), every.argmin(axis=1)):
        inside = ((parts - entries[home]) ** 2).sum(axis=1)
        radii = [bc.radius_above(int(inside[home == e].max(initial=0)), 0) for e in range(16)]
        for balls in (bc.balls_of(entries), bc.balls_of(entries, radii)):
            best, least, _ = bc.nearest_entries(parts, home, balls)
            assert (best == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all()


def test_stable_cores_skip_their_parts():
    rng = np.random.default_rng(2)
    entries = rng.integers(-4000, 4000, (16, 8))
    home = rng.integers(0, 16, 4000)
    parts = entries[home] + rng.integers(-60, 61, (4000, 8))
    inside = ((parts - entries[home]) ** 2).sum(axis=1)
    radii = [bc.radius_above(int(inside[home == e].max()), 0) for e in range(16)]
    best, _, computed = bc.nearest_entries(parts, home, bc.balls_of(entries, radii))
    assert (best == home).all() and computed < 1.2 * len(parts)


def test_radius_holds_after_a_move():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, old, new = rng.integers(-50, 50, (3, 4))
        r = bc.radius_above(int(((x - old) ** 2).sum()), int(((old - new) ** 2).sum()))
        assert ((x - new) ** 2).sum() <= r * r


def table_of(spark, listed):
    return spark.createDataFrame([(k, v, i, 1, "x", b"") for k, v, i in listed],
                                 "vec_id long, embedding array<float>, label int, error int, code string, v binary")


def test_tables(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(0, 0.4, 8).astype("f4").tolist(), i % 3) for i in range(70)]
    vectors += [(100 + i, [0.25, -0.5] * 4, None) for i in range(20)]
    vectors += [(3, vectors[3][1], 1), (3, vectors[4][1], 1), (None, vectors[5][1], None)]
    bad = [(200, None, 0), (201, [0.1, None] * 4, 0), (202, [NAN] * 8, 0), (203, [INF] + [0.0] * 7, None),
           (204, [], 1), (205, [1.0] * 16, 1)]
    kept = [(k, [float(np.float32(x)) for x in v]) for k, v, _ in vectors]
    codes, errors, books = brute(kept, 4, 5, 6, bc.FACTOR)
    made = bc.code_table(table_of(spark, vectors + bad).repartition(5), parts=4, entries=5)
    by_label = {}
    for (_, _, label), error in zip(vectors, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(
        str(x) for book in books for e in book for x in e).encode()).hexdigest()
    expected = sorted(((k, c, e, by_label[label], digest) for (k, _, label), c, e in
                       zip(vectors, codes, errors, strict=True)), key=repr)
    assert made.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in made.collect()), key=repr) == expected


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(0, 0.01, 8).astype("f4").tolist(), 0) for i in range(16)]
    found, books = bc.compress(table_of(spark, vectors))
    for r in found.collect():
        assert np.abs(bc.decode(bytes(r["codes"]), books) - vectors[r["vec_id"]][1]).max() <= 1 / bc.FACTOR


def test_few_or_no_vectors(spark, rows):
    none = table_of(spark, [(1, None, 1), (2, [], None)])
    assert bc.code_table(none).collect() == bc.code_table(none.limit(0)).collect() == []
    two = bc.code_table(table_of(spark, [(1, [0.5] * 8, 1), (2, [-0.5] * 8, None)]))
    assert rows(two, "vec_id", "code", "error", "label_error") == [(1, "00" * 8, 0, 0), (2, "01" * 8, 0, 0)]
    with pytest.raises(ValueError, match="equal parts"):
        bc.code_table(table_of(spark, [(1, [0.5] * 7, 1)]))
    with pytest.raises(OverflowError, match="exact distance"):
        bc.code_table(table_of(spark, [(1, [1e30] * 8, 1)]))
