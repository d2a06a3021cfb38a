import hashlib
import math
import random

import numpy as np
import pytest

from paralane.llm.vector_codes import Bounds, vector_codes

COLUMNS = "vec_id long, embedding array<float>, label int, code string, numbers string, part int"


def brute(rows, entries, rounds):
    rows = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in rows), default=0) // 4)
    whole = [[math.floor(1024 * float(np.float32(x))) for x in v] + [0] * (4 * width - len(v)) for _, v, _ in rows]
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, np.array(whole[r], dtype=np.int64).tobytes()))
    parts = [[v[p * width : (p + 1) * width] for v in whole] for p in range(4)]
    books = [[list(parts[p][r]) for r in order[:entries]] for p in range(4)]

    def nearest(p):
        return [min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p])) for x in parts[p]]

    for _ in range(rounds):
        for p in range(4):
            own = nearest(p)
            for i in range(len(books[p])):
                mine = [x for x, (_, j) in zip(parts[p], own) if j == i]
                if mine:
                    books[p][i] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [nearest(p) for p in range(4)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    error = [sum(last[p][r][0] for p in range(4)) for r in range(len(rows))]
    by = {}
    for (_, _, label), e in zip(rows, error):
        by[label] = by.get(label, 0) + e
    return sorted(((i, "".join(f"{last[p][r][1]:02x}" for p in range(4)), error[r], by[label], digest) for r, (i, _, label) in enumerate(rows)), key=str)


def vectors(n, dims, seed, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(9)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", "n", 3) for i, v, label in rows], COLUMNS).repartition(3)


@pytest.mark.parametrize("dims,near,fewest,entries", [(8, 16, 4, 32), (12, 2, 1, 32), (8, 16, 1, 3), (4, 0, 0, 16), (8, 5, 2, 1)])
def test_against_brute_force(spark, dims, near, fewest, entries):
    rows = vectors(300, dims, dims + near)
    found = vector_codes(frame(spark, rows), entries=entries, near=near, fewest=fewest)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, entries, 4)


def test_awkward_vectors(spark):
    rows = vectors(60, 8, 1)
    rows += [(3, rows[3][1], 1), (None, rows[5][1], None), (None, [0.5] * 8, 0), (100, None, 1), (101, [1.0, None] * 4, 1)]
    rows += [(102, [float("nan")] * 8, 1), (103, [float("inf")] * 8, 1), (104, [0.25] * 5, 2), (105, [], 2), (106, [0.0] * 8, 2)]
    assert sorted(map(tuple, vector_codes(frame(spark, rows), entries=16).collect()), key=str) == brute(rows, 16, 4)
    ties = [(i, [float(i % 3)] * 4, 0) for i in range(40)]
    assert sorted(map(tuple, vector_codes(frame(spark, ties), entries=8).collect()), key=str) == brute(ties, 8, 4)
    assert vector_codes(frame(spark, rows).limit(0)).collect() == []
    assert vector_codes(frame(spark, [(1, None, 1)])).collect() == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [x * 90_000 for x in v], label) for i, v, label in vectors(80, 8, 2)]
    assert sorted(map(tuple, vector_codes(frame(spark, rows), entries=16).collect()), key=str) == brute(rows, 16, 4)


def test_bounds_save_distances(spark):
    rows = vectors(2000, 16, 3, spread=0.05)
    computed = []
    vector_codes(frame(spark, rows), entries=64, computed=computed).collect()
    assert len(computed) == 4 and computed[0] == 4 * 64 * 2000
    assert sum(computed[1:]) < 0.5 * 3 * computed[0]


def test_bounds_hold_after_packing():
    rng = np.random.default_rng(0)
    points, entries = rng.integers(-1000, 1000, (200, 4)), rng.integers(-1000, 1000, (30, 4))
    bounds = Bounds.all(points, entries, 6).shortened(4)
    bounds = Bounds.unpacked(bounds.packed(), 4)
    distance = np.sqrt(((points[:, None] - entries[None]) ** 2).sum(axis=2))
    rows = np.arange(len(points))
    assert (bounds.own == distance.argmin(axis=1)).all()
    assert (bounds.upper >= distance[rows, bounds.own]).all()
    assert (bounds.lower <= np.take_along_axis(distance, bounds.near, axis=1)).all()
    rest = distance.copy()
    np.put_along_axis(rest, np.concatenate((bounds.own[:, None], bounds.near), axis=1), np.inf, axis=1)
    assert (bounds.outer <= rest.min(axis=1)).all()
