import math
import random

import numpy as np
import pandas as pd

from paralane.llm.topk import Shard, top_k, whole_numbers

SCHEMA = "vec_id long, embedding array<double>, rank int, score string"


def brute(rows, k, every=100, scale=1024):
    usable = {}
    for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or [])):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, [math.floor(scale * x) for x in v])
    out = []
    for q in usable:
        if q % every == 0:
            products = ((sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)
            scores = sorted((-max(-(2**63), min(2**63 - 1, s)), i) for s, i in products)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows, **options):
    found = top_k(spark.createDataFrame([(i, v, 1, "s") for i, v in rows], SCHEMA), **options)
    return sorted(map(tuple, found.collect()))


def test_search_of_one_shard():
    rng = np.random.default_rng(1)
    for trial in range(60):
        n, terms = int(rng.integers(1, 200)), int(rng.integers(1, 40))
        values = rng.integers(-3, 4, (n, terms)).astype(float) * (rng.random((n, terms)) < 0.4)
        shard = Shard(np.arange(n), values)
        for query_id in (0, n + 5):
            query = rng.integers(-3, 4, terms).astype(float)
            rows, scores = shard.search(query_id, query, 5)
            all_scores = sorted((-float(v @ query), i) for i, v in enumerate(values) if i != query_id)[:5]
            assert [(-s, int(r)) for r, s in zip(rows, scores)] == all_scores


def test_awkward_vectors(spark):
    rows = [
        (0, [0.5, -0.25, 1.0]), (100, [0.1, 0.2, 0.3]), (200, [0.0, 0.0, 0.0]), (1, [0.5, -0.25, 1.0]), (2, [0.5, -0.25, 1.0]),
        (3, None), (4, [None, 1.0, 1.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 0.0, 0.0]), (7, []), (8, [1.0]),
        (None, [1.0, 1.0, 1.0]), (300, None), (9, [0.1, 0.1, 0.1]), (9, [0.9, 0.9, 0.9]), (9, [0.1, 0.1, 0.1]), (-100, [-1.0, -1.0, 2.0]),
    ]
    assert run(spark, rows, k=4) == brute(rows, 4)
    assert run(spark, rows, k=100) == brute(rows, 100)


def test_many_shards_and_blocks(spark):
    random.seed(2)
    rows = [(i, [random.choice([-1.0, -0.5, 0.0, 0.25, 0.7]) for _ in range(6)]) for i in range(700)]
    assert run(spark, rows, k=5, every=7, shard_rows=50, block_rows=20) == brute(rows, 5, every=7)


def test_large_components(spark):
    rows = [(0, [1e9, 2.0]), (1, [1e9, -1.0]), (2, [1e9 + 1, 0.5]), (3, [1e300, 0.0]), (100, [-3e5, 1.0])]
    assert run(spark, rows, k=3) == brute(rows, 3)
    assert whole_numbers(pd.Series([[1e300]]), 1024).dtype == object


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == [] and run(spark, [(0, [1.0])]) == []
