import zlib

import numpy as np

from helpers import ROWS, awkward
from paralane.llm.quality import STATISTICS, fit_quality, fit_trees, quality_filter, quality_scores, statistics

LABELS = "doc_id long, quality int, toxic int"


def noise(i):
    return " ".join(f"###x{i}{j} $$$ !!" for j in range(20 + i % 7))


def prose(i):
    return ". ".join(f"the word number {i} and {j} of a plain sentence" for j in range(10 + i % 5))


def corpus(spark, n=400):
    rows = [(i, noise(i) if i % 3 == 0 else prose(i)) for i in range(n)]
    labels = [(i, int(i % 3 != 0), 0) for i in range(n) if i % 2 == 0]
    return awkward(spark, rows), spark.createDataFrame(labels, LABELS), n


def brute_score(model, row):
    total = model.prior
    for t in range(len(model.leaf)):
        node = 0
        while node < len(model.feature[t]):
            node = 2 * node + 1 + int(row[model.feature[t][node]] > model.threshold[t][node])
        total += model.leaf[t][node - len(model.feature[t])]
    return 1 / (1 + np.exp(-total))


def test_trees_learn_and_are_traversed_like_one_by_one():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.5)).astype(float)
    model = fit_trees(x[:2000], y[:2000], trees=40)
    scores = model.score(x[2000:])
    assert ((scores > 0.5) == (y[2000:] > 0)).mean() > 0.97
    assert np.allclose(scores[:50], [brute_score(model, row) for row in x[2000:2050]])
    assert scores.min() >= 0 and scores.max() <= 1


def test_one_label_or_none():
    assert np.allclose(fit_trees(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))), 0.5)
    assert fit_trees(np.ones((9, 3)), np.ones(9)).score(np.ones((1, 3)))[0] > 0.5


def test_held_out_accuracy(spark):
    docs, labels, n = corpus(spark)
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == n
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 != 0) for r in held]) > 0.97
    kept = quality_filter(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["predicted"]}


def test_held_out_labels_are_not_learned(spark):
    docs, labels, _ = corpus(spark, 200)
    swapped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality", "toxic")
    a, b = fit_quality(docs, labels), fit_quality(docs, swapped)
    assert np.array_equal(a.leaf, b.leaf) and np.array_equal(a.threshold, b.threshold)


def test_awkward_rows_and_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (7, None, 0), (9, 0, 0), (9, 0, 1), (10, 1, 0), (12, 1, 0), (None, 0, 0), (999, 0, 0)], LABELS)
    rows = quality_scores(awkward(spark, ROWS), labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (4, 5)}
    assert len(empty) == 1
    assert quality_scores(awkward(spark, []), labels).count() == 0
    assert quality_scores(awkward(spark, ROWS), labels.limit(0)).count() == len(ROWS)


def test_sample_is_bounded(spark):
    docs, labels, _ = corpus(spark, 100)
    assert fit_quality(docs, labels, max_rows=3).leaf.shape[1] == 16


def test_statistics_have_one_length():
    assert {len(statistics(t)) for t in ("", " ", "a", "\n\n", "Ω ± x" * 50, "A" * 10_000)} == {STATISTICS}
