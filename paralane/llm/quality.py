"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType

#: Characters that are counted together (fixed values): sentence marks, shouting, table marks,
#: noise marks, quotes and brackets.
_GROUPS = (".,;:", "!?", "|", "#$%&*@^~+=<>_\\/", "\"'`()[]{}", "0123456789")
STATISTICS = 26


def statistics(text: str) -> list[float]:
    """Numbers that describe a whole text; all zero for an empty one."""
    if not text:
        return [0.0] * STATISTICS
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    count = np.bincount(raw, minlength=256)
    size = len(raw)
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    m = max(1, len(lines))
    line_seen = Counter(lines)
    repeated = sum(len(line) * (k - 1) for line, k in line_seen.items() if k > 1)
    letters = int(count[65:91].sum() + count[97:123].sum())
    top = [k for _, k in seen.most_common(3)]
    once = sum(1 for k in seen.values() if k == 1)
    return [
        float(np.log1p(len(words))),
        float(lengths.mean()), float(lengths.std()), float(lengths.max()), float((lengths <= 2).sum() / n),
        len(seen) / n, len(seen) / n**0.5, once / n, top[0] / n if top else 0.0, sum(top) / n,
        count[65:91].sum() / max(1, letters), letters / size, count[128:].sum() / size,
        count[:32].sum() / size, count[32] / size,
        *(count[np.frombuffer(group.encode(), dtype=np.uint8)].sum() / n for group in _GROUPS),
        float(np.log1p(len(lines))), len(words) / m, len(line_seen) / m, repeated / max(1, len(text)),
        sum(map(str.isupper, seen)) / max(1, len(seen)),
    ]


def statistics_of(texts) -> np.ndarray:
    rows = [statistics(text if isinstance(text, str) else "") for text in texts]
    return np.array(rows, dtype=np.float64).reshape(len(rows), STATISTICS)


@dataclass(frozen=True)
class Trees:
    """Complete binary trees in arrays: node i has the children 2i + 1 and 2i + 2.

    A node that was not split sends every row to the left, so all rows take the same number of steps.
    """

    prior: float
    depth: int
    feature: np.ndarray  # tree, inner node
    threshold: np.ndarray  # tree, inner node; rows above it go right
    leaf: np.ndarray  # tree, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each row: every tree and row, one level at a time."""
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: int = 5
) -> Trees:
    """Boost trees on the logistic loss, with gradients summed in histograms of binned statistics.

    Without rows, or with one label only, there are no trees and the score is the smoothed share of
    label 1.
    """
    n, features = x.shape
    share = (y.sum() + 1.0) / (n + 2.0)
    prior = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    if n == 0 or y.min() == y.max():
        trees = 0
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, 2**depth))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.empty(0) for f in range(features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f]) for f in range(features)], axis=1) if n else np.empty((0, features), dtype=int)
    score = np.full(n, prior)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-score))
        gradient, curve = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            gain = np.full((width, features, bins), -np.inf)
            for f in range(features):
                at = local * bins + binned[:, f]
                g, h, k = (
                    np.bincount(at, weights, minlength=width * bins).reshape(width, bins).cumsum(axis=1)
                    for weights in (gradient, curve, None)
                )
                gt, ht, kt = g[:, -1:], h[:, -1:], k[:, -1:]
                better = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
                gain[:, f] = np.where((k >= least) & (kt - k >= least), better, -np.inf)
            best = gain.reshape(width, -1).argmax(axis=1)
            worth = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            for i in np.flatnonzero(worth):
                f, b = divmod(int(best[i]), bins)
                feature[t, first + i], threshold[t, first + i] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        at = node - inner
        leaf[t] = rate * np.bincount(at, gradient, minlength=2**depth) / (np.bincount(at, curve, minlength=2**depth) + ridge)
        score += leaf[t][at]
    return Trees(prior, depth, feature, threshold, leaf)


def held_out(id_column: str) -> Column:
    """Whether crc32 of the id as text is a multiple of 5; such rows' labels are never learned."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "quality", max_rows: int = 20_000
) -> Trees:
    """Learn from the labelled documents that are not held out.

    At most ``max_rows`` of them are used, those with the smallest hash of their id: the statistics of
    that bounded sample are all that reaches the driver. Rows without a label are left out; an id
    with several labels counts as their majority, 1 in a tie, and an id with several texts as one of
    them. Nothing but the text describes a document.
    """
    known = labels.select(F.col(id_column).alias("doc_id"), F.col(label).alias("__label")).filter(
        F.col("doc_id").isNotNull() & F.col("__label").isNotNull() & ~held_out("doc_id")
    )
    known = known.groupBy("doc_id").agg((F.avg("__label") >= 0.5).cast("double").alias("__label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    joined = rows.join(F.broadcast(sample), "doc_id")

    @F.pandas_udf(ArrayType(DoubleType()))
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series(list(statistics_of(texts)))

    first = Window.partitionBy("doc_id").orderBy("__hash")
    found = (
        joined.select("doc_id", "__label", described("text").alias("x"), F.xxhash64("text").alias("__hash"))
        .withColumn("__row", F.row_number().over(first)).filter("__row = 1")
        .select("doc_id", "x", "__label").collect()
    )
    found.sort(key=lambda row: row["doc_id"])
    x = np.array([row["x"] for row in found], dtype=np.float64).reshape(len(found), STATISTICS)
    return fit_trees(x, np.array([row["__label"] for row in found], dtype=np.float64))


def scored(model: Trees):
    """A column function of texts: the model's score, from 0 to 1; null counts as empty."""

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(statistics_of(texts)))

    return score


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.3, max_rows: int = 20_000
) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) of every document.

    Whole texts are described; empty and null ones have a score too. Repeated rows get equal scores.
    """
    score = scored(fit_quality(docs, labels, id_column, text_column, max_rows=max_rows))
    rows = docs.select(F.col(id_column).alias("doc_id"), score(F.col(text_column).cast("string")).alias("score"))
    return rows.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def quality_filter(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents that score ``threshold`` or more, with the columns of ``docs``, whatever their names.

    Null texts are scored as empty ones; null ids have no label, but a score. Repeated rows stay or go
    together; no rows give no rows.
    """
    score = scored(fit_quality(docs, labels, id_column, text_column))
    return docs.filter(score(F.col(text_column).cast("string")) >= threshold)
