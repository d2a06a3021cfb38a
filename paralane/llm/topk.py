"""Exact top-k search by inner product: MaxScore over shards."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

RESULT = "query_id long, vec_id long, score long"
LONGEST = 2**63 - 1


def whole_numbers(vectors: pd.Series, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, shorter vectors filled up with zeros.

    Doubles while all are small; Python integers, of any size, beyond.
    """
    wide = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), wide))
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    out = np.floor(scale * out)
    if out.size and np.abs(out).max() >= 2.0**52:
        return np.array([[int(x) for x in row] for row in out], dtype=object).reshape(out.shape)
    return out


def _whole(numbers: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in numbers.ravel()], dtype=object).reshape(numbers.shape)


class Shard:
    """Candidates in the order of their ids, with the posting list of each component (term).

    A contribution to a score counts from the smallest that the term has in the shard, so that
    contributions are never negative; the largest is the term's bound.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        self.ids, self.values = ids, values
        self.postings = np.ascontiguousarray(values.T)
        self.most, self.least = values.max(axis=0, initial=0), values.min(axis=0, initial=0)
        self.largest = int(max(-self.least.min(initial=0), self.most.max(initial=0)))

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` best, ties to smaller ids; the query's own id takes no part.

        Terms are ordered by how much they can differ. The threshold is the k-th exact score among
        the candidates that are best by the first terms. Terms are essential up to the point from
        which the others together cannot lift a candidate over the threshold that has no more than
        the smallest contributions so far. The essential postings are traversed for all candidates;
        the other terms are probed, a few at a time, for those that could still reach the threshold.
        Numbers whose scores a double cannot hold exactly are scored one by one, as integers.
        """
        postings, values = self.postings, self.values
        rows = np.flatnonzero(self.ids != query_id)
        if values.dtype == object or query.dtype == object or self.largest * np.abs(query).max(initial=0) * len(query) >= 2.0**52:
            exact = _whole(values[rows]) @ _whole(query) if len(query) else np.zeros(len(rows), dtype=np.int64)
            score = np.array([max(-LONGEST - 1, min(LONGEST, int(x))) for x in exact], dtype=np.int64)
            best = sorted(range(len(rows)), key=lambda i: (-int(score[i]), self.ids[rows[i]]))[:k]
            return rows[best], score[best]
        high = np.maximum(query * self.most, query * self.least)
        low = np.minimum(query * self.most, query * self.least)
        order = np.argsort(low - high, kind="stable")
        ahead = np.concatenate((np.cumsum(high[order][::-1])[::-1], [0]))
        behind = np.concatenate(([0], np.cumsum(low[order])))

        def traversed(terms: np.ndarray) -> np.ndarray:
            return (query[terms] @ postings[terms])[rows]

        done, threshold = len(order), None
        if len(rows) > k:
            guess = traversed(order[: max(1, len(order) // 4)])
            threshold = (values[rows[np.argpartition(-guess, k)[:k]]] @ query).min()
            hopeless = np.flatnonzero(behind + ahead < threshold)
            done = int(hopeless[0]) if len(hopeless) else len(order)
        score = traversed(order[:done])
        while done < len(order):
            alive = score + ahead[done] >= threshold
            rows, score = rows[alive], score[alive]
            some = order[done : done + 8]
            score = score + values[np.ix_(rows, some)] @ query[some]
            done += len(some)
        if threshold is not None:
            rows, score = rows[score >= threshold], score[score >= threshold]
        best = np.lexsort((self.ids[rows], -score))[:k]
        return rows[best], score[best]


def _one_per_id(frame: pd.DataFrame) -> pd.DataFrame:
    """Of several vectors of an id, the smallest counts."""
    if frame["id"].is_unique:
        return frame
    smallest = sorted(range(len(frame)), key=lambda i: (frame["id"].iloc[i], list(frame["vector"].iloc[i])))
    return frame.iloc[smallest].drop_duplicates("id")


def _search(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, scale: float) -> pd.DataFrame:
    if not len(queries) or not len(candidates):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    queries, candidates = _one_per_id(queries), _one_per_id(candidates)
    both = whole_numbers(pd.concat([queries["vector"], candidates["vector"]]), scale)
    asked, values = both[: len(queries)], both[len(queries) :]
    shard = Shard(candidates["id"].to_numpy(), values)
    out = []
    for query_id, query in zip(queries["id"].tolist(), asked):
        rows, score = shard.search(query_id, query, k)
        out += [(query_id, int(i), int(s)) for i, s in zip(shard.ids[rows], score)]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def _usable(vector: Column) -> Column:
    infinite = float("inf")
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x != infinite) & (x != -infinite)
    )


def top_k(
    vectors: DataFrame,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every: int = 100,
    scale: float = 1024.0,
    shard_rows: int = 2048,
    block_rows: int = 16384,
) -> DataFrame:
    """The ``k`` best candidates of each query, exactly: query_id, rank (from 1), vec_id and score.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's own.
    Components are floor(scale * x); the score is their inner product, ties go to the smaller id. Vectors
    that are null or hold null or non-finite components take no part, nor do rows without an id. A shorter
    vector counts as filled up with zeros. Of several vectors of one id the smallest counts. Scores beyond the
    range of long count as its end. Fewer than ``k`` candidates: all of them; no rows: an empty result.

    A hash deals candidates into shards of some ``shard_rows`` and queries into blocks of some
    ``block_rows``. Each block meets each shard in one task, which gives ``k`` rows a query at most; these
    are merged. Neither side is broadcast or collected.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    asked = F.col("id") % every == 0
    size = rows.agg(F.count("*"), F.count_if(asked)).first()
    shards, blocks = max(1, -(-size[0] // shard_rows)), max(1, -(-size[1] // block_rows))
    candidates = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "vector"
    )
    queries = rows.filter(asked).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), "id", "vector",
    )
    found = queries.groupBy("shard", "block").cogroup(candidates.groupBy("shard", "block")).applyInPandas(
        lambda q, c: _search(q, c, k, scale), RESULT
    )
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
