"""Vector code compression: product quantization by integer k-means with adaptive distance bounds."""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from paralane.llm.common import finite
from paralane.session import materialize, new_folder, remove_folder

PARTS = 4
#: Doubles are rounded to 24 bits in stored bounds, and by a part in 10**12 before, always to the safe side.
_SLACK = 1e-12


def _down(values: np.ndarray) -> np.ndarray:
    """Lower bounds as 32-bit numbers that are no larger."""
    values = values - np.abs(values) * _SLACK - _SLACK
    out = values.astype(np.float32)
    return np.where(out > values, np.nextafter(out, np.float32(-np.inf)), out)


def _up(values: np.ndarray) -> np.ndarray:
    """Upper bounds as 32-bit numbers that are no smaller."""
    return -_down(-values)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries, as integers."""
    largest = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * float(largest) ** 2 * max(1, points.shape[1]) < 2.0**53:  # every step is exact in doubles
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)).astype(np.int64)
    out = np.empty((len(points), len(entries)), dtype=np.int64)
    for i, entry in enumerate(entries):
        out[:, i] = ((points - entry) ** 2).sum(axis=1)
    return out


@dataclass
class Bounds:
    """What is kept of the points of one part between rounds.

    ``own`` is the nearest entry and ``upper`` at least its distance. ``near`` are the b closest others,
    ``lower`` at most their distances, ascending; no other entry is closer than ``outer``.
    """

    own: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

    @classmethod
    def all(cls, points: np.ndarray, entries: np.ndarray, b: int) -> "Bounds":
        """By the distances to all entries; ties go to the smaller index."""
        distances = squared(points, entries)
        k = len(entries)
        b = min(b, k - 1)
        if distances.max(initial=0) < 2**53:
            key = distances * k + np.arange(k)  # distinct, in the order of (distance, index)
            if b + 2 < k:
                key = np.partition(key, b + 1, axis=1)[:, : b + 2]
            key.sort(axis=1)
            order, ranked = key % k, key // k
        else:
            order = np.argsort(distances, axis=1, kind="stable")[:, : b + 2]
            ranked = np.take_along_axis(distances, order, axis=1)
        root = np.sqrt(ranked.astype(np.float64))
        outer = _down(root[:, b + 1]) if k > b + 1 else np.full(len(points), np.inf, dtype=np.float32)
        return cls(order[:, 0], _up(root[:, 0]), order[:, 1 : b + 1], _down(root[:, 1 : b + 1]), outer)

    def moved(self, drift: np.ndarray) -> None:
        """Bounds after every entry has moved by at most ``drift``; lower ones are put in order again."""
        self.upper = _up(self.upper.astype(np.float64) + drift[self.own])
        self.lower = _down(self.lower.astype(np.float64) - drift[self.near])
        self.outer = np.where(np.isinf(self.outer), self.outer, _down(self.outer.astype(np.float64) - drift.max(initial=0)))
        self.order()

    def order(self) -> None:
        bounds = np.concatenate((self.lower, self.outer[:, None]), axis=1)
        self.lower = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1][:, :-1]

    def take(self, rows: np.ndarray, other: "Bounds") -> None:
        for name in ("own", "upper", "near", "lower", "outer"):
            getattr(self, name)[rows] = getattr(other, name)

    def shortened(self, b: int) -> "Bounds":
        """The b closest others only: the next one's bound then holds for all the rest."""
        if b >= self.near.shape[1]:
            return self
        return Bounds(self.own, self.upper, self.near[:, :b], self.lower[:, :b], np.minimum(self.lower[:, b], self.outer))

    def refine(self, points: np.ndarray, entries: np.ndarray) -> tuple[int, int]:
        """Make ``own`` the nearest entry again. Returns the most near entries that a point needed, and the
        number of distances that were computed.

        A point whose upper bound is below all lower ones stays as it is. Of the others the own distance
        is computed first. If that does not settle it, entries are verified by integer distances:
        the near ones up to the first lower bound above the upper one, or all where ``outer`` is not above it.
        """
        least = self.lower[:, 0] if self.near.shape[1] else self.outer
        rows = np.flatnonzero(self.upper >= least)
        exact = ((points[rows] - entries[self.own[rows]]) ** 2).sum(axis=1)
        computed = len(rows)
        self.upper[rows] = _up(np.sqrt(exact.astype(np.float64)))
        open_ = self.upper[rows] >= least[rows]
        rows, exact = rows[open_], exact[open_]
        lost = self.upper[rows] >= self.outer[rows]
        all_rows = rows[lost]
        if len(all_rows):
            self.take(all_rows, Bounds.all(points[all_rows], entries, self.near.shape[1]))
            computed += len(all_rows) * len(entries)
        rows, exact = rows[~lost], exact[~lost]
        if not len(rows):
            return 0, computed
        needed = (self.upper[rows][:, None] >= self.lower[rows]).sum(axis=1)  # lower bounds ascend
        most = int(needed.max())
        asked = np.arange(most) < needed[:, None]
        near = self.near[rows, :most]
        which, place = np.nonzero(asked)
        distances = np.full((len(rows), most + 1), np.iinfo(np.int64).max)
        distances[:, 0] = exact
        distances[which, place + 1] = ((points[rows[which]] - entries[near[which, place]]) ** 2).sum(axis=1)
        computed += len(which)
        index = np.concatenate((self.own[rows][:, None], near), axis=1)
        order = np.lexsort((index, distances), axis=1)
        index, distances = np.take_along_axis(index, order, axis=1), np.take_along_axis(distances, order, axis=1)
        root = np.sqrt(distances.astype(np.float64))
        self.own[rows], self.upper[rows] = index[:, 0], _up(root[:, 0])
        # entries that were not asked come last and keep their places and bounds
        near_rows, lower_rows = self.near[rows], self.lower[rows]
        near_rows[which, place] = index[which, place + 1]
        lower_rows[which, place] = _down(root[which, place + 1])
        self.near[rows], self.lower[rows] = near_rows, lower_rows
        self.order()
        return most, computed

    def packed(self) -> np.ndarray:
        """One row of bytes per point."""
        parts = [self.own[:, None].astype(np.uint8), self.near.astype(np.uint8)]
        parts += [np.ascontiguousarray(x, dtype=np.float32).view(np.uint8).reshape(len(self.own), -1) for x in (self.upper[:, None], self.lower, self.outer[:, None])]
        return np.concatenate(parts, axis=1)

    @classmethod
    def unpacked(cls, data: np.ndarray, b: int) -> "Bounds":
        real = np.ascontiguousarray(data[:, 1 + b :]).view(np.float32)
        return cls(
            data[:, 0].astype(np.int64), real[:, 0].copy(), data[:, 1 : 1 + b].astype(np.int64), real[:, 1 : 1 + b].copy(), real[:, 1 + b].copy()
        )


@dataclass
class Step:
    """What a round's tasks need: the codebooks, how far entries moved, and how many near ones are kept."""

    books: list[np.ndarray]
    drifts: list[np.ndarray] | None
    near: list[int]
    keep: list[int]


def _points(column: pa.Array, width: int) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64)
    return data.reshape(len(column), PARTS, width)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], type=pa.binary())


def _bounds(batch: pa.RecordBatch, points: np.ndarray, step: Step) -> Iterator[tuple[int, Bounds, int, int]]:
    """The assigned bounds of each part of a batch, the near entries needed and the distances computed."""
    sizes = [1 + n + 4 * (n + 2) for n in step.near]
    data = None
    if step.drifts is not None:
        data = np.frombuffer(b"".join(batch.column("bounds").to_pylist()), dtype=np.uint8).reshape(len(points), sum(sizes))
    for part, book in enumerate(step.books):
        own = points[:, part]
        if data is None:
            yield part, Bounds.all(own, book, step.near[part]), 0, len(own) * len(book)
            continue
        begin = sum(sizes[:part])
        bounds = Bounds.unpacked(data[:, begin : begin + sizes[part]], step.near[part])
        bounds.moved(step.drifts[part])
        yield part, bounds, *bounds.refine(own, book)


def _round(batches: Iterator[pa.RecordBatch], schema: pa.Schema, width: int, step: Step) -> Iterator[pa.RecordBatch]:
    """Rows with new bounds; then, for each entry of a part, the task's sum and number of points."""
    sums = [np.zeros((len(book), width), dtype=np.int64) for book in step.books]
    counts = [np.zeros(len(book), dtype=np.int64) for book in step.books]
    needed, computed = [0] * PARTS, 0

    def out(rows: int, /, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    for batch in batches:
        points = _points(batch.column("numbers"), width)
        packed = []
        for part, bounds, most, n in _bounds(batch, points, step):
            np.add.at(sums[part], bounds.own, points[:, part])
            counts[part] += np.bincount(bounds.own, minlength=len(counts[part]))
            needed[part], computed = max(needed[part], most), computed + n
            packed.append(bounds.shortened(step.keep[part]).packed())
        yield out(
            batch.num_rows, vec_id=batch.column("vec_id"), label=batch.column("label"), numbers=batch.column("numbers"),
            bounds=_bytes(np.concatenate(packed, axis=1)),
        )
    for part in range(PARTS):
        used = np.flatnonzero(counts[part])
        yield out(
            len(used), part=pa.array([part] * len(used), type=pa.int32()), entry=pa.array(used, type=pa.int32()),
            sums=pa.array(list(sums[part][used]), type=pa.list_(pa.int64())), n=pa.array(counts[part][used]),
            needed=pa.array([needed[part]] * len(used), type=pa.int32()),
            computed=pa.array([computed if part == 0 and i == 0 else 0 for i in range(len(used))], type=pa.int64()),
        )


def _codes(batches: Iterator[pa.RecordBatch], schema: pa.Schema, width: int, step: Step) -> Iterator[pa.RecordBatch]:
    """The last assignment: codes and exact errors."""
    for batch in batches:
        points = _points(batch.column("numbers"), width)
        codes, error = np.empty((len(points), PARTS), dtype=np.uint8), np.zeros(len(points), dtype=np.int64)
        for part, bounds, _, _ in _bounds(batch, points, step):
            codes[:, part] = bounds.own
            error += ((points[:, part] - step.books[part][bounds.own]) ** 2).sum(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _bytes(codes), pa.array(error)], schema=schema)


def _numbers(batches: Iterator[pa.RecordBatch], schema: pa.Schema, width: int, scale: float) -> Iterator[pa.RecordBatch]:
    """floor(scale * x) as 64-bit integers, filled up with zeros."""
    limit = isqrt(2**60 // max(1, width)) // 2
    for batch in batches:
        out = []
        for vector in batch.column("vector"):
            x = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
            out.append(np.pad(np.clip(x, -limit, limit).astype(np.int64), (0, PARTS * width - len(x))).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, type=pa.binary())], schema=schema)


def _moved(rows: DataFrame, books: list[np.ndarray]) -> tuple[list[np.ndarray], list[int], int]:
    """Codebooks of floor(sum / count), from sums that Spark adds up: at most 256 entries a part reach the driver."""
    found = rows.filter("part IS NOT NULL")
    parts = found.select("part", "entry", "n", "needed", "computed", F.posexplode_outer("sums").alias("at", "sum"))
    first = F.coalesce("at", F.lit(0)) == 0
    added = parts.groupBy("part", "entry", F.coalesce("at", F.lit(0)).alias("at")).agg(
        F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.max("needed").alias("needed"), F.sum(F.when(first, F.col("computed"))).alias("computed")
    ).collect()
    new, needed = [book.copy() for book in books], [0] * PARTS
    for row in added:
        needed[row["part"]] = max(needed[row["part"]], row["needed"])
        if row["sum"] is not None:
            new[row["part"]][row["entry"], row["at"]] = row["sum"] // row["n"]
    return new, needed, sum(row["computed"] or 0 for row in added)


def vector_codes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    entries: int = 256, rounds: int = 4, scale: float = 1024.0, near: int = 16, fewest: int = 4, computed: list[int] | None = None,
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector.

    Vectors that are null or hold null or non-finite components are left out. Components are floor(scale * x),
    held in 64 bits: those so large that a squared distance would not fit count as the largest that does.
    Vectors are cut into four equal consecutive parts; where lengths differ, or are not divisible by four, they
    are filled up with zeros. Each part's codebook starts with the ``entries`` smallest ids' parts (null ids
    last, ties by the vector's bytes; fewer rows: fewer entries) and is moved ``rounds`` times to the floor
    of the mean of the parts nearest to each entry, ties to the smaller index. Repeated rows count as often
    as they come. No rows: an empty result. Null labels are one label; other columns are not read.

    Rows are kept with their bounds, written once per round to the shared folder: the nearest entry, the b
    closest others with ascending lower bounds, and one bound for all the rest. Entries' moves loosen
    them; what they do not decide is verified in integers. b starts at ``near`` and follows what the points of
    a round needed, down to ``fewest``. Tasks send one sum per entry. ``computed`` gets the number of distances of
    each round but the last assignment.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector")
    ).filter(finite(F.col("vector")))
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // PARTS)
    schema = StructType([rows.schema["vec_id"], rows.schema["label"], StructField("numbers", BinaryType())])
    path = new_folder(spark, "vectors")
    table = materialize(rows.mapInArrow(partial(_numbers, schema=to_arrow_schema(schema), width=width, scale=scale), schema), path)
    first = table.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()
    start = np.frombuffer(b"".join(row["numbers"] for row in first), dtype=np.int64).reshape(len(first), PARTS, width)
    books = [np.ascontiguousarray(start[:, part]) for part in range(PARTS)]
    state = StructType([
        *schema, StructField("bounds", BinaryType()), StructField("part", IntegerType()), StructField("entry", IntegerType()),
        StructField("sums", ArrayType(LongType())), StructField("n", LongType()), StructField("needed", IntegerType()), StructField("computed", LongType()),
    ])
    b = [max(0, min(near, len(first) - 1))] * PARTS
    drifts = None
    for _ in range(rounds if len(first) else 0):
        step = Step(books, drifts, b, b)
        if drifts is not None:
            step.keep = [max(min(fewest, n), min(n, most)) for n, most in zip(b, needed)]
        work = partial(_round, schema=to_arrow_schema(state), width=width, step=step)
        before, path = path, new_folder(spark, "vectors")
        table = materialize(table.mapInArrow(work, state), path)
        remove_folder(spark, before)
        new, needed, n = _moved(table, books)
        if computed is not None:
            computed.append(n)
        needed = needed if drifts is not None else b
        drifts = [_drift(a, c) for a, c in zip(books, new)]
        table, books, b = table.filter("part IS NULL").select(*schema.names, "bounds"), new, step.keep
    last = StructType([rows.schema["vec_id"], rows.schema["label"], StructField("code", BinaryType()), StructField("error", LongType())])
    work = partial(_codes, schema=to_arrow_schema(last), width=width, step=Step(books, drifts, b, b))
    coded = materialize(table.mapInArrow(work, last))
    remove_folder(spark, path)
    text = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    of_label = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(sha256(text.encode()).hexdigest()).alias("codebooks_sha256")
    )


def _drift(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far entries moved, rounded up."""
    moved = np.sqrt(((new - old) ** 2).sum(axis=1).astype(np.float64))
    return moved * (1 + _SLACK)
