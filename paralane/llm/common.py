"""Helpers that several of these operators share."""

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: The six characters that separate words here: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def finite(vector: Column) -> Column:
    """Whether a vector of doubles is not null and holds no null or non-finite component."""
    infinite = float("inf")
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite))


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def gapless(
    df: DataFrame, group: str, sizes: Sequence[tuple[int, int]], order: Sequence[str], name: str
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large one group is.

    ``sizes`` has a (group, rows) pair for every group of ``df``; there are few groups. A group is
    dealt into parts in proportion to its rows, some four parts per shuffle partition over all
    groups, so a hot group is spread as evenly as the others. Parts are counted, their first
    numbers broadcast (at most four per partition and one per group), and rows are ranked within
    their part by ``order``. Rows equal in ``order`` are numbered in any order.
    """
    spark = df.sparkSession
    target = max(1, -(-sum(n for _, n in sizes) // (4 * partitions_of(df))))
    parts = spark.createDataFrame(
        [(int(g), max(1, -(-int(n) // target))) for g, n in sizes], f"{group} int, __parts int"
    )
    rows = df.join(F.broadcast(parts), group).withColumn(
        "__part", F.pmod(F.xxhash64(*order), F.col("__parts"))
    )
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        rows.groupBy(group, "__part")
        .agg(F.count("*").alias("__rows"))
        .withColumn("__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .drop("__rows")
    )
    inside = Window.partitionBy(group, "__part").orderBy(*order)
    return (
        rows.withColumn("__rank", F.row_number().over(inside))
        .join(F.broadcast(first), [group, "__part"])
        .withColumn(name, (F.col("__first") + F.col("__rank") - 1).cast("long"))
        .drop("__parts", "__part", "__rank", "__first")
    )


def strings_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each string, null as empty, without decoding."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


class Seen:
    """What was worked out for words, in two generations of at most ``size`` words.

    Words that come again are moved to the new generation; when it is full, the old one goes.
    """

    def __init__(self, size: int, longest: int = 64) -> None:
        self.size, self.longest = size, longest
        self.new: dict = {}
        self.old: dict = {}

    def all(self, lists: list[list], work) -> list[list]:
        """The values of all words of some lists; ``work`` makes a dictionary for a list of new words."""
        known = self.new
        found = [list(map(known.get, words)) for words in lists]
        open_ = [i for i, values in enumerate(found) if None in values]
        missing = {word for i in open_ for word, value in zip(lists[i], found[i]) if value is None}
        known.update({word: self.old[word] for word in missing if word in self.old})
        known.update(work([word for word in missing if word not in known]))
        for i in open_:
            found[i] = [known[word] if value is None else value for word, value in zip(lists[i], found[i])]
        for word in missing:
            if len(word) > self.longest:
                del known[word]
        if len(known) >= self.size:
            self.old, self.new = known, {}
        return found


def batches_of(rows: Iterable, schema: pa.Schema, size: int = 4096, most: int = 64 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of an iterator of tuples: at most ``size`` rows, closed once texts and bytes reach ``most``."""
    block: list[tuple] = []
    held = 0
    for row in rows:
        block.append(row)
        held += sum(len(value) for value in row if isinstance(value, (str, bytes)))
        if len(block) == size or held >= most:
            yield to_batch(block, schema)
            block, held = [], 0
    if block:
        yield to_batch(block, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(columns, schema)], schema=schema
    )


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of unsigned 64-bit numbers that spreads them evenly."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values
