"""Rows that repeat the keys of a locked test split.

A blocked Bloom filter of the locked keys is broadcast, so a table of any size is tested where it
lies; only the rows that the filter lets through are shuffled, to be compared with the keys. The
filter is made and asked by Spark's own bitmap functions.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the bits of one bitmap of Spark's bitmap functions.
BITMAP_BITS = 32_768
PROBES = 4

BLOCK, BITS, MARK = "__leak_block", "__leak_bits", "__leak"


def _block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks))


def _places(keys: Sequence[str]) -> list[Column]:
    """Bits of a bitmap, by slices of a second hash."""
    second = F.xxhash64(F.lit(PROBES), *keys)
    return [F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BITMAP_BITS - 1)) for i in range(PROBES)]


def _is_set(place: Column) -> Column:
    byte = F.substring(F.col(BITS), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    bit = F.call_function("shiftleft", F.lit(1), F.pmod(place, F.lit(8)).cast("int"))
    return F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(bit) != 0


def key_filter(locked: DataFrame, keys: Sequence[str], bits_per_key: int = 16, max_bytes: int = 64 << 20) -> tuple[DataFrame, int]:
    """The filter, a bitmap of 4 KB per block of keys, and its number of blocks.

    Some ``bits_per_key`` bits for each row let about one foreign row in 400 through. The filter never
    exceeds ``max_bytes``: for more keys it is denser and lets more rows through, which costs a
    larger shuffle, but changes no result.
    """
    blocks = -(-max(1, locked.count()) * bits_per_key // BITMAP_BITS)
    blocks = max(1, min(blocks, max_bytes // (BITMAP_BITS // 8)))
    places = F.explode(F.array(*_places(keys))).alias("place")
    bits = locked.select(_block(keys, blocks).alias(BLOCK), places)
    return bits.groupBy(BLOCK).agg(F.bitmap_construct_agg("place").alias(BITS)), blocks


def possible_leaks(df: DataFrame, locked: DataFrame, keys: Sequence[str], **limits: int) -> DataFrame:
    """All rows of ``df`` with a boolean ``__leak``: false only where the key is surely not locked."""
    filter_, blocks = key_filter(locked, keys, **limits)
    joined = df.withColumn(BLOCK, _block(keys, blocks)).join(F.broadcast(filter_), BLOCK, "left")
    mark = F.col(BITS).isNotNull() & reduce(Column.__and__, [_is_set(p) for p in _places(keys)])
    return joined.withColumn(MARK, mark).drop(BLOCK, BITS)


def _compared(hits: DataFrame, locked: DataFrame, keys: Sequence[str], leaked: bool) -> DataFrame:
    """The hits whose keys are locked, or those whose are not; a null is a key like others.

    A semi or anti join would be pushed below the filter's join, and the whole table be shuffled. As
    the keys are distinct, an inner or outer join gives the same rows and stays where it is.
    """
    names = {key: f"__locked_{i}" for i, key in enumerate(keys)}
    known = locked.select(*[F.col(key).alias(name) for key, name in names.items()]).distinct()
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()])
    if leaked:
        return hits.join(known, same).drop(*names.values())
    marked = hits.join(known.withColumn("__known", F.lit(True)), same, "left")
    return marked.where(F.col("__known").isNull()).drop(*names.values(), "__known")


def leaked_rows(df: DataFrame, locked: DataFrame, keys: Sequence[str] = ("src", "tgt"), **limits: int) -> DataFrame:
    """The rows of ``df`` whose keys are those of a row of the locked split, repeats included.

    Keys are compared as they are: normalize both tables first if spellings should not matter.
    A null key equals a null key. An empty split leaks nothing.
    """
    hits = possible_leaks(df, locked, keys, **limits).where(MARK).drop(MARK)
    return _compared(hits, locked, keys, leaked=True)


def without_leaks(df: DataFrame, locked: DataFrame, keys: Sequence[str] = ("src", "tgt"), **limits: int) -> DataFrame:
    """The rows of ``df`` that are not ``leaked_rows``. Rows that the filter stops are not shuffled;
    the table is scanned twice."""
    tested = possible_leaks(df, locked, keys, **limits)
    clear, hits = tested.where(~F.col(MARK)).drop(MARK), tested.where(MARK).drop(MARK)
    return clear.unionAll(_compared(hits, locked, keys, leaked=False))


def leak_report(
    df: DataFrame, locked: DataFrame, checks: Mapping[str, Sequence[str]], by: Sequence[str] = ("split",), **limits: int
) -> DataFrame:
    """One row per group ``by``: its rows, and for each named check how many of them leak."""
    counts = df.select(*by, F.lit("n_rows").alias("check"))
    for name, keys in checks.items():
        counts = counts.unionAll(leaked_rows(df, locked, keys, **limits).select(*by, F.lit(name).alias("check")))
    summed = [F.count_if(F.col("check") == name).alias(name) for name in ("n_rows", *checks)]
    return counts.groupBy(*by).agg(*summed)
