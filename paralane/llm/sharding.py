"""Sharding: contiguous cuts of ordered atomic groups at the smallest feasible capacity."""

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from paralane.llm.common import gapless, text_or_empty

#: Added to the UTF-8 bytes of every text, for what a row holds besides its text.
ROW_BYTES = 16


def shards_needed(ends: Sequence[int], capacity: int) -> int:
    """How many shards a greedy filling takes; ``ends`` are running sums that begin with 0."""
    at = count = 0
    while at < len(ends) - 1:
        at = bisect_right(ends, ends[at] + capacity) - 1
        count += 1
    return count


def smallest_capacity(sizes: Sequence[int], shards: int) -> int:
    """The smallest capacity at which ``sizes``, cut in order, fill no more than ``shards``."""
    ends = [0, *accumulate(sizes)]
    low = max(max(sizes, default=0), -(-ends[-1] // shards))
    high = low + max(sizes, default=0)
    while low < high:
        middle = (low + high) // 2
        if shards_needed(ends, middle) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def cut(sizes: Sequence[int], shards: int) -> list[int]:
    """Where shards 1, 2, ... begin: no shard exceeds the smallest capacity, none is needlessly small.

    Among the cuts that respect the capacity, each is the one nearest to its even share: a greedy
    filling from the right tells how early a cut may be, the capacity how late.
    """
    ends = [0, *accumulate(sizes)]
    capacity = smallest_capacity(sizes, shards)
    earliest = [len(sizes)] * (shards + 1)
    for k in range(shards - 1, -1, -1):
        earliest[k] = bisect_left(ends, ends[earliest[k + 1]] - capacity)
    cuts, at = [], 0
    for k in range(1, shards):
        low = max(at, earliest[k])
        high = bisect_right(ends, ends[at] + capacity) - 1
        even = ends[-1] * k / shards
        near = bisect_left(ends, even)
        if near and even - ends[near - 1] <= ends[min(near, len(ends) - 1)] - even:
            near -= 1
        at = min(max(near, low), high)
        cuts.append(at)
    return cuts


def plan(sizes: dict[int, int], shards: int) -> tuple[dict[int, int], list[int]]:
    """Atomic groups that fill a shard of their own, and the first group of each later shard.

    A group larger than an even share of what is left goes first, alone; the others follow in the
    order of their number and are cut into the shards that remain.
    """
    rest, left = dict(sizes), shards
    alone: dict[int, int] = {}
    total = sum(rest.values())
    for group, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if left == 1 or size * left <= total:
            break
        alone[group] = len(alone)
        total -= rest.pop(group)
        left -= 1
    order = sorted(rest)
    starts = [order[i] if i < len(order) else max(order, default=0) + 1 for i in cut([rest[g] for g in order], left)]
    return alone, starts


def shard_by_bytes(
    docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text_column: str = "text", groups: int = 1 << 16
) -> DataFrame:
    """Deal documents into shards of nearly equal bytes; equal texts never part.

    A row weighs its text's UTF-8 bytes plus ``ROW_BYTES``. The atomic groups that are cut are
    ``groups`` buckets of a hash of the text, ordered by number: all copies of a text are in one
    bucket, so they stay together. Only the buckets' sums reach the driver, where the smallest
    capacity is searched; documents are placed by comparing their bucket with the cuts, and
    numbered inside their shard without shuffling a text.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot (from 0 in each shard) and
    grown_shard (null: this law promises nothing about one more shard). A null text counts as
    empty, null ids are numbered like others, repeated rows get slots of their own, and an empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    text = text_or_empty(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(groups)).cast("int").alias("__group"),
    )
    sums = rows.groupBy("__group").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()
    alone, starts = plan({r["__group"]: r["size"] for r in sums}, shards)
    first = len(alone)

    def place(group: int) -> int:
        return alone.get(group, first + bisect_right(starts, group))

    counts = [0] * shards
    for r in sums:
        counts[place(r["__group"])] += r["rows"]
    later = F.size(F.filter(F.lit(starts).cast("array<int>"), lambda start: start <= F.col("__group")))
    own = F.array_position(F.lit(list(alone)).cast("array<int>"), F.col("__group"))  # 0: not alone
    shard = F.when(own > 0, own - 1).otherwise(F.lit(first) + later)
    placed = rows.withColumn("shard", shard.cast("int")).drop("__group")
    numbered = gapless(placed, "shard", list(enumerate(counts)), ["doc_id", "text_crc32", "size"], "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
