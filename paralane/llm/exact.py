"""Exact dedup: Grace hash partitioning, with an open-addressing table per bucket."""

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from paralane.llm.common import SPACES, batches_of, partitions_of, strings_as_bytes, text_or_empty
from paralane.session import new_folder

_SPACES = SPACES.encode()


class ContentTable:
    """An open-addressing table of contents: linear probing, complete contents compared."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.best: list[tuple] = []
        self.rows: list[tuple] = []
        self.counts: list[int] = []
        self.bytes = 0

    def find(self, hash_: int, content: bytes) -> tuple[int, int]:
        """The content's place among the entries, or -1 and the free slot where it belongs."""
        mask = len(self.slots) - 1
        slot = hash_ & mask
        while (entry := self.slots[slot]) >= 0:
            if self.hashes[entry] == hash_ and self.contents[entry] == content:
                return entry, slot
            slot = (slot + 1) & mask
        return -1, slot

    def add(self, slot: int, hash_: int, content: bytes, rank: tuple, row: tuple, count: int, held: int) -> None:
        self.slots[slot] = len(self.hashes)
        self.hashes.append(hash_)
        self.contents.append(content)
        self.best.append(rank)
        self.rows.append(row)
        self.counts.append(count)
        self.bytes += held
        if 2 * len(self.hashes) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for entry, other in enumerate(self.hashes):
                slot = other & mask
                while self.slots[slot] >= 0:
                    slot = (slot + 1) & mask
                self.slots[slot] = entry

    def merge(self, entry: int, rank: tuple, row: tuple, count: int) -> None:
        self.counts[entry] += count
        if rank < self.best[entry]:
            self.best[entry], self.rows[entry] = rank, row


def _rank(points: int, key) -> tuple:
    """Small for the row that stays: many code points, then a small id, null ids last."""
    return (-points, key is None, 0 if key is None else key)


def _combine(batches: Iterator[pa.RecordBatch], schema: pa.Schema, text: int, key: int, budget: int) -> Iterator[pa.RecordBatch]:
    """Copies within a task become one row before the shuffle; the table is emptied when full."""

    def rows() -> Iterator[tuple]:
        table = ContentTable()
        for batch in batches:
            texts = strings_as_bytes(batch.column(text))
            points = batch.column(batch.num_columns - 1).to_pylist()
            carried = zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns - 1)))
            for content, n, row in zip(texts, points, carried):
                content = content.translate(None, _SPACES)
                hash_ = xxhash.xxh64_intdigest(content)
                rank = _rank(n, row[key])
                entry, slot = table.find(hash_, content)
                if entry >= 0:
                    table.merge(entry, rank, (*row, n), 1)
                    continue
                table.add(slot, hash_, content, rank, (*row, n), 1, 2 * len(content) + 300)
                if table.bytes > budget:
                    yield from emitted(table)
                    table = ContentTable()
        yield from emitted(table)

    def emitted(table: ContentTable) -> Iterator[tuple]:
        for hash_, row, count in zip(table.hashes, table.rows, table.counts):
            yield (*row, hash_ - (1 << 63), count)

    return batches_of(rows(), schema, 1024)


def _deduplicate(batches: Iterator[pa.RecordBatch], schema: pa.Schema, text: int, key: int, budget: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    """One bucket: contents that the table has room for are settled, the others spill whole.

    A content is either in the table before any copy of it could spill, or all its copies spill:
    the next, finer level settles those.
    """

    def rows() -> Iterator[tuple]:
        table = ContentTable()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            texts = strings_as_bytes(batch.column(text))
            for original, *row in zip(texts, *columns):
                *carried, n, signed, count = row
                content = original.translate(None, _SPACES)
                hash_ = signed + (1 << 63)
                rank = _rank(n, carried[key])
                if not keep_text:
                    carried_row = (*carried[:text], None, *carried[text + 1 :], n)
                else:
                    carried_row = (*carried, n)
                entry, slot = table.find(hash_, content)
                if entry >= 0:
                    table.merge(entry, rank, carried_row, count)
                elif table.bytes and table.bytes + len(content) > budget:
                    yield (*carried, n, signed, count, None, True)
                else:
                    held = len(content) * (3 if keep_text else 1) + 300
                    table.add(slot, hash_, content, rank, carried_row, count, held)
        for hash_, content, row, count in zip(table.hashes, table.contents, table.rows, table.counts):
            yield (*row, hash_ - (1 << 63), count, hashlib.sha256(content).digest(), False)

    return batches_of(rows(), schema, 1024)


def distinct_contents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_text: bool = True,
    budget: int = 64 << 20,
    fan_out: int = 8,
) -> DataFrame:
    """The row that stays of each group of equal texts, with all its columns.

    Texts are equal when they are identical without spaces and U+0009 to U+000D; null counts as
    empty. Of equal texts the row with the most code points stays, then the one with the smallest
    id (null ids last). Added columns: __sha256 (of the text without spaces, binary) and __size
    (rows of the group). A hash deals the rows into buckets; a task holds at most ``budget`` bytes
    of contents in its table. What does not fit is written to the shared folder and dealt anew,
    ``fan_out`` times finer, until nothing is left over: no row is dropped, and a bucket that
    cannot be split is settled over several levels. Copies are merged in each task before the
    shuffle, so a hot group sends one row per task.
    """
    names = docs.columns
    text, key = names.index(text_column), names.index(id_column)
    tagged = docs.withColumn("__points", F.char_length(text_or_empty(text_column)).cast("long"))
    sent = StructType([
        *(StructField(f.name, f.dataType, True) for f in tagged.schema),
        StructField("__hash", LongType()), StructField("__size", LongType()),
    ])
    settled = StructType([*sent, StructField("__sha256", BinaryType()), StructField("__spilled", BooleanType())])
    combine = partial(_combine, schema=to_arrow_schema(sent), text=text, key=key, budget=budget)
    settle = partial(
        _deduplicate, schema=to_arrow_schema(settled), text=text, key=key, budget=budget, keep_text=keep_text
    )
    rows, done, buckets, level = tagged.mapInArrow(combine, sent), None, partitions_of(docs), 0
    while True:
        dealt = rows.repartition(buckets, F.xxhash64("__hash", F.lit(level)))
        path = new_folder(docs.sparkSession, "grace")
        dealt.mapInArrow(settle, settled).write.parquet(path)
        level_rows = docs.sparkSession.read.schema(settled).parquet(path)
        part = level_rows.filter(~F.col("__spilled"))
        done = part if done is None else done.unionByName(part)
        spilled = level_rows.filter("__spilled")
        if spilled.isEmpty():
            return done.drop("__points", "__hash", "__spilled")
        rows, buckets, level = spilled.drop("__sha256", "__spilled"), buckets * fan_out, level + 1


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", budget: int = 64 << 20) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256 (lowercase hex).

    See ``distinct_contents`` for what is equal and what stays. Of rows that repeat both id and
    text, one is kept. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    groups = distinct_contents(rows, "doc_id", "text", keep_text=False, budget=budget).select(
        F.lower(F.hex("__sha256")).alias("text_sha256"),
        F.col("doc_id").alias("keep_id"),
        F.col("__size").alias("group_size"),
    )
    plain = F.translate(text_or_empty("text"), SPACES, "")
    members = rows.select(
        "doc_id", F.sha2(plain, 256).alias("text_sha256"), F.char_length(text_or_empty("text")).alias("__points")
    )
    copy = Window.partitionBy("doc_id", "text_sha256").orderBy(F.desc("__points"))
    members = members.withColumn("__copy", F.row_number().over(copy)).drop("__points")
    return members.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__copy") == 1)).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with the columns of ``docs``, whatever their names. Null texts count as empty."""
    plain = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    kept = distinct_contents(docs.toDF(*plain.values()), plain[id_column], plain[text_column])
    return kept.select(*(F.col(own).alias(name) for name, own in plain.items()))
