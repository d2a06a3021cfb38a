"""Substring dedup: words of repeated windows are removed, found by an FM-index per shard."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from paralane.llm.common import mixed, partitions_of, strings_as_bytes, text_or_empty
from paralane.llm.fm_index import FMIndex

#: Bytes of text in a block of documents, and words in an index.
BLOCK_BYTES = 8 << 20
INDEX_WORDS = 1 << 18
#: Windows in a run at most, and words that make an anchor.
RUN_WINDOWS = 32
ANCHOR_WORDS = 4
LAST_ID = 2**63 - 1
#: An anchor in this share of all blocks is hot: its windows are sent one by one, each to a shard of its own.
#: A block has 8 MB of a large table, so that is an anchor that some two documents of a block have, at any size.
HOT_SHARE = 0.9

_OCCURRENCE = StructType([StructField("anchor", LongType()), StructField("block", IntegerType()), StructField("low", LongType()), StructField("high", LongType())])
_REPEATED = StructType([StructField("block", IntegerType()), StructField("anchor", LongType()), StructField("hot", BooleanType())])
_SEGMENT = StructType([StructField("shard", LongType()), StructField("hot_anchor", LongType()), StructField("block", IntegerType()), StructField("words", BinaryType()), StructField("low", LongType()), StructField("high", LongType())])
_FOUND = StructType([StructField("block", IntegerType()), StructField("shard", LongType()), StructField("hot_anchor", LongType()), StructField("segment", LongType()), StructField("first_ids", ArrayType(LongType()))])


@dataclass
class Runs:
    """Runs of consecutive windows with one anchor, over all documents of a block.

    The anchor of a window is the smallest hash of ``ANCHOR_WORDS`` consecutive words in it, so
    equal windows have equal anchors wherever they stand.
    """

    words: list[bytes]  # of all documents
    ends: np.ndarray  # of each document's words
    begin: np.ndarray  # a run's first window
    count: np.ndarray  # its windows
    anchor: np.ndarray
    row: np.ndarray  # the document it is in

    @classmethod
    def of(cls, texts: list[bytes], window: int) -> "Runs":
        words: list[bytes] = []
        ends = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            words += text.split()
            ends[i] = len(words)
        n, width = len(words), min(ANCHOR_WORDS, window)
        if n < window:
            none = np.empty(0, dtype=np.int64)
            return cls(words, ends, none, none, none, none)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(map(digest, words), dtype=np.uint64, count=n)
        grams = np.zeros(n - width + 1, dtype=np.uint64)
        for i in range(width):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - width + 1 + i]
        grams = mixed(grams)
        windows = n - window + 1
        least = grams[:windows].copy()
        for i in range(1, window - width + 1):
            np.minimum(least, grams[i : i + windows], out=least)
        row = np.searchsorted(ends, np.arange(windows), side="right")
        valid = np.flatnonzero(np.arange(windows) + window <= ends[row])
        anchor, row = least[valid].view(np.int64), row[valid]
        new = np.ones(len(valid), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        inside = np.arange(len(valid)) - np.repeat(first, np.diff(np.append(first, len(valid))))
        first = np.flatnonzero(inside % RUN_WINDOWS == 0)
        return cls(words, ends, valid[first], np.diff(np.append(first, len(valid))), anchor[first], row[first])

    def segments(self, i: int, window: int, hot: bool) -> list[tuple[int, int, bytes]]:
        """What is sent of a run: (first window, shard, words).

        All its words go to the shard of its anchor. The windows of a hot anchor go one by one, to the
        shards of their own hashes: where many documents share a passage, the runs at its ends differ
        from document to document, and one shard would get them all.
        """
        begin, count = int(self.begin[i]), int(self.count[i])
        if not hot:
            return [(begin, int(self.anchor[i]), b" ".join(self.words[begin : begin + count + window - 1]))]
        windows = [(at, b" ".join(self.words[at : at + window])) for at in range(begin, begin + count)]
        return [(at, xxhash.xxh64_intdigest(words) - (1 << 63), words) for at, words in windows]


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """Ids as numbers; a null id is larger than all others."""
    return np.array([LAST_ID if x is None else x for x in column.to_pylist()], dtype=np.int64)


def _texts(column: pa.ChunkedArray) -> list[bytes]:
    return strings_as_bytes(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)


def _table(schema: StructType, *columns) -> pa.Table:
    arrow = to_arrow_schema(schema)
    return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _occurrences(docs: pa.Table, id_column: str, text_column: str, window: int) -> pa.Table:
    """A block's anchors, each with the smallest and the largest id it occurs in."""
    runs = Runs.of(_texts(docs.column(text_column)), window)
    ids = _ids(docs.column(id_column))[runs.row]
    order = np.lexsort((ids, runs.anchor))
    anchor, ids = runs.anchor[order], ids[order]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.empty(0, dtype=np.int64)
    last = np.append(first[1:], len(anchor)) - 1 if len(first) else first
    block = np.full(len(first), docs.column("__block")[0].as_py(), dtype=np.int32)
    return _table(_OCCURRENCE, anchor[first], block, ids[first], ids[last])


def _gathered(batches) -> pa.Table | None:
    held = [batch for batch in batches if batch.num_rows]
    return pa.Table.from_batches(held) if held else None


def _repeated(batches, hot_blocks: int):
    """Of anchors that several documents have, the blocks that have them, and whether they are hot."""
    table = _gathered(batches)
    if table is None:
        return
    anchor, block, low, high = (table.column(i).to_numpy() for i in range(4))
    order = np.argsort(anchor, kind="stable")
    anchor = anchor[order]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    several = np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
    blocks = np.diff(np.append(first, len(anchor)))
    kept = np.repeat(several, blocks)
    found = _table(_REPEATED, block[order[kept]], anchor[kept], np.repeat(blocks >= hot_blocks, blocks)[kept])
    yield from found.to_batches(max_chunksize=1 << 16)


def _segments(docs: pa.Table, repeated: pa.Table, id_column: str, text_column: str, window: int) -> pa.Table:
    """A block's distinct runs (or windows) at repeated anchors, each with its smallest and largest id."""
    if not docs.num_rows or not repeated.num_rows:
        return _table(_SEGMENT, [], [], [], [], [], [])
    runs = Runs.of(_texts(docs.column(text_column)), window)
    ids = _ids(docs.column(id_column))
    wanted, hot = _at(runs, repeated)
    seen: dict[tuple[int, bytes], list] = {}
    for i, is_hot, id_ in zip(wanted.tolist(), hot.tolist(), ids[runs.row[wanted]].tolist()):
        for _, shard, words in runs.segments(i, window, is_hot):
            known = seen.get((shard, words))
            if known is None:
                seen[shard, words] = [int(runs.anchor[i]) if is_hot else None, id_, id_]
            else:
                known[1], known[2] = min(known[1], id_), max(known[2], id_)
    shards, words = zip(*seen) if seen else ((), ())
    hot_anchors, low, high = zip(*seen.values()) if seen else ((), (), ())
    block = [docs.column("__block")[0].as_py()] * len(seen)
    return _table(_SEGMENT, shards, hot_anchors, block, words, low, high)


def _at(runs: Runs, repeated: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The runs at repeated anchors, and whether these are hot."""
    anchors, hot = repeated.column("anchor").to_numpy(), repeated.column("hot").to_numpy()
    wanted = np.flatnonzero(np.isin(runs.anchor, anchors))
    return wanted, np.isin(runs.anchor[wanted], anchors[hot.astype(bool)])


def first_ids(segments: list[list[bytes]], low: list[int], window: int) -> list[np.ndarray]:
    """For each window of each segment, the smallest id of the segments that contain it.

    The segments are indexed together; ``low`` has the smallest id of each.
    """
    names: dict[bytes, int] = {}
    symbols: list[int] = []
    begins, owners, counts = [], [], []
    for i, words in enumerate(segments):
        begin = len(symbols)
        symbols += [names.setdefault(word, len(names) + 1) for word in words]
        symbols.append(0)
        counts.append(len(words) - window + 1)
        begins.append(np.arange(begin, begin + counts[-1]))
        owners.append(i)
    lengths = np.array([len(words) + 1 for words in segments], dtype=np.int64)
    text, windows = np.array(symbols, dtype=np.int64), np.concatenate(begins)
    index = FMIndex(text, window)
    ids = np.array(low, dtype=np.int64)
    result = np.repeat(ids, counts)
    alive, a, b = index.shared(windows, window)
    if len(alive):
        by_order = np.append(np.repeat(ids, lengths)[index.order], LAST_ID)
        result[alive] = np.minimum.reduceat(by_order, np.stack((a, b), axis=1).ravel())[::2]
    return np.split(result, np.cumsum(counts)[:-1])


def _matched(batches, window: int, index_words: int):
    """Index the segments of some shards and tell the blocks where their windows first occur.

    Equal windows have equal shards, so indexes are cut between shards. A segment whose windows occur in
    no smaller document than its block's largest one is not reported.
    """
    table = _gathered(batches)
    if table is None:
        return
    shard = table.column("shard").to_numpy()
    order = np.argsort(shard, kind="stable")
    block, words = table.column("block").to_pylist(), table.column("words").to_pylist()
    low, high = table.column("low").to_pylist(), table.column("high").to_pylist()
    hot = table.column("hot_anchor").to_pylist()
    digest = xxhash.xxh3_64_intdigest

    def found(rows: list[int]) -> pa.Table:
        distinct: dict[bytes, int] = {}
        for i in rows:
            distinct[words[i]] = min(distinct.get(words[i], LAST_ID), low[i])
        firsts = dict(zip(distinct, first_ids([x.split(b" ") for x in distinct], list(distinct.values()), window)))
        told = [i for i in rows if firsts[words[i]].min() < high[i]]
        return _table(
            _FOUND, [block[i] for i in told], shard[told], [hot[i] for i in told], [digest(words[i]) - (1 << 63) for i in told], [firsts[words[i]] for i in told]
        )

    rows, size, last = [], 0, None
    for i in order.tolist():
        if size > index_words and shard[i] != last:
            yield from found(rows).to_batches(max_chunksize=1 << 14)
            rows, size = [], 0
        rows.append(i)
        size += words[i].count(b" ") + 2
        last = shard[i]
    if rows:
        yield from found(rows).to_batches(max_chunksize=1 << 14)


def _cleaned(docs: pa.Table, found: pa.Table, id_column: str, text_column: str, window: int, schema: pa.Schema) -> pa.Table:
    """Mark the windows that occur in a document with a smaller id, and drop the words they cover."""
    texts = _texts(docs.column(text_column))
    if not docs.num_rows:
        return schema.empty_table()
    ids = _ids(docs.column(id_column))
    runs = Runs.of(texts, window)
    known = dict(zip(
        zip(found.column("shard").to_pylist(), found.column("segment").to_pylist()), _lists(found.column("first_ids"))
    ))
    change = np.zeros(len(runs.words) + 1, dtype=np.int64)
    digest = xxhash.xxh3_64_intdigest
    shards = np.array(found.column("shard").to_pylist(), dtype=np.int64)
    hot_anchors = np.array([x for x in set(found.column("hot_anchor").to_pylist()) if x is not None], dtype=np.int64)
    for hot in (False, True):
        wanted = np.flatnonzero(np.isin(runs.anchor, hot_anchors if hot else shards))
        for i, id_ in zip(wanted.tolist(), ids[runs.row[wanted]].tolist()):
            for begin, shard, words in runs.segments(i, window, hot):
                firsts = known.get((shard, digest(words) - (1 << 63)))
                if firsts is not None:
                    at = begin + np.flatnonzero(firsts < id_)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + window, -1)
    gone = np.cumsum(change[:-1]) > 0
    before = np.concatenate(([0], np.cumsum(gone)))
    begins = np.concatenate(([0], runs.ends[:-1]))
    n_words, n_removed = runs.ends - begins, before[runs.ends] - before[begins]
    kept = []
    for a, b, removed in zip(begins.tolist(), runs.ends.tolist(), n_removed.tolist()):
        words = runs.words[a:b]
        if removed:
            words = [word for word, off in zip(words, gone[a:b].tolist()) if not off]
        kept.append(b" ".join(words).decode())
    added = [pa.array(n_words), pa.array(n_removed), pa.array(kept, type=pa.string())]
    names = [n for n in docs.column_names if n != "__block"]
    columns = [docs.column(n) for n in names]
    return pa.Table.from_arrays([*columns, *added], schema=schema)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        values, ends = chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())
        out += np.split(values, ends[:-1]) if len(ends) else []
    return out


def _dealt(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, int]:
    """Documents with their __block, and how many blocks there are.

    Blocks follow id and text, so rows without an id, or of one id, are spread too; only rows that repeat
    both stay together.
    """
    total = docs.agg(F.sum(F.octet_length(text_or_empty(text_column)))).first()[0] or 0
    blocks = max(2 * partitions_of(docs), -(-total // BLOCK_BYTES))
    return docs.withColumn("__block", F.pmod(F.xxhash64(id_column, text_column), F.lit(blocks)).cast("int")), blocks


def _hot_from(blocks: int) -> int:
    """In how many of all blocks an anchor is hot."""
    return max(2, int(np.ceil(HOT_SHARE * blocks)))


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 13,
    hot_blocks: int | None = None, index_words: int = INDEX_WORDS,
) -> DataFrame:
    """All columns of ``docs`` and __n_words, __n_removed and __kept (the words that stay, one space between).

    ``docs`` may not have these three columns, or one named __block; ``substring_dedup`` takes any names.
    Words stand between spaces and U+0009 to U+000D and are compared unchanged. A word goes if a window
    of ``window`` words covers it whose sequence also starts in a document with a smaller id. Windows are
    judged on the input. Null texts have no words; texts shorter than a window stay whole; repeats
    inside a document, or between rows of one id, stay; a null id is larger than all others.

    Blocks of documents are cut into runs of windows with one anchor, the smallest hash of four words in a
    window. Anchors that only one document has are left behind (they are summed up per block before they
    are shuffled); for the others the run's words go to the shard of the anchor, once per block. There the
    distinct runs are put into an FM-index, in which each window is searched backwards through a wavelet
    matrix; where it matches elsewhere at full length, the smallest id is that of the suffixes in its
    interval. Blocks get the answers for their runs and drop words. Work grows with the text, not with pairs
    of shards. A passage that a third of all documents share is sent once per block; its ends, where the
    runs differ, are sent window by window to shards of their own (from ``hot_blocks`` blocks on, by
    default ``HOT_SHARE`` of all). An index has some ``index_words`` words. The texts are shuffled once: all three passes over blocks
    read the same exchange.
    """
    dealt, blocks = _dealt(docs, id_column, text_column)
    hot_blocks = _hot_from(blocks) if hot_blocks is None else hot_blocks
    rest = StructType([
        *(StructField(f.name, f.dataType, True) for f in docs.schema),
        StructField("__n_words", LongType()), StructField("__n_removed", LongType()), StructField("__kept", StringType()),
    ])
    arrow_rest = to_arrow_schema(rest)

    def occurrences(block: pa.Table) -> pa.Table:
        return _occurrences(block, id_column, text_column, window)

    def segments(block: pa.Table, repeated: pa.Table) -> pa.Table:
        return _segments(block, repeated, id_column, text_column, window)

    def repeated_of(batches):
        return _repeated(batches, hot_blocks)

    def matched(batches):
        return _matched(batches, window, index_words)

    def cleaned(block: pa.Table, found: pa.Table) -> pa.Table:
        return _cleaned(block, found, id_column, text_column, window, arrow_rest)

    anchors = dealt.groupBy("__block").applyInArrow(occurrences, _OCCURRENCE)
    repeated = anchors.repartition("anchor").mapInArrow(repeated_of, _REPEATED)
    runs = dealt.groupBy("__block").cogroup(repeated.groupBy("block")).applyInArrow(segments, _SEGMENT)
    found = runs.repartition("shard").mapInArrow(matched, _FOUND)
    return dealt.groupBy("__block").cogroup(found.groupBy("block")).applyInArrow(cleaned, rest)


def substring_digests(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 13, **options
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document; see ``without_repeats``."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return without_repeats(rows, "doc_id", "text", window, **options).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )


def substring_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 13, length_column: str | None = None
) -> DataFrame:
    """All documents, with the words that stay; a text that loses none, or is null, is left as it is.

    ``length_column``, if there is one, holds the text's characters and is kept up to date. Other columns
    may have any names.
    """
    plain = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    id_, text, length = plain[id_column], plain[text_column], plain.get(length_column)
    cleaned = without_repeats(docs.toDF(*plain.values()), id_, text, window)
    changed = F.col("__n_removed") > 0
    new = {text: F.when(changed, F.col("__kept")).otherwise(F.col(text))}
    if length:
        characters = F.char_length("__kept").cast(docs.schema[length_column].dataType)
        new[length] = F.when(changed, characters).otherwise(F.col(length))
    return cleaned.select(*(new.get(own, F.col(own)).alias(name) for name, own in plain.items()))
