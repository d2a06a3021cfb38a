"""Best-fit packing: a configuration linear program over the length histogram, rounded."""

import os
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from paralane.llm.common import Seen, gapless, strings_as_bytes
from paralane.session import materialize

#: Where a word-end vocabulary cuts lower-cased words of Latin-1 characters (fixed values); lines
#: are kept apart.
_LETTERS = "a-zA-Zªµº\xc0-\xd6\xd8-\xf6\xf8-\xff"
_DIGITS = "0-9²³¹¼½¾"
PARTS = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+")
_OTHER = re.compile("[^\n\x21-\x84\x86-\x9f\xa1-\xff]|<\\|")


_SPACES = np.zeros(256, dtype=bool)
_SPACES[list(b" \t\n\r\x0b\x0c")] = True


def numbered_words(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words between ASCII white space of all texts in order, and how many each text has."""
    letters = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    solid = ~_SPACES[letters]
    heads = np.flatnonzero(solid & ~np.concatenate([[False], solid])[:-1])
    place = np.concatenate([[0], np.cumsum(solid)])
    bounds = np.append(place[heads], place[-1])
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(letters[solid])]
    words = pa.Array.from_buffers(pa.large_binary(), len(heads), buffers).dictionary_encode()
    ends = np.cumsum([len(text) + 1 for text in texts])
    return words, np.diff(np.searchsorted(heads, ends), prepend=0)


class Inseparable(Exception):
    """The ids of words that were encoded together cannot be told apart."""


class WordEncoder:
    """The ids of whole texts by the tokenizers library, for a vocabulary that drops white space.

    Words between ASCII white space are independent of each other there, so each is encoded once
    and then looked up. Of new words the parts that are new, in lower case, are encoded together, and
    taken apart at the tokens that end a part of a word; words with other than Latin-1 characters are encoded one by one.
    """

    def __init__(self, path: str, size: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.seen, self.parts = Tokenizer.from_file(path), Seen(size), Seen(size)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(words.values()) + 1, dtype=bool)
        self.ends[[i for word, i in words.items() if word.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32) for x in found]

    def _part_ids(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of new parts of words, encoded together."""
        if not parts:
            return {}
        ids = self._ids(["\n".join(parts)])[0]
        last = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
        if len(parts) != len(last) - 1 or last[-1] != len(ids):
            raise Inseparable
        cuts, flat = (4 * last).tolist(), ids.tobytes()
        return {part: flat[a:b] for part, a, b in zip(parts, cuts, cuts[1:])}

    def _together(self, words: list[bytes], lines: str) -> dict[bytes, bytes] | None:
        """The ids of words of Latin-1 characters, or None if they cannot be told apart."""
        parts = PARTS.findall(lines.lower())
        breaks = [i for i, part in enumerate(parts) if part == "\n"]
        if len(breaks) + 1 != len(words):
            return None
        ends = [at - i for i, at in enumerate([*breaks, len(parts)])]
        try:
            found = self.parts.all([[part for part in parts if part != "\n"]], self._part_ids)[0]
        except Inseparable:
            return None
        return {word: b"".join(found[a:b]) for word, a, b in zip(words, [0, *ends], [*ends[:-1], len(found)])}

    def _work_out(self, words: list[bytes]) -> dict[bytes, bytes]:
        if not words:
            return {}
        lines, alone = b"\n".join(words).decode(), []
        if _OTHER.search(lines):
            alone = [word for word in words if _OTHER.search(word.decode())]
            other = set(alone)
            words = [word for word in words if word not in other]
            lines = b"\n".join(words).decode()
        out = self._together(words, lines) if words else {}
        if out is None:
            out, alone = {}, [*alone, *words]
        out.update((word, ids.tobytes()) for word, ids in zip(alone, self._ids([word.decode() for word in alone])))
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as unsigned 32-bit little-endian numbers.

        The texts' words are numbered together, and only distinct ones are looked up.
        """
        words, counts = numbered_words(texts)
        known = self.seen.all([words.dictionary.to_numpy(zero_copy_only=False).tolist()], self._work_out)[0]
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        flat, codes = np.frombuffer(b"".join(known), dtype=np.uint32), words.indices.to_numpy()
        taken, begins = sizes[codes], np.cumsum(sizes) - sizes
        places = np.concatenate([[0], np.cumsum(taken)])
        ids = flat[np.repeat(begins[codes] - places[:-1], taken) + np.arange(places[-1])]
        ends = (4 * places[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker, which goes on with the words it has seen."""
    return WordEncoder(path)


def _pieces(
    batches: Iterator[pa.RecordBatch], path: str, at: int, capacity: int, end_id: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    encoder, with_ids = word_encoder(path), "ids" in schema.names
    end = np.uint32(end_id).tobytes()
    for batch in batches:
        texts, begin = strings_as_bytes(batch.column(at)), 0
        while begin < batch.num_rows:
            stop, size = begin, 0
            while stop < batch.num_rows and size < 1 << 21:
                size += len(texts[stop])
                stop += 1
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, found in enumerate(encoder.encode(texts[begin:stop]), begin):
                flat = found + end
                for i, a in enumerate(range(0, len(flat), 4 * capacity)):
                    part = flat[a : a + 4 * capacity]
                    rows.append(row)
                    piece.append(i)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype=np.uint32).astype(np.int32))
            carried = [c.take(pa.array(rows, type=pa.int64())) for i, c in enumerate(batch.columns) if i != at]
            made = [
                pa.array(piece, type=pa.int32()), pa.array(start, type=pa.int64()),
                pa.array(length, type=pa.int64()), pa.array(crc, type=pa.int64()),
            ]
            if with_ids:
                made.append(pa.array(ids, type=pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*carried, *made], schema=schema)
            begin = stop


def token_pieces(
    docs: DataFrame, tokenizer: str, text_column: str = "text", capacity: int = 2048, end_id: int = 0, with_ids: bool = True
) -> DataFrame:
    """Each document's ids and then ``end_id``, in pieces of at most ``capacity`` ids.

    Only documents longer than a sequence are cut. The text column is replaced by piece (from 0),
    start, length, ids_crc32 (of the ids as unsigned 32-bit little-endian numbers) and, if wanted,
    ids. Whole texts are encoded; null and empty ones are one piece that holds ``end_id`` alone.
    """
    rest = [f for f in docs.schema if f.name != text_column]
    made = [StructField("piece", IntegerType()), *(StructField(n, LongType()) for n in ("start", "length", "ids_crc32"))]
    if with_ids:
        made.append(StructField("ids", ArrayType(IntegerType())))
    schema = StructType([*rest, *made])
    at = docs.columns.index(text_column)
    work = partial(_pieces, path=tokenizer, at=at, capacity=capacity, end_id=end_id, schema=to_arrow_schema(schema))
    return docs.mapInArrow(work, schema)


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The value of the best multiset that fits each room, and the length to take there (-1: none)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, dtype=np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        k = fitting[room]
        total = values[:k] + best[room - lengths[:k]]
        i = int(k - 1 - total[::-1].argmax())  # of equals the longest: short ones fill gaps later
        if total[i] > best[room - 1]:
            best[room], choice[room] = total[i], i
        else:
            best[room] = best[room - 1]
    return best, choice


def taken(choice: np.ndarray, lengths: np.ndarray, room: int, first: int) -> dict[int, int]:
    """The best multiset that begins with one of length ``first``."""
    pattern = {first: 1}
    room -= int(lengths[first])
    while room > 0:
        i = int(choice[room])
        if i < 0:
            room -= 1
            continue
        pattern[i] = pattern.get(i, 0) + 1
        room -= int(lengths[i])
    return pattern


def configurations(
    counts: dict[int, int], capacity: int, rounds: int = 300, step: float = 1.0, share: float = 0.25, near: float = 0.95
) -> list[tuple[float, dict[int, int]]]:
    """A fractional solution of the configuration program, by multiplicative weights: (times, pattern).

    Each length is a constraint: its pieces are to be covered, none more often than it occurs. A
    round prices the lengths by their weights (which begin at their tokens, the prices that are optimal
    if no room is wasted) and finds the most valuable patterns by dynamic programming. It takes the
    best one and others that share no length with it and are worth ``near`` as much, each for a
    ``share`` of what is left of its scarcest length; the more of a length is covered, the lower its
    weight. Rounds end when all is covered, or at their number.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    amount = np.array([counts[n] for n in lengths.tolist()], dtype=np.float64)
    covered = np.zeros(len(lengths))
    found: dict[tuple, float] = {}
    for _ in range(rounds):
        left = amount * (1 - covered)
        open_ = np.flatnonzero(left >= 1)
        if not len(open_):
            break
        own = lengths[open_]
        values = own * np.exp(-step * (covered[open_] - covered[open_].min()))
        best, choice = knapsack(own, values, capacity)
        total = values + best[capacity - own]
        used: set[int] = set()
        for first in np.argsort(-total, kind="stable").tolist():
            if total[first] < near * best[capacity]:
                break
            pattern = taken(choice, own, capacity, first) if first not in used else None
            if pattern is None or used & pattern.keys():
                continue
            used |= pattern.keys()
            i, n = open_[list(pattern)], np.array(list(pattern.values()), dtype=np.float64)
            most = float((left[i] / n).min())
            times = max(min(1.0, most), share * most)
            covered[i] += times * n / amount[i]
            key = tuple(sorted(zip(i.tolist(), pattern.values())))
            found[key] = found.get(key, 0.0) + times
    plain = lengths.tolist()
    return sorted(
        ((times, {plain[i]: n for i, n in key}) for key, times in found.items()),
        key=lambda x: (-x[0], sorted(x[1].items())),
    )


def packed(counts: dict[int, int], capacity: int, rounds: int = 300) -> list[tuple[int, list[tuple[int, int]]]]:
    """How often to use which pattern so that the whole histogram is packed: (times, [(length, copies)]).

    The fractional solution is rounded down, patterns used most first. Patterns that leave room
    wait for the rest, with which it may be filled. The rest goes best-fit decreasing, over the
    histogram: bins of equal contents are one group, which a length fills whole but for at most one
    split. So the number of patterns depends on ``rounds`` and the capacity, not on the number of pieces.
    """
    left = {length: n for length, n in counts.items() if n}
    done: list[tuple[int, list[tuple[int, int]]]] = []
    if left.get(capacity):
        done.append((left.pop(capacity), [(capacity, 1)]))
    if len(left) > 1 and rounds:
        for times, pattern in configurations(left, capacity, rounds):
            whole = min(int(times), *(left[length] // n for length, n in pattern.items()))
            full = sum(length * n for length, n in pattern.items()) == capacity
            if whole > 0 and full:
                done.append((whole, sorted(pattern.items(), reverse=True)))
                for length, n in pattern.items():
                    left[length] -= whole * n
    rooms: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    sizes: list[int] = []

    def put(room: int, times: int, contents: list[tuple[int, int]]) -> None:
        if room not in rooms:
            rooms[room] = []
            sizes.insert(bisect_left(sizes, room), room)
        rooms[room].append((times, contents))

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                each = min(n, capacity // length)
                times = n // each
                put(capacity - each * length, times, [(length, each)])
                n -= times * each
                continue
            room = sizes[at]
            times, contents = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                sizes.pop(at)
            each = min(room // length, max(1, n // times))
            if times > n:
                put(room, times - n, contents)
                times = n
            put(room - each * length, times, [*contents, (length, each)])
            n -= times * each
    for groups in rooms.values():
        done += groups
    return done


def _placed(batches: Iterator[pa.RecordBatch], table: tuple, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    lengths, firsts, bases, copies, offsets = table
    keys = (lengths << 44) + firsts
    for batch in batches:
        length = batch.column(batch.schema.get_field_index("length")).to_numpy()
        rank = batch.column(batch.schema.get_field_index("__rank_of_length")).to_numpy()
        at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
        inside = rank - firsts[at]
        sequence = bases[at] + inside // copies[at]
        offset = offsets[at] + (inside % copies[at]) * length
        columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != "__rank_of_length"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema=schema)


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece", "start", "ids_crc32"), rounds: int = 300) -> DataFrame:
    """Add sequence_id and offset: pieces packed into as few sequences of ``capacity`` as it can.

    ``pieces`` has a column length from 1 to ``capacity`` and is read twice. Only the histogram of
    lengths reaches the driver. Pieces of a length are numbered without gaps (``order`` tells them
    apart), and the pattern that takes a number is looked up in a table whose size depends on the
    capacity alone. Sequences are numbered from 0; offsets in a sequence leave no gaps.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    numbered = gapless(pieces, "length", list(counts.items()), order, "__rank_of_length")
    used: dict[int, int] = {}
    rows, base = [], 0
    for times, contents in packed(counts, capacity, rounds):
        offset = 0
        for length, each in contents:
            rows.append((length, used.get(length, 0), base, each, offset))
            used[length] = used.get(length, 0) + times * each
            offset += length * each
        base += times
    table = tuple(np.array(column, dtype=np.int64) for column in zip(*sorted(rows))) if rows else (np.zeros(1, dtype=np.int64),) * 5
    schema = StructType([
        *(f for f in numbered.schema if f.name != "__rank_of_length"),
        StructField("sequence_id", LongType()), StructField("offset", LongType()),
    ])
    return numbered.mapInArrow(partial(_placed, table=table, schema=to_arrow_schema(schema)), schema)


def packed_documents(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    Repeated rows and null ids are pieces like others; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    pieces = materialize(token_pieces(rows, tokenizer, "text", capacity, with_ids=False))
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
