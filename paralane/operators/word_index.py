"""A vocabulary of any size as sorted files in the shared folder, looked up inside each row."""

import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F, types as T

from paralane.session import materialize, new_folder

#: Words that one file holds, about; a file takes 20 bytes a word.
SLICE_WORDS = 1 << 20
#: Slices are told apart by the upper 16 bits of a key.
MOST_SLICES = 1 << 16


def _hashes() -> list[Callable[[Column], Column]]:
    """The two hashes that stand for a word."""
    return [lambda word: F.xxhash64(word), lambda word: F.xxhash64(F.lit(1), word)]


def _key(word: Column) -> Column:
    return F.struct(*[one(word).alias(name) for one, name in zip(_hashes(), ("key", "check"))])


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there; Hadoop writes file:/x for file:///x."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def _slices_of(keys: np.ndarray, slices: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) * np.uint64(slices) >> np.uint64(16)).astype(np.int64)


@lru_cache(maxsize=4096)
def _mapped(path: str) -> pa.Buffer:
    """A file of a mounted folder; the system's page cache holds what is used, once for all tasks of a machine."""
    with pa.memory_map(path, "r") as file:
        return file.read_buffer()


@lru_cache(maxsize=16)
def _fetched(folder: str, name: str) -> pa.Buffer:
    """A file of a store that cannot be mapped; a worker holds the last 16 it used."""
    store, path = _place(folder)
    with store.open_input_file(f"{path}/{name}") as file:
        return file.read_buffer()


@dataclass(frozen=True)
class WordIndex:
    """Where the files of a vocabulary are, and how many words each slice has."""

    folder: str
    rows: tuple[int, ...]

    def _slice(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        store, path = _place(self.folder)
        local = isinstance(store, fs.LocalFileSystem)
        buffer = _mapped(f"{path}/{number}") if local else _fetched(self.folder, str(number))
        n = self.rows[number]
        if buffer.size != 20 * n:
            raise OSError(f"slice {number} of {self.folder} has {buffer.size} bytes, not {20 * n}")
        return (
            np.frombuffer(buffer, np.uint64, n), np.frombuffer(buffer, np.uint64, n, 8 * n),
            np.frombuffer(buffer, np.int32, n, 16 * n),
        )

    def find(self, keys: np.ndarray, checks: np.ndarray, unknown: int) -> np.ndarray:
        """The ids of some words by their hashes. Each distinct key is searched once, in ascending order."""
        codes, distinct = pd.factorize(keys)
        order = np.argsort(distinct)
        asked, place = distinct[order], np.empty(len(distinct), dtype=np.int64)
        place[order] = np.arange(len(distinct))
        back = place[codes]
        found = np.full(len(asked), unknown, dtype=np.int32)
        second = np.zeros(len(asked), dtype=np.uint64)
        known = np.zeros(len(asked), dtype=bool)
        slices = _slices_of(asked, len(self.rows))
        bounds = np.flatnonzero(np.diff(slices, prepend=-1))
        for begin, end in zip(bounds, [*bounds[1:], len(asked)]):
            if self.rows[slices[begin]]:
                own, controls, ids = self._slice(int(slices[begin]))
                at = np.minimum(np.searchsorted(own, asked[begin:end]), len(own) - 1)
                known[begin:end] = own[at] == asked[begin:end]
                second[begin:end], found[begin:end] = controls[at], ids[at]
        return np.where(known[back] & (second[back] == checks), found[back], np.int32(unknown))

    def ids(self, first: pa.ListArray, second: pa.ListArray, unknown: int) -> pa.ListArray:
        """Lists of ids of lists of words, by their two hashes."""
        keys, checks = (part.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for part in (first, second))
        lengths = first.value_lengths().to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.find(keys, checks, unknown)))


def write_word_index(vocab: DataFrame, slice_words: int = SLICE_WORDS) -> WordIndex:
    """Write the columns token and token_id (int) of a vocabulary as an index, now.

    A word is kept as two 64-bit hashes and its id. The vocabulary is shuffled once, by ranges of the
    first hash, and a task writes one range of some ``slice_words`` words: sorted, under a name of its own that is
    renamed at the end, so tasks may be repeated. The driver gets one number per slice, 65,536 at most.
    Two words whose first hashes are equal are an error when the index is written, never a wrong id.
    Tokens are distinct; a null token is left out. No words: an index that finds nothing.
    """
    folder = new_folder(vocab.sparkSession, "words")
    known = materialize(vocab.where(F.col("token").isNotNull()).select(_key(F.col("token")).alias("hash"), "token_id"))
    slices = min(MOST_SLICES, max(1, -(-known.count() // slice_words)))
    upper = F.shiftrightunsigned("hash.key", 48)
    known = known.select(F.floor(upper * slices / MOST_SLICES).cast("int").alias("slice"), "hash.*", "token_id")

    def write(table: pa.Table) -> pa.Table:
        keys, checks = (table.column(name).to_numpy().view(np.uint64) for name in ("key", "check"))
        order = np.argsort(keys)
        keys = keys[order]
        if (keys[1:] == keys[:-1]).any():
            raise ValueError("two words of the vocabulary have one hash")
        number = table.column("slice")[0].as_py()
        store, path = _place(folder)
        store.create_dir(path)
        own = f"{path}/{number}-{uuid.uuid4().hex}"
        with store.open_output_stream(own) as file:
            for part in (keys, checks[order], table.column("token_id").to_numpy().astype(np.int32)[order]):
                file.write(part.tobytes())
        if store.get_file_info(f"{path}/{number}").type == fs.FileType.NotFound:
            store.move(own, f"{path}/{number}")
        else:
            store.delete_file(own)
        return pa.table({"slice": pa.array([number], pa.int32()), "rows": pa.array([len(keys)], pa.int64())})

    rows = [0] * slices
    for slice_, n in known.groupBy("slice").applyInArrow(write, "slice int, rows long").collect():
        rows[slice_] = n
    return WordIndex(folder, tuple(rows))


def indexed_ids(index: WordIndex, words: Mapping[str, Column], unknown: int) -> Column:
    """A struct of arrays of ids of some arrays of words, found inside the row.

    Spark hashes the words, and numpy looks a batch's distinct words up in the files. Nothing is shuffled
    or broadcast, and a task's memory is bounded by its batch and, where files cannot be mapped, 16 slices.
    """
    names = list(words)
    schema = T.StructType([T.StructField(name, T.ArrayType(T.IntegerType())) for name in names])

    @F.arrow_udf(schema)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            parts = rows.flatten()
            found = [index.ids(*parts[i : i + 2], unknown) for i in range(0, len(parts), 2)]
            yield pa.StructArray.from_arrays(found, names)

    # An array per hash: a struct per word would take longer to make and to send than the hashes.
    hashes = [F.transform(some, one).alias(f"{name}{i}") for name, some in words.items() for i, one in enumerate(_hashes())]
    return find.asNondeterministic()(F.struct(*hashes))
