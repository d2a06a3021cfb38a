"""BPE encoding by dynamic programming over prefixes, and decoding."""

import json
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: White space as Unicode defines it (fixed values).
WHITE = "\t-\r \x85\xa0  -     　"
#: The published splitting pattern of byte-level vocabularies (fixed value).
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
#: Coarser pieces whose borders are always borders of the pattern above.
CHUNKS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for the characters from
    U+0100 on, in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class IntTable:
    """Non-negative integers to integers, open addressing, looked up for whole arrays."""

    def __init__(self, bits: int = 18) -> None:
        self.bits, self.count = bits, 0
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << bits, dtype=np.int32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for unknown keys."""
        slot, mask = self.slot(keys), (1 << self.bits) - 1
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def put(self, keys: list[int], values: list[int]) -> None:
        """Add keys that are not there yet."""
        if 2 * (self.count + len(keys)) > 1 << self.bits:
            known = self.keys >= 0
            keys, values = [*self.keys[known].tolist(), *keys], [*self.values[known].tolist(), *values]
            self.__init__(max(self.bits + 1, (2 * len(keys)).bit_length()))
        mask = (1 << self.bits) - 1
        for key, value, slot in zip(keys, values, self.slot(np.array(keys, dtype=np.int64)).tolist()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & mask
            self.keys[slot], self.values[slot] = key, value
        self.count += len(keys)

    def learn(self, keys: np.ndarray, work) -> np.ndarray:
        """The values; ``work`` gives those of unknown keys, one by one, and they are remembered."""
        out = self.get(keys)
        unknown = np.flatnonzero(out < 0)
        if len(unknown):
            new, back = np.unique(keys[unknown], return_inverse=True)
            values = [work(key) for key in new.tolist()]
            self.put(new.tolist(), values)
            out[unknown] = np.array(values, dtype=np.int32)[back]
        return out


class Vocabulary:
    """A byte-level BPE vocabulary with an automaton of the tokens that end at a position.

    The automaton's states are the prefixes of tokens. After any bytes it is in the longest
    state that is a suffix of them; the chain of shorter states that are tokens lists the tokens
    that are suffixes of the bytes, longest first. Transitions beyond the prefixes themselves are
    worked out when first needed.
    """

    MOST_PAIRS = 1 << 20

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        words: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.bytes: dict[int, bytes] = {
            i: bytes(map(letters.__getitem__, word)) for word, i in words.items() if word not in self.special
        }
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        self.in_order = True
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        for rank, (left, right) in enumerate(pairs):
            a, b, whole = words[left], words[right], words[left + right]
            self.merges[a, b] = (rank, whole)
            self.in_order &= whole not in self.made and all(len(self.bytes[x]) == 1 or x in self.made for x in (a, b))
            self.made[whole] = (rank, a, b)
        self.single = {token[0]: i for i, token in self.bytes.items() if len(token) == 1}
        if len(self.single) < 256:
            raise ValueError("the vocabulary lacks a token for some byte")
        self.split = regex.compile(PATTERN)
        marked = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = regex.compile(f"({marked})") if marked else None
        self.fits = IntTable()
        self._build()

    def _build(self) -> None:
        goto: dict[int, int] = {}
        own: list[int] = [-1]
        levels: list[list[tuple[int, int, int]]] = []
        for token_id, token in self.bytes.items():
            if not (self.in_order and token_id in self.made or self.merged(token) == [token_id]):
                continue  # no merges lead to it: the encoding never has it
            state = 0
            for depth, byte in enumerate(token):
                following = goto.get(state << 8 | byte)
                if following is None:
                    following = len(own)
                    own.append(-1)
                    goto[state << 8 | byte] = following
                    if len(levels) <= depth:
                        levels.append([])
                    levels[depth].append((state, byte, following))
                state = following
            own[state] = token_id
        fall = [0] * len(own)
        shorter = [-1] * len(own)  # the next token state down the chain
        for level in levels:
            for state, byte, following in level:
                if state:
                    back = fall[state]
                    while back and back << 8 | byte not in goto:
                        back = fall[back]
                    fall[following] = goto.get(back << 8 | byte, 0)
                below = fall[following]
                shorter[following] = below if own[below] >= 0 else shorter[below]
        self.trie, self.fall = goto, fall
        self.own, self.shorter = np.array(own, dtype=np.int32), np.array(shorter, dtype=np.int32)
        self.first = np.where(self.own >= 0, np.arange(len(own)), self.shorter).astype(np.int32)
        self.lengths = np.zeros(max(self.bytes) + 1, dtype=np.int32)
        for i, token in self.bytes.items():
            self.lengths[i] = len(token)
        self.steps = IntTable()
        self.steps.put(list(goto), list(goto.values()))

    def step(self, key: int) -> int:
        """The state after state ``key >> 8`` and byte ``key & 255``."""
        state, byte = key >> 8, key & 255
        while state and state << 8 | byte not in self.trie:
            state = self.fall[state]
        return self.trie.get(state << 8 | byte, 0)

    def merged(self, token: bytes) -> list[int]:
        """Merge by merge, as BPE is defined; for short strings."""
        parts = [self.single[b] for b in token]
        while True:
            ranked = [(self.merges[pair][0], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in self.merges]
            if not ranked:
                return parts
            at = min(ranked)[1]
            parts[at : at + 2] = [self.merges[parts[at], parts[at + 1]][1]]

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts that a token's first (1) or last (2) byte is in while it is merged, the largest
        first, each with the rank of the merge that ends it."""
        edge = [(token, float("inf"))]
        while (made := self.made.get(token)) is not None:
            token = made[side]
            edge.append((token, made[0]))
        return edge

    def compatible(self, key: int) -> int:
        """1 if the tokens ``key >> 24`` and ``key & 0xFFFFFF`` stay when encoded together, else 0.

        They don't if two parts that meet at the border, both there at the time, are merged: of
        merges of one rank the leftmost comes first. This holds if tokens are made in the order of
        ranks, each by one merge; vocabularies of another kind are merged step by step.
        """
        left, right = key >> 24, key & 0xFFFFFF
        if not self.in_order:
            return int(self.merged(self.bytes[left] + self.bytes[right]) == [left, right])
        starts = self.edge(right, 1)
        for a, a_ends in self.edge(left, 2):
            for b, b_ends in starts:
                merge = self.merges.get((a, b))
                if merge is not None and merge[0] < a_ends and merge[0] <= b_ends:
                    return 0
        return 1

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids (32-bit, as bytes) of pieces of the pattern, all worked on side by side.

        For each prefix, ``last`` has the last token of the prefix's own encoding. It is the only
        token that ends there and is compatible with the last token of what comes before it, so one
        pass finds it; the ids are then read off backwards.
        """
        if not pieces:
            return []
        if self.fits.count > self.MOST_PAIRS:
            self.fits = IntTable()
        order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
        sizes = np.array([len(pieces[i]) for i in order], dtype=np.int64)
        longest, n = int(sizes[0]), len(order)
        letters = np.frombuffer(b"".join(pieces[i].ljust(longest, b"\0") for i in order), dtype=np.uint8)
        letters = np.ascontiguousarray(letters.reshape(n, longest).T).astype(np.int64)
        there = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
        last = np.zeros((longest, n), dtype=np.int32)
        state = np.zeros(n, dtype=np.int64)
        for end in range(1, longest + 1):
            m = int(there[end - 1])
            state = self.steps.learn(state[:m] << 8 | letters[end - 1, :m], self.step).astype(np.int64)
            at, rows = self.first[state], np.arange(m)
            while len(rows):
                token = self.own[at]
                start = end - self.lengths[token]
                fit = start == 0
                inner = np.flatnonzero(~fit)
                pairs = last[start[inner] - 1, rows[inner]].astype(np.int64) << 24 | token[inner]
                fit[inner] = self.fits.learn(pairs, self.compatible) > 0
                last[end - 1, rows[fit]] = token[fit]
                rows, at = rows[~fit], self.shorter[at[~fit]]
        taken, left, rows = [], sizes.copy(), np.arange(n)
        count = np.zeros(n, dtype=np.int64)
        while len(rows):
            token = last[left[rows] - 1, rows]
            taken.append((rows, token))
            left[rows] -= self.lengths[token]
            count[rows] += 1
            rows = rows[left[rows] > 0]
        ends = np.cumsum(count)
        ids = np.empty(int(ends[-1]), dtype=np.int32)
        for back, (rows, token) in enumerate(taken, 1):
            ids[ends[rows] - back] = token
        flat, out, begin = ids.tobytes(), [b""] * n, 0
        for i, end in zip(order, ends.tolist()):
            out[i] = flat[4 * begin : 4 * end]
            begin = end
        return out


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Texts to ids. Words seen before are looked up: in two generations of at most ``size`` words."""

    def __init__(self, path: str, size: int = 400_000) -> None:
        self.vocabulary, self.size = vocabulary(path), size
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _work_out(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of new chunks. Long pieces go by themselves: they would pad all the others."""
        split, pieces = self.vocabulary.split.findall, []
        for chunk in chunks:  # most are one word, which the pattern would leave whole
            whole = (chunk[1:] if chunk[0] == " " else chunk).isalpha()
            pieces.append((chunk.encode(),) if whole else [piece.encode() for piece in split(chunk)])
        distinct = dict.fromkeys((piece for some in pieces for piece in some), b"")
        short = [piece for piece in distinct if len(piece) <= 48]
        for begin in range(0, len(short), 1 << 16):
            some = short[begin : begin + (1 << 16)]
            distinct.update(zip(some, self.vocabulary.encode_pieces(some)))
        for piece in distinct:
            if len(piece) > 48:
                distinct[piece] = self.vocabulary.encode_pieces([piece])[0]
        return {
            chunk: distinct[some[0]] if len(some) == 1 else b"".join(map(distinct.__getitem__, some))
            for chunk, some in zip(chunks, pieces)
        }

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of whole texts; strings of special tokens become their ids."""
        special, marks = self.vocabulary.special, self.vocabulary.marks
        cut: list[list] = []
        for text in texts:
            parts: list = []
            for i, part in enumerate(marks.split(text) if marks and marks.search(text) else (text,)):
                if i % 2:
                    parts.append(special[part])
                else:
                    parts += CHUNKS.findall(part)
            cut.append(parts)
        known = self.new
        missing = {x for parts in cut for x in parts if x not in known}
        known.update({x: self.old[x] for x in missing if x in self.old})
        known.update({x: np.int32(x).tobytes() for x in missing if isinstance(x, int)})
        known.update(self._work_out([x for x in missing if x not in known]))
        out = [np.frombuffer(b"".join(map(known.__getitem__, parts)), dtype=np.int32) for parts in cut]
        for x in missing:
            if isinstance(x, str) and len(x) > 64:
                del known[x]
        if len(known) >= self.size:
            self.old, self.new = known, {}
        return out


def slices(texts: list[str], most: int = 1 << 21) -> Iterator[list[str]]:
    """Texts in runs of about ``most`` characters."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def lists_of_ids(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.int32)
    if ends[-1] >= 2**31:
        raise ValueError("a batch has too many ids; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(values, type=pa.int32()))


def _with_ids(batches: Iterator[pa.RecordBatch], path: str, at: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in batches:
        begin = 0
        for texts in slices([t or "" for t in batch.column(at).to_pylist()]):
            part = batch.slice(begin, len(texts))
            begin += len(texts)
            columns = [c for i, c in enumerate(part.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, lists_of_ids(encoder.encode(texts))], schema=schema)


def encode(docs: DataFrame, tokenizer: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """Replace a text column by the ids of its whole texts (array of int).

    ``tokenizer`` is the path of a byte-level BPE vocabulary (tokenizers' JSON), readable on every
    executor. The ids equal those of the tokenizers library without added special tokens; null and
    empty texts give an empty array. Rows are neither moved nor dropped, other columns pass through,
    and the time is linear in a text's length, however long its words are.
    """
    rest = [f for f in docs.schema if f.name != text_column]
    if ids_column in [f.name for f in rest]:
        raise ValueError(f"there is a column {ids_column} already; name another one")
    schema = StructType([*rest, StructField(ids_column, ArrayType(IntegerType(), False))])
    at = docs.columns.index(text_column)
    return docs.mapInArrow(partial(_with_ids, path=tokenizer, at=at, schema=to_arrow_schema(schema)), schema)


class Decoder:
    """Ids to UTF-8, by gathering the bytes of the tokens of many texts at once."""

    #: Tokens gathered at a time.
    MOST = 1 << 20

    def __init__(self, path: str) -> None:
        known = vocabulary(path)
        table = dict(known.bytes) | {i: mark.encode() for mark, i in known.special.items()}
        tokens = [table.get(i, b"") for i in range(max(table) + 1)]
        self.sizes = np.array([len(token) for token in tokens], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def _gather(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        shift = self.begins[ids] - (np.cumsum(sizes) - sizes)
        return self.bytes[np.repeat(shift, sizes) + np.arange(sizes.sum())]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        flat, lengths = ids.flatten().to_numpy(), ids.value_lengths().fill_null(0).to_numpy()
        places = np.concatenate([[0], np.cumsum(self.sizes[flat])])
        ends = places[np.concatenate([[0], np.cumsum(lengths)])]
        parts = [self._gather(flat[at : at + self.MOST]) for at in range(0, len(flat), self.MOST)]
        data = np.concatenate([*parts, np.empty(0, dtype=np.uint8)])
        firsts = data[ends[:-1][ends[:-1] < len(data)]]
        raw = data.tobytes()
        if len(data) < 2**31 and not ((firsts & 0xC0) == 0x80).any():
            try:  # characters that are whole over all texts, and begin with each text, are whole in each
                raw.decode("utf-8")
                return pa.StringArray.from_buffers(len(ids), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw))
            except UnicodeDecodeError:
                pass
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.string())


def _with_text(batches: Iterator[pa.RecordBatch], path: str, at: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(path)
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            yield pa.RecordBatch.from_arrays([*part.columns, decoder.decode(part.column(at))], schema=schema)


def decode(encoded: DataFrame, tokenizer: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """Add the text of an id column; special tokens are written out.

    Bytes that are no UTF-8 become U+FFFD, as when a token is decoded that holds half a character.
    Null ids and empty arrays give an empty text.
    """
    schema = StructType([*encoded.schema, StructField(text_column, StringType())])
    at = encoded.columns.index(ids_column)
    return encoded.mapInArrow(partial(_with_text, path=tokenizer, at=at, schema=to_arrow_schema(schema)), schema)


def round_trip_digests(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    both = decode(encode(rows, tokenizer), tokenizer)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
