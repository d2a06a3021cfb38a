"""Clipped n-gram overlap of predictions with references: the sums behind BLEU and chrF.

Each row yields a fixed number of integers, which Spark adds up per group. N-grams never
leave the row, so nothing of their number is shuffled.
"""

import re
import string
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from paralane.functions.text import WHITESPACE, text_or_empty

BLEU_ORDER = 4
CHAR_ORDER = 6
# Characters handled at a time: so many that the fixed work of a slice is small beside that of its rows, so
# few that the tables of codes stay close to the processor. A longer row is still handled whole.
SLICE = 100_000
# Words whose pieces a task remembers. They only spare work: when there are more, it begins anew.
KNOWN_WORDS = 1 << 16


# The steps of the 13a tokenizer, in order. The last four act on the inside of
# words, next to which they need to see no more than that there is a space.
ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
WORD_STEPS = (
    (re.compile(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])"), r" \1 "),
    (re.compile(r"([^0-9])([\.,])"), r"\1 \2 "),
    (re.compile(r"([\.,])([^0-9])"), r" \1 \2"),
    (re.compile(r"([0-9])(-)"), r"\1 \2 "),
)


def _text_13a(text: str) -> str:
    """The text whose words the international tokenization of translation scoring takes apart."""
    text = text.rstrip().replace("<skipped>", "").replace("-\n", "")
    if "&" in text:
        for entity, character in ENTITIES:
            text = text.replace(entity, character)
    return text


def _pieces_13a(word: str) -> list[str]:
    if word.isalnum():
        return [word]
    padded = f" {word} "
    for pattern, replacement in WORD_STEPS:
        padded = pattern.sub(replacement, padded)
    return padded.split()


def tokenize_13a(text: str) -> list[str]:
    return [piece for word in _text_13a(text).split() for piece in _pieces_13a(word)]


def _texts_13a(texts: Sequence[str]) -> Sequence[str]:
    """Texts of the same words as those of ``_text_13a``: unchanged if none holds what it replaces."""
    whole = "".join(texts)
    held = any(some in whole for some in (*dict(ENTITIES), "<skipped>", "-\n"))
    return list(map(_text_13a, texts)) if held else texts


def _code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of some texts, as bytes if they are that small, and how many each text has."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    joined = "".join(texts)
    try:
        return np.frombuffer(joined.encode("latin-1"), dtype=np.uint8), sizes
    except UnicodeEncodeError:
        return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), sizes


def _narrow(bits: int) -> type:
    """The smallest type of integers with so many bits whose arrays are worth telling apart."""
    return np.uint8 if bits <= 8 else np.uint16 if bits <= 16 else np.uint32 if bits <= 32 else np.int64


def _dense(sides: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple:
    """Both sides with small numbers for their code points, and how many there are."""
    units = np.concatenate([units for units, _ in sides])
    present = np.zeros(max(int(units.max(initial=0)), 255) + 1, dtype=bool)
    present[units] = True
    numbers = np.cumsum(present) - 1
    parts = np.split(_among(units, numbers.astype(_narrow(int(numbers[-1]).bit_length()))), [len(sides[0][0])])
    return (parts[0], sides[0][1]), (parts[1], sides[1][1]), max(int(present.sum()), 1)


def _table(characters: str) -> np.ndarray:
    """Whether a code point is among some characters; its last entry stands for all above. All bytes have entries."""
    table = np.zeros(max(255, *map(ord, characters)) + 2, dtype=bool)
    table[list(map(ord, characters))] = True
    return table


SPACES, PUNCTUATION = _table(WHITESPACE), _table(string.punctuation)
# What the 13a tokenizer tells apart. It always parts the first; stops and dashes it parts
# by the digits next to them.
APART, STOP, DASH, DIGIT = 1, 2, 4, 8
KINDS = (
    _table("".join(filter(WORD_STEPS[0][0].match, map(chr, range(128))))) * np.uint8(APART),
    _table(".,") * np.uint8(STOP),
    _table("-") * np.uint8(DASH),
    _table(string.digits) * np.uint8(DIGIT),
)
KINDS = sum(KINDS)


def _among(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    if codes.dtype == np.uint8:
        return np.frombuffer(codes.tobytes().translate(table[:256].tobytes()), dtype=table.dtype)
    return table.take(codes, mode="clip")


def _letters(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of some texts that are no whitespace, where among them the texts end, after
    a zero, and where the words begin."""
    codes, sizes = _code_points(texts)
    solid = ~_among(codes, SPACES)
    before = np.concatenate([[False], solid])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    before[ends] = False
    place = np.concatenate([[0], np.cumsum(solid)])
    return codes[solid], place[ends], place[np.flatnonzero(solid & ~before[:-1])]


def _spans(letters: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal spans of letters get equal numbers; then the letters of each distinct span, in their order,
    and where these begin. A span ends where the next one starts."""
    narrow = letters.astype(_narrow(int(letters.max(initial=0)).bit_length()), copy=False)
    offsets = np.append(starts, len(letters)) * narrow.itemsize
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(narrow))]
    spans = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    count, (_, places, values) = len(spans.dictionary), spans.dictionary.buffers()
    places = np.frombuffer(places, dtype=np.int64, count=count + 1) if count else np.zeros(1, dtype=np.int64)
    found = np.frombuffer(values, dtype=narrow.dtype, count=places[-1] // narrow.itemsize) if count else narrow[:0]
    return spans.indices.to_numpy(), found, places[:-1] // narrow.itemsize


def _edge_starts(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The starts of words, and of what is left of them or taken off: one punctuation mark at a word's
    end, or else at its beginning."""
    ends = np.append(starts, len(letters))[1:]
    long = ends - starts > 1
    last = long & _among(letters[ends - 1], PUNCTUATION)
    first = long & ~last & _among(letters[starts], PUNCTUATION)
    return np.sort(np.concatenate([starts, ends[last] - 1, starts[first] + 1]))


class _Cuts(dict):
    """The places inside of words where the 13a tokenizer cuts them."""

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = np.cumsum([0, *map(len, _pieces_13a(word))])[1:-1]
        return found


def _starts_13a(letters: np.ndarray, starts: np.ndarray, cuts: _Cuts) -> np.ndarray:
    """The starts of the pieces of words. The tokenizer adds spaces, so pieces are spans of a word.

    A mark is parted by what it is and by whether digits are next to it. Only where stops or dashes
    follow each other does it matter which the tokenizer takes first; such words are looked up.
    """
    begun = np.zeros(len(letters) + 2, dtype=bool)
    begun[starts] = begun[len(letters)] = True
    kinds = np.append(_among(letters, KINDS), np.uint8(0))
    marks = np.flatnonzero(kinds & (APART | STOP | DASH))
    kind, first, last = kinds[marks], begun[marks], begun[marks + 1]
    left = ~first & (kinds[marks - 1] & DIGIT > 0)
    right = ~last & (kinds[marks + 1] & DIGIT > 0)
    parted = np.where(kind == STOP, ~(left & right), (kind == APART) | left)
    runs = (kind != APART) & ~last & (kinds[marks + 1] & (STOP | DASH) > 0)
    ends = np.append(starts, len(letters))[1:]
    others = np.unique(np.searchsorted(starts, marks[runs], side="right") - 1)
    if len(others):
        home = np.searchsorted(starts, marks, side="right") - 1
        parted &= ~np.isin(home, others)
    parted = marks[parted]
    begun[parted] = begun[parted + 1] = True
    for begin, end in zip(starts[others].tolist(), ends[others].tolist()):
        word = letters[begin:end].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        begun[begin + cuts[word]] = True
    return np.flatnonzero(begun[: len(letters)])


def _sides(units: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Predictions and references, texts of which there are equally many, apart."""
    middle = len(ends) // 2
    sizes = np.diff(ends)
    parts = np.split(units, [ends[middle]])
    return [(parts[0], sizes[:middle]), (parts[1], sizes[middle:])]


class _Words:
    """The words of some texts, each distinct word once, so that it is taken apart once."""

    def __init__(self, letters: np.ndarray, ends: np.ndarray, starts: np.ndarray):
        self.numbers, self.letters, self.starts = _spans(letters, starts)
        self.ends = np.searchsorted(starts, ends)

    def pieces(self, begins: np.ndarray) -> tuple:
        """Both sides as numbers of the pieces of their words, and how many numbers there are. Pieces of
        the distinct words begin at some of their letters."""
        numbers, _, distinct = _spans(self.letters, begins)
        first = np.searchsorted(begins, self.starts)
        counts = np.diff(first, append=len(begins))[self.numbers]
        places = np.concatenate([[0], np.cumsum(counts)])
        units = np.repeat(first[self.numbers] - places[:-1], counts)
        units += np.arange(len(units))
        return *_sides(numbers[units], places[self.ends]), max(len(distinct), 1)


def _changes(ordered: np.ndarray) -> np.ndarray:
    """The digits in which each code differs from the one before it; the first one in all."""
    changes = np.empty_like(ordered)
    changes[:1] = np.iinfo(ordered.dtype).max
    np.bitwise_xor(ordered[1:], ordered[:-1], out=changes[1:])
    return changes


def _runs(units: np.ndarray, width: int, order: int) -> np.ndarray:
    """The units that begin at each place, as many as ``order``, as the digits of one integer. Runs
    double in length, in integers no wider than they need; the last places have none."""
    length = 1
    while length < order:
        more = min(length, order - length)
        wide = units.astype(_narrow((length + more) * width))
        runs = wide[:-length] << (more * width)
        runs |= wide[length:] >> ((length - more) * width)
        units, length = runs, length + more
    return units


def _overlap(
    predicted: tuple[np.ndarray, np.ndarray],
    reference: tuple[np.ndarray, np.ndarray],
    alphabet: int,
    max_order: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per order, three arrays by row: n-grams predicted, n-grams in the reference, matches.

    The code of a place is its row and the units that begin there, as the digits of one integer, so
    codes are exact. Sorted once, the n-grams of every order lie together, as beginnings of the
    longest: where two neighbours differ tells of which orders a new n-gram begins. Before codes
    outgrow 62 bits they are replaced by their ranks, which keep the order.

    After each text stands a unit that only its side has, so what runs past a text's end matches
    nothing. Of c places in a row whose n-grams occur h and r times, (c - sum of |h - r|) / 2 match.
    """
    sizes = np.concatenate([predicted[1], reference[1]])
    n_rows, width = len(predicted[1]), (int(alphabet) + 1).bit_length()
    ends = np.cumsum(sizes + 1)
    n_places = int(ends[-1]) if len(ends) else 0
    units = np.zeros(n_places + 2 * max_order, dtype=_narrow(width))
    inside = np.ones(n_places, dtype=bool)
    inside[ends - 1] = False
    units[:n_places][inside] = np.concatenate([predicted[0], reference[0]])
    units[:n_places] += 2
    side = np.arange(2 * n_rows) >= n_rows
    units[ends - 1] = side
    rows = np.arange(2 * n_rows) % max(n_rows, 1)
    bits, ranked = n_rows.bit_length(), {}
    if bits + max_order * width <= 62:
        kind = _narrow(bits + max_order * width + 1)
        codes = _runs(units, width, max_order)[:n_places].astype(kind)
        codes <<= 1
        codes |= np.repeat((rows << (max_order * width + 1) | side).astype(kind), sizes + 1)
    else:
        codes = np.repeat(rows, sizes + 1)
        for order in range(1, max_order + 1):
            if bits + width > 62:
                ranked[order - 1], codes = np.unique(codes, return_inverse=True)
                bits = len(ranked[order - 1]).bit_length()
            codes <<= width
            codes |= units[order - 1 : order - 1 + n_places]
            bits += width
        codes <<= 1
        codes[ends[n_rows - 1] if n_rows else 0 :] |= 1
    grams = np.sort(codes)
    # How many n-grams of references come before a place; then, how many more predicted ones do. And where
    # the rows begin.
    before = np.zeros(n_places + 1, dtype=np.int32 if n_places < 1 << 30 else np.int64)
    np.cumsum(grams.astype(np.uint8) & np.uint8(1), dtype=before.dtype, out=before[1:])
    last = n_places - 2 * before[-1]
    places = sizes[:n_rows] + sizes[n_rows:] + 2
    starts = np.cumsum(places) - places
    matches, top, low, begins = {}, max_order, 1, None
    changes = _changes(grams)
    for order in range(max_order, 0, -1):
        shift = low + width * (top - order)
        new = np.flatnonzero(changes >= 1 << shift)
        # Where an n-gram begins, a longer one does, so only these places are looked at from now on.
        if begins is None:
            begins, before = new, new.astype(before.dtype) - 2 * before[new]
        else:
            begins, before = begins[new], before[new]
        changes = changes[new]
        surplus = np.empty_like(before)
        np.subtract(before[1:], before[:-1], out=surplus[:-1])
        surplus[-1:] = last - before[-1:]
        np.abs(surplus, out=surplus)
        matches[order] = (places - np.add.reduceat(surplus, np.searchsorted(begins, starts), dtype=np.int64)) >> 1
        if ranked:
            grams = grams[new]
        if order - 1 in ranked:
            grams = ranked[order - 1][grams >> (shift + width)]
            changes, top, low = _changes(grams), order - 1, 0
    for order in range(1, max_order + 1):
        totals = np.maximum(sizes - order + 1, 0)
        yield totals[:n_rows], totals[n_rows:], matches[order]


def _slices(lengths: Sequence[int]) -> Iterator[slice]:
    begin = total = 0
    for row, length in enumerate(lengths):
        if row > begin and total + length > SLICE:
            yield slice(begin, row)
            begin, total = row, 0
        total += length
    if begin < len(lengths):
        yield slice(begin, len(lengths))


def _by_slice(predictions: pd.Series, references: pd.Series, sums, names: list[str]) -> pd.DataFrame:
    predictions, references = predictions.tolist(), references.tolist()
    lengths = [len(one) + len(other) for one, other in zip(predictions, references)]
    parts = [np.stack(sums(predictions[part], references[part]), axis=1) for part in _slices(lengths)]
    values = np.concatenate(parts) if parts else np.empty((0, len(names)), dtype=np.int64)
    return pd.DataFrame(values, columns=names)


def bleu_fields() -> list[str]:
    orders = range(1, BLEU_ORDER + 1)
    return ["hyp_len", "ref_len", *[f"match_{n}" for n in orders], *[f"total_{n}" for n in orders]]


def chrf_fields(word_order: int = 2) -> list[str]:
    orders = [*[f"c{n}" for n in range(1, CHAR_ORDER + 1)], *[f"w{n}" for n in range(1, word_order + 1)]]
    return [f"{kind}_{order}" for order in orders for kind in ("hyp", "ref", "match")]


def _integers(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType()) for name in names])


def row_sums(
    prediction: Column | str, reference: Column | str, word_order: int = 2, bleu: bool = True, chrf: bool = True
) -> Column:
    """A struct of the fields of ``bleu_sums`` and ``chrf_sums`` together: texts are taken apart once for both."""
    names = [*(bleu_fields() if bleu else []), *(chrf_fields(word_order) if chrf else [])]
    cuts = _Cuts()

    def bleu_values(words):
        *sides, alphabet = words.pieces(_starts_13a(words.letters, words.starts, cuts))
        orders = list(_overlap(*sides, alphabet, BLEU_ORDER))
        return [sides[0][1], sides[1][1], *[o[2] for o in orders], *[o[0] for o in orders]]

    def counted(orders):
        return [
            value
            for predicted, wanted, matches in orders
            for value in (np.where(wanted > 0, predicted, 0), wanted, matches)
        ]

    def sums(predictions, references):
        texts = [*predictions, *references]
        known = _letters(texts)
        words = _Words(*known) if bleu or word_order else None
        values = []
        if bleu:
            changed = _texts_13a(texts)
            values += bleu_values(words if changed is texts else _Words(*_letters(changed)))
        if chrf:
            values += counted(_overlap(*_dense(_sides(*known[:2])), CHAR_ORDER))
        if chrf and word_order:
            values += counted(_overlap(*words.pieces(_edge_starts(words.letters, words.starts)), word_order))
        return values

    @F.pandas_udf(_integers(names))
    def row_sums(predictions: pd.Series, references: pd.Series) -> pd.DataFrame:
        return _by_slice(predictions, references, sums, names)

    return row_sums(text_or_empty(prediction), text_or_empty(reference))


def bleu_sums(prediction: Column | str, reference: Column | str) -> Column:
    """A struct of the lengths, clipped matches and totals of a row's word 1- to 4-grams."""
    return row_sums(prediction, reference, chrf=False)


def chrf_sums(prediction: Column | str, reference: Column | str, word_order: int = 2) -> Column:
    """A struct of the n-grams and clipped matches of characters (1 to 6) and of words.

    Predicted n-grams of an order do not count in rows whose reference has none of it.
    """
    return row_sums(prediction, reference, word_order, bleu=False)


def bleu_score(sums: Column | str = "bleu_sums") -> Column:
    """Corpus BLEU, 0 to 100, from summed row values; with exponential smoothing."""
    sums = F.col(sums) if isinstance(sums, str) else sums
    orders = range(1, BLEU_ORDER + 1)
    match = {n: sums[f"match_{n}"] for n in orders}
    total = {n: sums[f"total_{n}"] for n in orders}
    logs = F.lit(0.0)
    doublings = F.lit(0)
    for n in orders:
        none = (match[n] == 0).cast("int")
        doublings = doublings + none
        smoothed = 100.0 / (F.pow(F.lit(2.0), doublings) * total[n])
        logs = logs + F.ln(F.when(match[n] == 0, smoothed).otherwise(100.0 * match[n] / total[n]))
    shortfall = F.lit(1.0) - sums["ref_len"] / sums["hyp_len"]
    brevity = F.when(sums["hyp_len"] >= sums["ref_len"], 1.0).otherwise(F.exp(shortfall))
    scorable = (match[1] + match[2] + match[3] + match[4] > 0) & (
        F.least(*[total[n] for n in orders]) > 0
    )
    return F.when(scorable, brevity * F.exp(logs / BLEU_ORDER)).otherwise(0.0)


def chrf_score(sums: Column | str = "chrf_sums", word_order: int = 2, beta: float = 2.0) -> Column:
    """Corpus chrF, 0 to 100, from summed row values; chrF++ with word order 2."""
    sums = F.col(sums) if isinstance(sums, str) else sums
    precision = recall = F.lit(0.0)
    used = F.lit(0)
    names = chrf_fields(word_order)
    for hyp, ref, match in zip(names[0::3], names[1::3], names[2::3]):
        present = (sums[hyp] > 0) & (sums[ref] > 0)
        precision = precision + F.when(present, sums[match] / sums[hyp]).otherwise(0.0)
        recall = recall + F.when(present, sums[match] / sums[ref]).otherwise(0.0)
        used = used + present.cast("int")
    mean_precision, mean_recall = precision / used, recall / used
    weight = beta * beta
    score = (
        100.0 * (1 + weight) * mean_precision * mean_recall / (weight * mean_precision + mean_recall)
    )
    return F.when((used > 0) & (precision + recall > 0), score).otherwise(0.0)
