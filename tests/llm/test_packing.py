import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from helpers import LONG, ROWS, awkward
from paralane.llm.packing import WordEncoder, configurations, knapsack, pack, packed, packed_documents, taken, token_pieces
from test_bpe import texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_equal_those_of_the_library():
    library, encoder, some = Tokenizer.from_file(PATH), WordEncoder(PATH, size=300), [*texts(), "don't I'LL x's,y", "İstanbul ŉ ß"]
    for begin in range(0, len(some), 150):
        part = some[begin : begin + 150]
        for text, ids in zip(part, encoder.encode([t.encode() for t in part])):
            assert np.frombuffer(ids, dtype=np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_word_of_many_texts_is_looked_up_once(monkeypatch):
    encoder, asked = WordEncoder(PATH), []
    look_up = encoder.seen.all
    monkeypatch.setattr(encoder.seen, "all", lambda lists, work: asked.extend(lists) or look_up(lists, work))
    some = [b"", b" the\tof ", b"the the\x0bof\x1cof\xc2\xa0x", b"\n", b"of"]
    library = Tokenizer.from_file(PATH)
    for _ in range(2):
        for text, ids in zip(some, encoder.encode(some)):
            assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text.decode(), add_special_tokens=False).ids
    assert [len(words) for words in asked] == [3, 3] and encoder.encode([]) == []


def test_knapsack():
    random.seed(1)
    for _ in range(40):
        lengths = np.array(sorted(random.sample(range(1, 12), 4)))
        values = np.array([random.random() for _ in range(4)])
        best = {0: 0.0}
        for room in range(1, 21):
            best[room] = max([best[room - 1]] + [best[room - n] + v for n, v in zip(lengths, values) if n <= room])
        value, choice = knapsack(lengths, values, 20)
        assert np.allclose(value, [best[room] for room in range(21)])
        for first in range(4):
            pattern = taken(choice, lengths, 20, first)
            assert sum(lengths[i] * n for i, n in pattern.items()) <= 20
            wanted = values[first] + best[20 - lengths[first]]
            assert abs(sum(values[i] * n for i, n in pattern.items()) - wanted) < 1e-9


def best_fit_decreasing(counts, capacity):
    """The number of sequences, piece by piece."""
    rooms = []
    for length in sorted(counts.elements(), reverse=True):
        at = bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, room - length)
    return len(rooms)


def test_histograms_are_packed_whole():
    random.seed(2)
    for rounds in (0, 40):
        for _ in range(20):
            counts = Counter({random.randint(1, 64): random.randint(1, 300) for _ in range(random.randint(1, 25))})
            patterns = packed(counts, 64, rounds)
            used = Counter()
            for times, contents in patterns:
                assert times > 0 and sum(length * n for length, n in contents) <= 64
                for length, n in contents:
                    used[length] += times * n
            assert used == counts
            sequences = sum(times for times, _ in patterns)
            assert sequences <= 1.02 * best_fit_decreasing(counts, 64) + 2
    assert packed({}, 64) == []


def test_cover_uses_no_length_more_than_it_occurs():
    counts = {24: 1000, 40: 1000, 16: 500, 48: 500}
    used = Counter()
    for times, pattern in configurations(counts, 64, 60):
        for length, n in pattern.items():
            used[length] += times * n
    assert all(used[n] <= counts[n] + 1e-6 for n in counts)
    assert sum(times for times, _ in packed(counts, 64, 60)) == 1500


def test_awkward_rows(spark):
    library = Tokenizer.from_file(PATH)
    rows = packed_documents(awkward(spark, ROWS), PATH, capacity=512).collect()
    wanted, total = Counter(), 0
    for i, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for k in range(-(-len(ids) // 512)):
            part = ids[512 * k : 512 * (k + 1)]
            wanted[i, k, 512 * k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 512
    assert len(sequences) <= -(-total // 512) + 1


def test_pieces_hold_their_ids(spark):
    rows = token_pieces(awkward(spark, [(1, LONG)]).drop("ids"), PATH).collect()
    ids = [i for r in sorted(rows, key=lambda r: r["piece"]) for i in r["ids"]]
    assert ids == [*Tokenizer.from_file(PATH).encode(LONG, add_special_tokens=False).ids, 0]
    assert rows[0]["lang"] is None and rows[0]["shard"] == 7


def test_a_hot_length(spark):
    pieces = spark.range(3000).selectExpr("id as doc_id", "0 as piece", "0 as start", "0L as ids_crc32", "if(id % 3 = 0, 7L, 1 + id % 20) as length")
    rows = pack(pieces, 32).collect()
    sums = Counter()
    for r in rows:
        sums[r["sequence_id"]] += r["length"]
    assert len(rows) == 3000 and max(sums.values()) <= 32 and len(sums) <= -(-sum(sums.values()) // 32) + 3


def test_no_rows(spark):
    assert packed_documents(awkward(spark, []), PATH).count() == 0
