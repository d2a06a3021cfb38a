import hashlib
import random

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from helpers import LONG, ROWS, awkward
from paralane.llm.bpe import Decoder, Encoder, Vocabulary, decode, encode, round_trip_digests

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "aAbtEe' \n\t\r\x0b\x1c\x85\xa0 　​é漢字😀09²Ⅷ٣क्षि<|>sre_.,!?́"


def texts():
    random.seed(5)
    for _ in range(1500):
        text = "".join(random.choice(ALPHABET) for _ in range(random.randint(0, 20)))
        yield text + "<|endoftext|>" * (random.random() < 0.1)
    for _ in range(1500):
        yield "".join(chr(random.choice([random.randint(0, 0x2FFF), random.randint(0xE000, 0x1FFFF)])) for _ in range(8))
    yield from ("", "the" * 400, LONG, "a" * 300 + " " * 50)


def test_ids_equal_those_of_the_library():
    library, encoder, some = Tokenizer.from_file(PATH), Encoder(PATH, size=500), list(texts())
    for begin in range(0, len(some), 200):
        part = some[begin : begin + 200]
        for text, ids in zip(part, encoder.encode(part)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_pairs_are_compatible_as_merging_says():
    vocabulary = Vocabulary(PATH)
    assert vocabulary.in_order
    random.seed(6)
    ids = [i for i in vocabulary.bytes if len(vocabulary.bytes[i]) <= 6]
    for _ in range(4000):
        left, right = random.choice(ids), random.choice(ids)
        whole = vocabulary.merged(vocabulary.bytes[left] + vocabulary.bytes[right]) == [left, right]
        assert vocabulary.compatible(left << 24 | right) == whole


def test_awkward_rows_round_trip(spark):
    library = Tokenizer.from_file(PATH)
    found = sorted(map(tuple, round_trip_digests(awkward(spark, ROWS), PATH).collect()), key=str)
    wanted = []
    for i, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text or "")]
        wanted.append((i, len(ids), *digest))
    assert found == sorted(wanted, key=str)


def test_columns_and_no_rows(spark):
    docs = awkward(spark, ROWS[:2]).withColumnRenamed("ids", "other")
    both = decode(encode(docs, PATH), PATH)
    assert [r["decoded"] for r in both.collect()] == [t for _, t in ROWS[:2]]
    assert "shard" in both.columns
    assert round_trip_digests(awkward(spark, []), PATH).count() == 0


def test_ids_that_are_no_text(spark):
    docs = spark.createDataFrame([([128, 50256, 7],), (None,), ([],)], "ids array<int>")
    library = Tokenizer.from_file(PATH)
    rows = [r["decoded"] for r in decode(docs, PATH).collect()]
    assert rows == [library.decode([128, 50256, 7], skip_special_tokens=False), "", ""]


def test_texts_are_gathered_together(monkeypatch):
    """Half characters at the ends of texts, which whole would be beside each other, stay halves."""
    library, some = Tokenizer.from_file(PATH), list(texts())[::7]
    rows = [library.encode(text, add_special_tokens=False).ids for text in some]
    single = Vocabulary(PATH).single
    split = [[single[b] for b in part] for part in ("é".encode()[:1], "é".encode()[1:], b"a\xf0\x9f", b"\x98\x80b", b"\xff")]
    monkeypatch.setattr(Decoder, "MOST", 5)
    for ids in (rows, split, [*rows, *split, []], [], [None, [], split[1]]):
        found = Decoder(PATH).decode(pa.array(ids, pa.list_(pa.int32()))).to_pylist()
        assert found == [library.decode(x or [], skip_special_tokens=False) for x in ids]
