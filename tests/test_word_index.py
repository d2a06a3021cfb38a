import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paralane.operators import tokens as T
from paralane.operators.word_index import WordIndex, _place, write_word_index

SCHEMA = "i int, src string, tgt string, src_lang string, tgt_lang string"


@pytest.fixture
def pairs(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(400)] + ["é", "日本", "a", "a", "a"]
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    rows = [(i, text(random.randint(0, 30)), text(5), "en", "ne") for i in range(200)]
    rows += [(200, None, "", "en", "ne"), (201, "  \t ", None, None, None), (202, text(50_000), "a", "en", "ne"), (200, "a a", "a", "en", "ne")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("slice_words", [1 << 20, 10])
@pytest.mark.parametrize("limit", [None, 4])
def test_same_rows_as_the_join(spark, pairs, monkeypatch, slice_words, limit):
    monkeypatch.setattr(T, "write_word_index", lambda vocab: write_word_index(vocab, slice_words))
    vocab = T.vocabulary(pairs.where("i % 2 = 0"), ["src"])  # half of the words of other rows are unknown
    found, joined = (T.tokenize_words(pairs, vocab, ["i"], limit, lookup=lookup) for lookup in ("index", "join"))
    assert found.dtypes == joined.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, joined.collect()))


def test_no_word_is_shuffled_or_broadcast(spark, pairs):
    found = T.tokenize_words(pairs, T.vocabulary(pairs, ["src"]), ["i"], lookup="index")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan


def test_slices_hold_every_word_once(spark):
    vocab = spark.range(5000).select(F.col("id").cast("string").alias("token"), F.col("id").cast("int").alias("token_id"))
    index = write_word_index(vocab, 100)
    assert len(index.rows) == 50 and sum(index.rows) == 5000 and max(index.rows) < 200
    folder = _place(index.folder)[1]
    assert sorted(os.listdir(folder), key=int) == [str(i) for i in range(50)]
    ids = np.concatenate([index._slice(i)[2] for i in range(50)])
    assert sorted(ids) == list(range(5000))


def test_words_of_one_key_are_told_apart_by_the_second_hash(spark):
    index = write_word_index(spark.createDataFrame([("a", 7)], "token string, token_id int"))
    key, check, _ = index._slice(0)
    asked = np.array([key[0], key[0] + 1], np.uint64)
    assert index.find(asked, np.array([check[0], check[0]], np.uint64), 1).tolist() == [7, 1]
    both = np.array([key[0], key[0]], np.uint64), np.array([check[0] + 1, check[0]], np.uint64)
    assert index.find(*both, 1).tolist() == [1, 7]


def test_repeated_tokens_are_an_error(spark):
    with pytest.raises(Exception, match="one hash"):
        write_word_index(spark.createDataFrame([("a", 7), ("a", 8)], "token string, token_id int"))


def test_empty_vocabulary_and_empty_table(spark, pairs):
    none = spark.createDataFrame([(None, 3)], "token string, token_id int").where("token_id = 4")
    found = T.encode_words(pairs, none, {"ids": "tgt"}, ["i"], lookup="index").collect()
    assert {token for r in found for token in r.ids} == {T.UNKNOWN_ID, T.EOS_ID}
    assert T.encode_words(pairs.limit(0), none, {"ids": "tgt"}, ["i"], lookup="index").collect() == []


def test_a_lost_file_is_an_error():
    index = WordIndex("/nowhere/at/all", (3,))
    with pytest.raises(OSError):
        index.find(np.array([1], np.uint64), np.array([1], np.uint64), 1)
