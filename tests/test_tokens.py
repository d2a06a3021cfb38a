import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paralane.operators import tokens as T
from paralane.operators.translate import repair_predictions, translate_table

ROWS = [
    (1, "a b a", "x y", "en", "ne"), (2, "", "b　a", "en", "ne"), (3, None, None, "ne", "en"),
    (4, "c new words here", "x", "ne", "en"),
]
SCHEMA = "i int, src string, tgt string, src_lang string, tgt_lang string"


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def python_vocabulary(texts):
    words = {w for t in texts for w in (t or "").split()}
    ordered = sorted(words, key=lambda w: hashlib.sha256(w.encode()).hexdigest())
    return {w: i + T.FIRST_ID for i, w in enumerate(ordered)}


def test_vocabulary(spark, pairs):
    rows = T.vocabulary(pairs, ["src", "tgt"]).collect()
    assert {r.token: r.token_id for r in rows} == python_vocabulary([t for r in ROWS for t in r[1:3]])
    assert {r.token: r.n for r in rows}["a"] == 3


@pytest.mark.parametrize("hot, lookup", [(1.0, "broadcast"), (0.0, "join"), (0.2, "join"), (2.0, "join")])
@pytest.mark.parametrize("limit", [2, 4, None])
def test_encoding(spark, pairs, monkeypatch, hot, lookup, limit):
    """Whether words are looked up by broadcast or by shuffle does not matter."""
    monkeypatch.setattr(T, "HOT_SHARE", hot)
    known = python_vocabulary([r[2] for r in ROWS])
    vocab = T.vocabulary(pairs, ["tgt"])
    rows = T.tokenize_words(pairs, vocab, ["i"], limit, tagged=False, lookup=lookup).collect()

    def ids(text):
        found = [known.get(w, T.UNKNOWN_ID) for w in (text or "").split()]
        return (found if limit is None else found[: limit - 1]) + [T.EOS_ID]

    found = {r.i: (r.input_ids, r.attention_mask, r.labels) for r in rows}
    assert found == {i: (ids(s), [1] * len(ids(s)), ids(t)) for i, s, t, *_ in ROWS}


def test_encoding_without_end(spark, pairs):
    rows = T.encode_words(pairs, T.vocabulary(pairs, ["src"]), {"ids": "src"}, ["i"], 2, eos=False).collect()
    assert {r.i: len(r.ids) for r in rows} == {1: 2, 2: 0, 3: 0, 4: 2}


@pytest.mark.parametrize("lookup", ["broadcast", "join"])
def test_rows_of_equal_keys_stay_apart(spark, lookup):
    df = spark.createDataFrame([(1, "a b"), (1, "c"), (1, "c")], "i int, src string")
    vocab = T.vocabulary(df, ["src"])
    rows = T.encode_words(df, vocab, {"ids": "src"}, ["i"], lookup=lookup).collect()
    known = python_vocabulary(["a b c"])
    assert sorted(r.ids for r in rows) == sorted([[known["a"], known["b"], 2], [known["c"], 2], [known["c"], 2]])


def test_lookups_stay_in_the_row(spark, pairs):
    vocab = T.vocabulary(pairs, ["src"])
    plan = T.tokenize_words(pairs, vocab, ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_vocabulary_that_is_too_large_to_broadcast(spark, pairs):
    with pytest.raises(ValueError, match="lookup='join'"):
        T.tokenize_words(pairs, T.vocabulary(pairs, ["src"]), ["i"], broadcast_bytes=10)
    with pytest.raises(ValueError, match="unknown lookup"):
        T.tokenize_words(pairs, T.vocabulary(pairs, ["src"]), ["i"], lookup="guess")


def test_masks_may_be_arrays(spark, pairs):
    def make():
        def tokenize(sources, targets, src_lang, tgt_lang):
            ids = np.ones((len(sources), 3), dtype=np.int32)
            return {"input_ids": ids, "attention_mask": ids, "labels": ids[:, :1]}

        return tokenize

    rows = T.tokenize_with(pairs, make, ["i"]).collect()
    assert all(r.attention_mask == [1, 1, 1] and r.labels == [1] for r in rows) and len(rows) == 4


def test_user_tokenizer(spark, pairs):
    def make():
        def tokenize(sources, targets, src_lang, tgt_lang):
            assert all(s.startswith(f"{src_lang} {tgt_lang} ") for s in sources)
            return {"input_ids": [list(map(len, s.split())) for s in sources], "labels": [[len(t)] for t in targets]}

        return tokenize

    df = T.tokenize_with(pairs, make, ["i"], max_length=4)
    assert df.dtypes == [("i", "int"), *[(c, "array<int>") for c in T.TOKEN_COLUMNS]]
    found = {r.i: (r.input_ids, r.attention_mask, r.labels) for r in df.collect()}
    assert found[1] == ([2, 2, 1, 1], [1] * 4, [3])
    assert found[2] == ([2, 2], [1, 1], [3])
    assert found[3] == ([2, 2], [1, 1], [0]) and len(found) == 4


def python_batch(rows, pad_id, start_id):
    """Pad a batch the way a sequence-to-sequence collator does."""
    up = lambda n: -(-n // 8) * 8
    inputs, labels = up(max(len(r[0]) for r in rows)), up(max(len(r[1]) for r in rows))
    out = []
    for ids, wanted in rows:
        padded = wanted + [-100] * (labels - len(wanted))
        shown = [pad_id if t == -100 else t for t in padded]
        out.append((
            ids + [pad_id] * (inputs - len(ids)), [1] * len(ids) + [0] * (inputs - len(ids)), padded,
            [start_id] + shown[:-1] if shown else [],
        ))
    return out


def test_padding(spark):
    lengths = [(3, 9), (8, 1), (0, 0), (17, 2), (1, 8), (2, 16), (5, 5)]
    rows = [(list(range(10, 10 + a)), list(range(50, 50 + b))) for a, b in lengths]
    df = spark.createDataFrame(
        [(i, a, [1] * len(a), b) for i, (a, b) in enumerate(rows)],
        "rank long, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )
    for size in (1, 3, 7, 50):
        batches = T.padded_batches(df, batch_size=size, pad_id=1, start_id=2).orderBy("rank").collect()
        expected = [b for i in range(0, 7, size) for b in python_batch(rows[i:i + size], 1, 2)]
        assert [(b.input_ids, b.attention_mask, b.labels, b.decoder_input_ids) for b in batches] == expected
        assert [b.batch_id for b in batches] == [i // size for i in range(7)]
    given = df.withColumn("decoder_input_ids", F.lit("given"))
    assert T.padded_batches(given).first().decoder_input_ids == "given"


def test_truncation(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "ids array<int>")
    assert df.select(T.truncate_ids("ids", 2)).first()[0] == [1, 2]


def test_translation(spark, pairs):
    def make():
        calls = []

        def translate(texts, src_lang, tgt_lang):
            calls.append(len(texts))
            assert len(texts) <= 2
            return [f"{src_lang}>{tgt_lang}:{text}؟" for text in texts]

        return translate

    many = pairs.unionByName(pairs).unionByName(pairs).coalesce(1)
    rows = translate_table(many, make, batch_size=2).collect()
    assert len(rows) == 12
    assert all(r.prediction == f"{r.src_lang}>{r.tgt_lang}:{r.src or ''}?" for r in rows)
    raw = translate_table(
        pairs, make, repair_question_marks=False, batch_size=2,
        preprocess=lambda texts, s, t: [x.upper() for x in texts],
        postprocess=lambda texts, s, t: [x + "!" for x in texts],
    )
    assert {r.i: r.prediction for r in raw.collect()}[1] == "en>ne:A B A؟!"
    assert repair_predictions(raw).first().prediction.endswith("?!")


def test_unknown_directions_are_translated_too(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", "y", "x")], "src string, src_lang string, tgt_lang string")
    rows = translate_table(df, lambda: lambda texts, s, t: [t.upper() for t in texts]).collect()
    assert sorted(r.prediction for r in rows) == ["A", "B"]


def test_a_filter_on_predictions_does_not_translate_again(spark, pairs):
    made = translate_table(pairs, lambda: lambda texts, s, t: texts).where("prediction <> ''")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [predict") == 1


@pytest.mark.parametrize("name", ["token_ids", "padded_token_batches", "prepared_tokens"])
def test_queries_take_vocabularies_of_any_size(spark, monkeypatch, name):
    from paralane.plans.queries import QUERIES

    *others, _ = T.encode_words.__defaults__
    monkeypatch.setattr(T.encode_words, "__defaults__", (*others, 0))  # no vocabulary may be broadcast
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


@pytest.mark.parametrize("limit, plan", [(1 << 20, False), (10, True)])
def test_the_vocabulary_size_decides_the_lookup(spark, pairs, limit, plan):
    """A small vocabulary is looked up in the row, a larger one joined; no size is an error."""
    vocab = T.vocabulary(pairs, ["src", "tgt"])
    chosen = T.tokenize_words(pairs, vocab, ["i"], tagged=False, lookup="auto", broadcast_bytes=limit)
    joined = T.tokenize_words(pairs, vocab, ["i"], tagged=False, lookup="join")
    assert sorted(map(str, chosen.collect())) == sorted(map(str, joined.collect()))
    assert ("Join" in chosen._jdf.queryExecution().toString()) is plan


def test_truncated_ids_shuffle_no_words(spark):
    """Texts are shuffled to pair documents, and words not at all."""
    from paralane.plans.queries import QUERIES

    plan = QUERIES["truncated_token_ids"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "posexplode_outer" not in plan
