import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from paralane.functions import text as X
from paralane.functions.unicode import normalize_text, unicode_form
from paralane.registry import DEVANAGARI, DISPLAY_NAMES

SPACES = [chr(i) for i in range(0x110000) if chr(i).isspace()]
ALPHABET = [
    *SPACES, "a", "Z", "5", "é", "é", "क", "ु", "१", "½", "_", ".", "-",
    "‍", "​", "﻿", "\U0001f600",
]


@pytest.fixture(scope="module")
def texts():
    choose = random.Random(7)
    made = ["".join(choose.choice(ALPHABET) for _ in range(choose.randint(0, 12))) for _ in range(3000)]
    return ["", " ", *made]


def results(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def test_whitespace_is_python_whitespace():
    assert sorted(X.WHITESPACE) == SPACES


def test_strip_and_words_are_python_strip_and_split(spark, texts):
    assert results(spark, texts, X.strip("t")) == [t.strip() for t in texts]
    assert results(spark, texts, X.words("t")) == [t.split() for t in texts]
    assert results(spark, texts, X.word_count("t")) == [len(t.split()) for t in texts]


def test_collapse_and_zero_width(spark, texts):
    assert results(spark, texts, X.collapse_spaces("t")) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    dropped = results(spark, texts, X.drop_zero_width("t"))
    assert dropped == [re.sub("[​-‏﻿]", "", t) for t in texts]


def test_content_is_what_is_not_digits_spaces_or_marks(spark, texts):
    bare = re.compile(r"^[\d\s\W]*$")
    assert results(spark, texts, X.has_content("t")) == [not bare.match(t.strip()) for t in texts]


def test_counts(spark, texts):
    letters = [sum(c.isascii() and c.isalpha() for c in t) for t in texts]
    assert results(spark, texts, X.ascii_letters("t")) == letters
    lengths = [len(t.replace(" ", "")) for t in texts]
    assert results(spark, texts, X.length_without_spaces("t")) == lengths


@pytest.mark.parametrize("form", ["NFC", "NFD", "NFKC", "NFKD"])
def test_unicode_forms(spark, texts, form):
    assert results(spark, texts, unicode_form("t", form)) == [unicodedata.normalize(form, t) for t in texts]


def test_every_character_that_a_form_touches_reaches_it(spark):
    characters = [chr(i) for i in range(0x3000) if not 0xD800 <= i < 0xE000]
    for form in ("NFC", "NFKC"):
        marked = [c + "́" for c in characters]
        expected = [unicodedata.normalize(form, c) for c in marked]
        assert results(spark, marked, unicode_form("t", form)) == expected


def test_unknown_form():
    with pytest.raises(ValueError):
        unicode_form("t", "NFX")


def test_normalize(spark):
    given = ["é", "क‍ष", "a\t  b ", None]
    assert results(spark, given, normalize_text("t")) == ["é", "कष", "a b", ""]


def test_normalize_twice_changes_nothing(spark, texts):
    plain = [t for t in texts if not set(t) & {"‍", "​", "﻿"}]
    once = results(spark, plain, normalize_text("t"))
    assert results(spark, once, normalize_text("t")) == once


def test_directions(spark):
    df = spark.createDataFrame([("eng_Latn", "npi_Deva", "x"), ("eng_Latn", "zz", None)], "src_lang string, tgt_lang string, src string")
    rows = df.select(
        X.raw_direction(), X.display_direction(DISPLAY_NAMES), X.metric_key(X.display_direction(DISPLAY_NAMES), "bleu"),
        X.tagged_input(), X.in_script("tgt_lang", DEVANAGARI),
    ).collect()
    assert tuple(rows[0]) == (
        "eng_Latn -> npi_Deva", "English -> Nepali", "English_to_Nepali/bleu", "eng_Latn npi_Deva x", True,
    )
    assert tuple(rows[1]) == ("eng_Latn -> zz", "English -> zz", "English_to_zz/bleu", "eng_Latn zz ", False)


def test_question_mark_and_hash(spark):
    assert results(spark, ["क؟ ?"], X.repair_question_mark("t")) == ["क? ?"]
    assert results(spark, ["\u00e9"], X.sha256_hex(F.col("t"))) == [
        "4a99557e4033c3539de2eb65472017cad5f9557f7a0625a09f1c3f6e2ba69c4c"
    ]
