import math
import random
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paralane.functions import overlap as O
from paralane.operators import scores as S


def grams(units, n):
    return Counter(tuple(units[i:i + n]) for i in range(len(units) - n + 1))


def python_bleu(pairs):
    match, total = [0] * 4, [0] * 4
    hyp_len = ref_len = 0
    for hyp, ref in pairs:
        h, r = O.tokenize_13a(hyp), O.tokenize_13a(ref)
        hyp_len, ref_len = hyp_len + len(h), ref_len + len(r)
        for n in range(1, 5):
            a, b = grams(h, n), grams(r, n)
            total[n - 1] += sum(a.values())
            match[n - 1] += sum((a & b).values())
    if not any(match) or not all(total):
        return 0.0
    k, logs = 1, 0.0
    for m, t in zip(match, total):
        if m == 0:
            k *= 2
            logs += math.log(100 / (k * t))
        else:
            logs += math.log(100 * m / t)
    penalty = 1.0 if hyp_len >= ref_len else math.exp(1 - ref_len / hyp_len)
    return penalty * math.exp(logs / 4)


def python_edges(text):
    out = []
    for word in text.split():
        if len(word) > 1 and word[-1] in string.punctuation:
            out += [word[:-1], word[-1]]
        elif len(word) > 1 and word[0] in string.punctuation:
            out += [word[0], word[1:]]
        else:
            out.append(word)
    return out


def python_chrf(pairs, word_order=2):
    sums = [[0, 0, 0] for _ in range(6 + word_order)]
    for hyp, ref in pairs:
        letters = ["".join(side.split()) for side in (hyp, ref)]
        words = [python_edges(side) for side in (hyp, ref)]
        counts = [(grams(letters[0], n), grams(letters[1], n)) for n in range(1, 7)]
        counts += [(grams(words[0], n), grams(words[1], n)) for n in range(1, word_order + 1)]
        for total, (a, b) in zip(sums, counts):
            total[0] += sum(a.values()) if b else 0
            total[1] += sum(b.values())
            total[2] += sum((a & b).values())
    used = [(h, r, m) for h, r, m in sums if h and r]
    if not used:
        return 0.0
    p, r = (sum(m / t[i] for t in used for m in [t[2]]) / len(used) for i in (0, 1))
    return 100 * 5 * p * r / (4 * p + r) if p + r else 0.0


def scored(spark, pairs, **options):
    df = spark.createDataFrame(pairs, "prediction string, tgt string")
    row = S.score_groups(S.with_row_sums(df, **options), word_order=options.get("word_order", 2)).first()
    return row.bleu, row.chrf_pp


def test_tokenizer():
    assert O.tokenize_13a("a, b. 1,000.5 x-y 3-4 &amp;&lt;") == [
        "a", ",", "b", ".", "1,000.5", "x-y", "3", "-", "4", "&", "<"
    ]
    assert O.tokenize_13a("word-\nbreak <skipped>end-\n") == ["wordbreak", "end-"]
    assert O.tokenize_13a("  ") == []


def test_tokenizing_words_is_tokenizing_the_text():
    choose = random.Random(1)
    for _ in range(20000):
        text = "".join(choose.choice("ab5.,- \n\t&;!'कु　$_/") for _ in range(choose.randint(0, 14)))
        whole = text.rstrip().replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
        for entity, character in O.ENTITIES:
            whole = whole.replace(entity, character)
        whole = f" {whole} "
        for pattern, replacement in O.WORD_STEPS:
            whole = pattern.sub(replacement, whole)
        assert whole.split() == O.tokenize_13a(text)


@pytest.fixture(scope="module")
def random_pairs():
    choose = random.Random(5)
    units = ["the", "cat", "sat.", "(on)", "क", "मा", "1,5", "a-b", "-", "!", "😀", "x"]

    def text():
        return choose.choice([" ", "  ", "　"]).join(choose.choice(units) for _ in range(choose.randint(0, 14)))

    pairs = [(text(), text()) for _ in range(400)]
    return pairs + [(t, t + " end") for t, _ in pairs[:100]]


def test_random_pairs_like_python(spark, random_pairs, monkeypatch):
    bleu, chrf = scored(spark, random_pairs)
    assert bleu == pytest.approx(python_bleu(random_pairs), abs=1e-9)
    assert chrf == pytest.approx(python_chrf(random_pairs), abs=1e-9)
    for order in (0, 1, 3):
        found = scored(spark, random_pairs, word_order=order)[1]
        assert found == pytest.approx(python_chrf(random_pairs, order), abs=1e-9)


@pytest.mark.parametrize("alphabet", [0x110000, 1 << 40])
def test_slices_do_not_matter(random_pairs, monkeypatch, alphabet):
    import pandas as pd

    known = [pd.Series(side) for side in zip(*random_pairs)]

    def sums(predictions, references):
        letters = [O._code_points(side) for side in (predictions, references)]
        return [v for order in O._overlap(*letters, alphabet, 6) for v in order]

    names = [str(i) for i in range(18)]
    whole = O._by_slice(*known, sums, names)
    expected = [[sum((grams(h, n) & grams(r, n)).values()) for n in range(1, 7)] for h, r in random_pairs]
    assert whole[names[2::3]].to_numpy().tolist() == expected
    monkeypatch.setattr(O, "SLICE", 7)
    assert O._by_slice(*known, sums, names).equals(whole)
    assert O._by_slice(known[0].iloc[:0], known[1].iloc[:0], sums, names).empty


def test_each_row_by_itself(spark, random_pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(random_pairs)], "i int, prediction string, tgt string")
    rows = S.score_groups(S.with_row_sums(df), ["i"]).collect()
    for row in rows:
        pair = [random_pairs[row.i]]
        assert row.bleu == pytest.approx(python_bleu(pair), abs=1e-9)
        assert row.chrf_pp == pytest.approx(python_chrf(pair), abs=1e-9)


def test_ends_of_the_scale(spark):
    assert scored(spark, [("a b c d", "a b c d")]) == pytest.approx((100, 100))
    assert scored(spark, [("a b c", "a b c")]) == pytest.approx((0, 100))  # no 4-gram
    assert scored(spark, [("a b c d", "x y z w")]) == (0, 0)
    assert scored(spark, [("", "x y z w")]) == (0, 0)
    assert scored(spark, [(None, None)]) == (0, 0)
    bleu, _ = scored(spark, [("the cat sat on the mat", "the cat is on the mat")])
    assert bleu == pytest.approx(python_bleu([("the cat sat on the mat", "the cat is on the mat")]))


def test_evaluation_table(spark, random_pairs):
    rows = [
        (p, t, ["eng_Latn", "npi_Deva", None][i % 3], "mai_Deva", ["d1", None][i % 2])
        for i, (p, t) in enumerate(random_pairs)
    ]
    df = spark.createDataFrame(rows, "prediction string, tgt string, src_lang string, tgt_lang string, domain string")
    plain = {r.direction: r for r in S.evaluate_directions(df).collect()}
    assert set(plain) == {"English -> Maithili", "Nepali -> Maithili"}
    members = [(p, t) for p, t, s, *_ in rows if s == "eng_Latn"]
    english = plain["English -> Maithili"]
    assert english.n_samples == len(members) and english.domain is None
    assert english.bleu == round(python_bleu(members), 2)
    assert english.chrf_pp == round(python_chrf(members), 2)
    found = S.evaluate_directions(df, by_domain=True).collect()
    assert {r.direction: tuple(r)[:5] for r in found if r.is_total} == {d: tuple(r) for d, r in plain.items()}
    split = {(r.direction, r.domain): r for r in found if not r.is_total}
    assert sum(r.n_samples for r in split.values()) == sum(r.n_samples for r in plain.values())
    part = [(p, t) for p, t, s, _, d in rows if s == "npi_Deva" and d == "d1"]
    assert split["Nepali -> Maithili", "d1"].bleu == round(python_bleu(part), 2)
    assert len(split) == 4 and {d for _, d in split} == {None, "d1"}


def test_metrics_of_token_ids(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 0], [1, 2, 3, 4, -100])], "predictions array<int>, labels array<int>")

    def decode(ids):
        return F.array_join(F.transform(ids, lambda i: F.when(i == 0, "").otherwise(i.cast("string"))), " ")

    row = S.make_compute_metrics(decode, pad_id=0)(df).first()
    assert row.asDict() == {"bleu": pytest.approx(100), "chrf++": pytest.approx(100)}
    assert df.select(S.unmask_labels("labels", 9)).first()[0] == [1, 2, 3, 4, 9]


def test_row_sums_are_added_before_the_shuffle(spark, random_pairs):
    df = spark.createDataFrame(random_pairs, "prediction string, tgt string").withColumn("g", F.lit(1))
    plan = S.score_groups(S.with_row_sums(df), ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_pieces_of_a_slice_are_those_of_each_text(random_pairs, monkeypatch):
    choose = random.Random(2)
    units = "ab5.,- \n\t&;!'कु\u3000$_/\u00b2\x1f😀\u4e2d"
    texts = ["".join(choose.choice(units) for _ in range(choose.randint(0, 14))) for _ in range(4000)]
    texts += [text for pair in random_pairs for text in pair]
    assert all(not len(part) for part in O._letters(["", " "])[::2])
    monkeypatch.setattr(O, "KNOWN_WORDS", 50)

    def pieces(letters, ends, starts):
        inside = [starts[(starts >= a) & (starts < b)] for a, b in zip(ends, ends[1:])]
        whole = "".join(map(chr, letters))
        return [[whole[a:b] for a, b in zip(at, [*at[1:], end])] for at, end in zip(inside, ends[1:])]

    letters, ends, starts = O._letters(list(map(O._text_13a, texts)))
    assert pieces(letters, ends, O._starts_13a(letters, starts, O._Cuts())) == list(map(O.tokenize_13a, texts))
    letters, ends, starts = O._letters(texts)
    assert pieces(letters, ends, O._edge_starts(letters, starts)) == list(map(python_edges, texts))


@pytest.mark.parametrize("alphabet", [0x110000, 1 << 40])
def test_all_orders_are_made_by_one_sort(random_pairs, monkeypatch, alphabet):
    sorts, sort = [], O.np.sort
    monkeypatch.setattr(O.np, "sort", lambda codes: sorts.append(len(codes)) or sort(codes))
    letters = [O._code_points(side) for side in zip(*random_pairs)]
    assert len(list(O._overlap(*letters, alphabet, 6))) == 6 and len(sorts) == 1


def test_words_are_looked_up_only_where_stops_or_dashes_follow_each_other(random_pairs, monkeypatch):
    asked, pieces = [], O._pieces_13a
    monkeypatch.setattr(O, "_pieces_13a", lambda word: asked.append(word) or pieces(word))
    choose = random.Random(11)
    single = ["".join(choose.choice(["a", "7", "-", ",", "(", "'", "/", "é"]) for _ in range(9)) for _ in range(3000)]
    single = [word for word in single if not any(a in ".,-" and b in ".,-" for a, b in zip(word, word[1:]))]
    texts = [*(text for pair in random_pairs for text in pair), *single]
    letters, ends, starts = O._letters(texts)
    found = O._starts_13a(letters, starts, O._Cuts())
    assert not asked and len(single) > 1000
    whole = "".join(map(chr, letters))
    parts = [whole[a:b] for a, b in zip(found, [*found[1:], len(whole)])]
    assert parts == [part for text in texts for part in O.tokenize_13a(text)]
    letters, _, starts = O._letters(["1,-2 a..b", "x-y"])
    O._starts_13a(letters, starts, O._Cuts())
    assert asked[-2:] == ["1,-2", "a..b"]


def test_both_scores_come_of_one_pass(spark, random_pairs):
    df = spark.createDataFrame(random_pairs, "prediction string, tgt string")
    plan = S.score_groups(S.with_row_sums(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_sums(") == 1
    both, apart = S.with_row_sums(df), df.withColumns({"b": O.bleu_sums("prediction", "tgt"), "c": O.chrf_sums("prediction", "tgt")})
    assert both.select("bleu_sums.*", "chrf_sums.*").collect() == apart.select("b.*", "c.*").collect()


def test_distinct_words_are_taken_apart_once(monkeypatch):
    known = [O._letters(texts) for texts in (["a,b (x) a,b", "(x) a,b"], ["a,b \u0915, a,b", "\u0915, a,b"])]
    for letters, ends, starts in known:
        words = O._Words(letters, ends, starts)
        assert words.numbers.tolist() == [0, 1, 0, 1, 0] and len(words.starts) == 2
        (first, sizes), (other, others), count = words.pieces(O._starts_13a(words.letters, words.starts, O._Cuts()))
        assert first.tolist()[-len(other) :] == other.tolist() and (sizes.sum(), others.sum()) == (len(first), len(other))
        assert count == len({*first.tolist(), *other.tolist()})


@pytest.mark.parametrize("width, order", [(1, 1), (3, 2), (7, 3), (5, 4), (9, 6), (12, 5), (8, 7)])
def test_runs_of_units_are_digits_of_one_integer(width, order):
    choose = random.Random(order)
    units = [choose.randrange(1 << width) for _ in range(60)] + [0] * 2 * order
    found = O._runs(O.np.array(units, dtype=O._narrow(width)), width, order)
    expected = [sum(units[i + j] << width * (order - 1 - j) for j in range(order)) for i in range(60)]
    assert found[:60].tolist() == expected
