import random
import re

import pytest
from pyspark.sql import functions as F

from paralane.operators import rules as R
from paralane.plans.prepare import validate

SCHEMA = "id int, src string, tgt string, src_lang string, tgt_lang string"
WORDS = " ".join(["w"] * 201)

EDGES = [
    (None, "a b c", "npi_Deva", "min_length"),
    ("a b", "क ख ग", "npi_Deva", "min_length"),
    (WORDS, WORDS, "eng_Latn", "max_length"),
    ("a b c", "a b c d e f g h i j k", "eng_Latn", "length_ratio"),
    ("a b c", " a b c ", "eng_Latn", "not_identical"),
    ("12 34 56", "क ख ग", "npi_Deva", "not_empty_or_numeric"),
    ("१२ ३४ ५६", "a b c", "eng_Latn", "not_empty_or_numeric"),
    ("_ _ _", "a b c", "eng_Latn", None),
    ("½ ½ ½", "a b c", "eng_Latn", None),
    ("a b c", "abc क ख", "npi_Deva", "devanagari_ascii_ratio"),
    ("a b c", "abc d e", "eng_Latn", None),
    ("a b c", "abc d e", None, None),
    ("a b　c", "क ख ग", "npi_Deva", None),
]


def python_reason(src, tgt, tgt_lang, limit=0.2):
    """The rules on plain Python strings."""
    src, tgt = src or "", tgt or ""
    s, t = len(src.split()), len(tgt.split())
    if s < 3 or t < 3:
        return "min_length"
    if s > 200 or t > 200:
        return "max_length"
    if max(s, t) / max(min(s, t), 1) > 3.5:
        return "length_ratio"
    if src.strip() == tgt.strip():
        return "not_identical"
    if any(re.match(r"^[\d\s\W]+$", side.strip()) for side in (src, tgt)):
        return "not_empty_or_numeric"
    if tgt_lang in ("npi_Deva", "mai_Deva"):
        bare = tgt.strip()
        if sum(c.isascii() and c.isalpha() for c in bare) / len(bare.replace(" ", "")) > limit:
            return "devanagari_ascii_ratio"
    return None


def all_rules(**options):
    return R.build_rules(max_ascii_ratio_devanagari=0.2, **options)


def pairs(spark, rows):
    return spark.createDataFrame(
        [(i, s, t, "eng_Latn", lang) for i, (s, t, lang) in enumerate(rows)], SCHEMA
    )


def reasons(spark, rows, rules):
    tagged = R.tag_rejections(pairs(spark, rows), rules)
    return [row.reject_reason for row in tagged.orderBy("id").collect()]


def test_edges(spark):
    found = reasons(spark, [edge[:3] for edge in EDGES], all_rules())
    assert found == [edge[3] for edge in EDGES]


def test_random_pairs_like_python(spark):
    choose = random.Random(3)
    units = ["a", "b", "12", "क", "खु", "१", ".", "_", "½", "zz", "\u3000"]

    def side():
        return " ".join(choose.choice(units) for _ in range(choose.choice([1, 3, 4, 5, 12, 190, 201])))

    rows = [(side(), side(), choose.choice(["npi_Deva", "eng_Latn", "mai_Deva", None])) for _ in range(1500)]
    rows += [(s, s, lang) for s, _, lang in rows[:50]]
    assert reasons(spark, rows, all_rules()) == [python_reason(*row) for row in rows]


def test_chain_follows_its_options(spark):
    names = [rule.name for rule in R.build_rules()]
    assert names == ["min_length", "max_length", "length_ratio", "not_identical", "not_empty_or_numeric"]
    short = R.build_rules(reject_identical_pairs=False, reject_empty_or_numeric=False)
    assert [rule.name for rule in short] == ["min_length", "max_length", "length_ratio"]
    assert reasons(spark, [("a b c", "a b c", "eng_Latn")], short) == [None]


def test_a_zero_minimum_still_rejects_no_content(spark):
    assert reasons(spark, [("", "a b", "eng_Latn")], R.build_rules(min_word_len=0, max_length_ratio=9)) == [
        "not_empty_or_numeric"
    ]


def test_user_rules(spark):
    column = ("no_x", ~F.contains("src", F.lit("x")))
    python = R.python_rule("tgt_has_q", lambda row: "q" in (row["tgt"] or ""), ["tgt"])
    rules = R.build_rules(extra=[column, python])
    rows = [("a b x", "q r s", "eng_Latn"), ("a b c", "d e f", "eng_Latn"), ("a b c", "q e f", "eng_Latn")]
    assert reasons(spark, rows, rules) == ["no_x", "tgt_has_q", None]


def test_python_rules_see_only_what_is_left(spark):
    def no_short_sources(rows):
        assert (rows["src"].str.split().map(len) >= 3).all()
        return rows["tgt"] != "d e f"

    rules = R.build_rules(extra=[R.vector_rule("not_def", no_short_sources, ["src", "tgt"]), ("last", F.col("src") != "k l m")])
    rows = [("a", "x", "y"), ("a b c", "d e f", "y"), ("a b c", "d e g", "y"), ("k l m", "d e g", "y"), ("b", "d e f", "y")]
    assert reasons(spark, rows, rules) == ["min_length", "not_def", None, "last", "min_length"]


def test_names_of_rules_are_unique(spark):
    with pytest.raises(ValueError, match="max_length"):
        R.build_rules(extra=[("max_length", F.lit(True))])
    with pytest.raises(ValueError, match="several rules"):
        R.tag_rejections(pairs(spark, []), [R.min_length(), R.min_length(4)])


def test_report(spark):
    rows = [edge[:3] for edge in EDGES] + [("a b c", "other words here", "eng_Latn")]
    rules = all_rules(reject_identical_pairs=False)
    tagged = R.tag_rejections(pairs(spark, rows), rules)
    report = R.validation_report(tagged, rules).first().asDict()
    expected = [python_reason(*row) for row in rows]
    kept = [row for row, reason in zip(rows, expected) if reason in (None, "not_identical")]
    assert report["total_input"] == len(rows)
    assert report["total_output"] == len({row[0] for row in kept})
    assert report["duplicates_removed"] == len(kept) - report["total_output"]
    assert report["rejected_identical"] == 0 and "not_identical" not in report["per_rule_rejections"]
    assert report["rejected_too_short"] == 2 == report["per_rule_rejections"]["min_length"]
    rejected = sum(report["per_rule_rejections"].values())
    assert rejected + report["duplicates_removed"] + report["total_output"] == report["total_input"]
    assert report["retention_percent"] == round(100 * report["total_output"] / len(rows), 1)


def test_report_of_an_empty_table(spark):
    report = validate(pairs(spark, [("a", "b", "x")]).limit(0), ["id"]).report.first()
    assert report.total_input == report.total_output == report.duplicates_removed == 0
    assert report.retention_percent == 0


def test_validate_counts_what_it_keeps(spark):
    rows = [edge[:3] for edge in EDGES] * 3
    for on in ("src", ["src", "tgt"], ["src", "tgt_lang"]):
        checked = validate(pairs(spark, rows), ["id"], all_rules(), on)
        assert checked.rows.count() == checked.report.first().total_output


def test_counts_are_not_computed_again_for_the_filter(spark):
    plan = R.kept(R.tag_rejections(pairs(spark, [("a", "b", "c")]), all_rules()))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("split(") == 2


@pytest.mark.parametrize("partitions", [1, 7])
def test_partitions_do_not_matter(spark, partitions):
    rows = [edge[:3] for edge in EDGES] * 4
    df = pairs(spark, rows)
    one = validate(df, ["id"], all_rules()).rows.collect()
    two = validate(df.repartition(partitions), ["id"], all_rules()).rows.collect()
    assert sorted(one) == sorted(two)
