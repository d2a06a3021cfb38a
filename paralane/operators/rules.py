"""Quality rules for translation pairs, and the report of what they reject.

A rule is a name and a Column that is true for rows to keep. All rules of a chain become
one CASE expression, so a table is scanned once however many rules there are, and a row
is charged to the first rule that it fails.
"""

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from paralane.functions import text as X
from paralane.operators.fingerprint import row_hash
from paralane.registry import DEVANAGARI

SRC_WORDS, TGT_WORDS = "__src_words", "__tgt_words"
REASON = "reject_reason"

# The report's column for each rule.
REPORT_COLUMNS = {
    "min_length": "rejected_too_short",
    "max_length": "rejected_too_long",
    "length_ratio": "rejected_bad_ratio",
    "not_identical": "rejected_identical",
    "not_empty_or_numeric": "rejected_empty_numeric",
    "devanagari_ascii_ratio": "rejected_ascii_script",
}


class Rule(NamedTuple):
    """``keep`` is a Column, or makes one of the Column that is true for rows not yet rejected."""

    name: str
    keep: Column | Callable[[Column], Column]


def min_length(limit: int = 3) -> Rule:
    return Rule("min_length", (F.col(SRC_WORDS) >= limit) & (F.col(TGT_WORDS) >= limit))


def max_length(limit: int = 200) -> Rule:
    return Rule("max_length", (F.col(SRC_WORDS) <= limit) & (F.col(TGT_WORDS) <= limit))


def length_ratio(limit: float = 3.5) -> Rule:
    longer = F.greatest(SRC_WORDS, TGT_WORDS)
    shorter = F.greatest(F.least(SRC_WORDS, TGT_WORDS), F.lit(1))
    return Rule("length_ratio", longer / shorter <= limit)


def not_identical() -> Rule:
    both = [X.strip(X.text_or_empty(side)) for side in ("src", "tgt")]
    return Rule("not_identical", both[0] != both[1])


def not_empty_or_numeric() -> Rule:
    both = [X.has_content(X.text_or_empty(side)) for side in ("src", "tgt")]
    return Rule("not_empty_or_numeric", both[0] & both[1])


def devanagari_ascii_ratio(limit: float = 0.20, languages: Sequence[str] = DEVANAGARI) -> Rule:
    share = X.ascii_share(X.text_or_empty("tgt"))
    return Rule("devanagari_ascii_ratio", ~X.in_script("tgt_lang", languages) | (share <= limit))


def vector_rule(name: str, function: Callable[[pd.DataFrame], pd.Series], columns: Sequence[str]) -> Rule:
    """A rule from a Python function of a batch: its columns in, a boolean for each row out.

    Only rows that passed all rules before it are sent to it; a batch without any is not.
    """

    @F.pandas_udf("boolean")
    def passes(alive: pd.Series, rows: pd.DataFrame) -> pd.Series:
        out = pd.Series(True, index=rows.index)
        if alive.any():
            out[alive] = function(rows[alive]).astype(bool)
        return out

    def keep(alive: Column) -> Column:
        return passes(alive, F.struct(*[F.when(alive, F.col(c)).alias(c) for c in columns]))

    return Rule(name, keep)


def python_rule(name: str, predicate: Callable[[Mapping], bool], columns: Sequence[str]) -> Rule:
    """A ``vector_rule`` from a predicate on one row, for what cannot be said of a whole batch."""

    def each(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([bool(predicate(row)) for row in rows.to_dict("records")], index=rows.index, dtype="bool")

    return vector_rule(name, each, columns)


def build_rules(
    min_word_len: int = 3,
    max_word_len: int = 200,
    max_length_ratio: float = 3.5,
    reject_identical_pairs: bool = True,
    reject_empty_or_numeric: bool = True,
    max_ascii_ratio_devanagari: float | None = None,
    devanagari: Sequence[str] = DEVANAGARI,
    extra: Iterable[Rule] = (),
) -> list[Rule]:
    """The chain of rules in their fixed order, followed by the user's own."""
    rules = [min_length(min_word_len), max_length(max_word_len), length_ratio(max_length_ratio)]
    if reject_identical_pairs:
        rules.append(not_identical())
    if reject_empty_or_numeric:
        rules.append(not_empty_or_numeric())
    if max_ascii_ratio_devanagari is not None:
        rules.append(devanagari_ascii_ratio(max_ascii_ratio_devanagari, devanagari))
    return with_unique_names(rules + [Rule(*rule) for rule in extra])


def with_unique_names(rules: Sequence[Rule]) -> list[Rule]:
    """The rules, if no two have a name in common: counts per rule would be mixed up."""
    names = [rule.name for rule in rules]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"several rules are named {', '.join(twice)}")
    return list(rules)


def with_word_counts(df: DataFrame) -> DataFrame:
    """Add the word counts of both sides.

    They come out of a generator of one row, not a projection: a filter on the reason would
    be pushed through a projection and split the text again for each rule that counts words.
    """
    counts = F.struct(
        X.word_count(X.text_or_empty("src")).alias(SRC_WORDS),
        X.word_count(X.text_or_empty("tgt")).alias(TGT_WORDS),
    )
    return df.select("*", F.inline(F.array(counts)))


def tag_rejections(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reason``: the first rule a row fails, or null for a row to keep.

    Column rules that follow each other are one CASE. A Python rule sees only what they leave.
    """
    tagged, reason, columns = with_word_counts(df), F.lit(None).cast("string"), []
    for rule in with_unique_names(rules):
        if not callable(rule.keep) or isinstance(rule.keep, Column):
            columns.append(rule)
            continue
        tagged = tagged.withColumn(REASON, F.coalesce(reason, _first_failure(columns)))
        reason, columns = F.col(REASON), []
        failed = ~F.coalesce(rule.keep(reason.isNull()), F.lit(False))
        tagged = tagged.withColumn(REASON, F.coalesce(reason, F.when(failed, F.lit(rule.name))))
    return tagged.withColumn(REASON, F.coalesce(reason, _first_failure(columns))).drop(SRC_WORDS, TGT_WORDS)


def _first_failure(rules: Sequence[Rule]) -> Column:
    reason = F.lit(None).cast("string")
    for rule in reversed(rules):
        reason = F.when(F.coalesce(rule.keep, F.lit(False)), reason).otherwise(F.lit(rule.name))
    return reason


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejection_counts(tagged: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Rows, kept rows and rows charged to each rule, in one aggregate."""
    counts = [F.count_if(F.col(REASON) == rule.name).alias(rule.name) for rule in rules]
    kept_rows = F.count_if(F.col(REASON).isNull()).alias("kept")
    return tagged.groupBy(*by).agg(F.count(F.lit(1)).alias("total_input"), *counts, kept_rows)


def validation_report(
    tagged: DataFrame, rules: Sequence[Rule], deduplicate_on: Sequence[str] = ("src",)
) -> DataFrame:
    """One row: totals, a counter per built-in rule, duplicates, the map of all rules.

    One scan, and one shuffle of the distinct keys of kept rows, each as a hash of 32 bytes.
    Rejected rows have a null key and copies of a key are merged before the shuffle, so neither can
    make a hot task.
    """
    key = F.unhex(row_hash(deduplicate_on))
    names = [rule.name for rule in with_unique_names(rules)]
    counts = tagged.agg(
        F.count(F.lit(1)).alias("total_input"),
        F.count_if(F.col(REASON).isNull()).alias("__survivors"),
        F.count_distinct(F.when(F.col(REASON).isNull(), key)).alias("total_output"),
        *[F.count_if(F.col(REASON) == name).alias(f"__{name}") for name in names],
    )
    built_in = [
        (F.col(f"__{name}") if name in names else F.lit(0).cast("bigint")).alias(column)
        for name, column in REPORT_COLUMNS.items()
    ]
    entries = [item for name in names for item in (F.lit(name), F.col(f"__{name}"))]
    retention = 100 * F.col("total_output") / F.greatest("total_input", F.lit(1))
    return counts.select(
        "total_input",
        "total_output",
        *built_in,
        (F.col("__survivors") - F.col("total_output")).alias("duplicates_removed"),
        F.create_map(*entries).alias("per_rule_rejections"),
        F.round(retention, 1).alias("retention_percent"),
    )
