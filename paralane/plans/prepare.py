"""From a pair table to its cleaned, normalized and split form."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from paralane.operators.dedup import keep_first
from paralane.operators.ranks import exact_split, stratified_split
from paralane.operators.rules import Rule, build_rules, kept, tag_rejections, validation_report
from paralane.operators.transforms import Transform, apply_transforms
from paralane.session import materialize


class Validated(NamedTuple):
    rows: DataFrame
    report: DataFrame


def validate(
    df: DataFrame,
    order_by: Sequence[Column | str],
    rules: Sequence[Rule] | None = None,
    deduplicate_on: str | Sequence[str] = "src",
    once: bool = False,
) -> Validated:
    """Apply the rules, then keep the first row of each key; with the report of both.

    With ``once`` the rules run now, a single time for rows and report.
    """
    rules = build_rules() if rules is None else rules
    on = [deduplicate_on] if isinstance(deduplicate_on, str) else list(deduplicate_on)
    tagged = tag_rejections(df, rules)
    if once:
        tagged = materialize(tagged)
    return Validated(keep_first(kept(tagged), on, order_by), validation_report(tagged, rules, on))


def prepare(
    df: DataFrame,
    keys: Sequence[str],
    rules: Sequence[Rule] | None = None,
    deduplicate_on: str | Sequence[str] = "src",
    transforms: Sequence[Transform] | None = None,
    train: float = 0.90,
    val: float = 0.05,
    seed: int = 42,
    strata: Sequence[str] = (),
    once: bool = True,
) -> Validated:
    """Validate, normalize and split. ``keys`` order the rows and tell them apart.

    The split reads its input three times, and rows and report come of the same rules. With ``once``
    the rows that the rules have been applied to, and then the cleaned ones, are written to the
    shared folder when this is called, so that sources, rules, deduplication and normalization run a
    single time.
    """
    rows, report = validate(df, keys, rules, deduplicate_on, once)
    rows = apply_transforms(rows, transforms)
    if once:
        rows = materialize(rows)
    if strata:
        return Validated(stratified_split(rows, keys, strata, train, val, seed), report)
    return Validated(exact_split(rows, keys, train, val, seed), report)
