"""Chains of table transforms; the default chain normalizes both texts."""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from paralane.functions.unicode import normalize_text

Transform = Callable[[DataFrame], DataFrame]


def normalize_pairs(form: str = "NFC", columns: Sequence[str] = ("src", "tgt")) -> Transform:
    return lambda df: df.withColumns({name: normalize_text(name, form) for name in columns})


def build_transforms(normalization: str = "NFC", extra: Sequence[Transform] = ()) -> list[Transform]:
    return [normalize_pairs(normalization), *extra]


def apply_transforms(df: DataFrame, transforms: Sequence[Transform] | None = None) -> DataFrame:
    chain = build_transforms() if transforms is None else transforms
    return reduce(DataFrame.transform, chain, df)
