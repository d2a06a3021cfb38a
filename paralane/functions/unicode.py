"""Unicode normalization. Spark has no built-in for it, so this is the one Arrow function."""

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F

from paralane.functions.text import collapse_spaces, drop_zero_width, text_or_empty

# The characters below which a form changes nothing: U+0300 for NFC, ASCII for the others.
_TOUCHED = {
    "NFC": r"[^\x{0000}-\x{02ff}]",
    "NFD": r"[^\x{0000}-\x{007f}]",
    "NFKC": r"[^\x{0000}-\x{007f}]",
    "NFKD": r"[^\x{0000}-\x{007f}]",
}


def _normalizer(form: str):
    @F.pandas_udf("string")
    def normalized(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda text: text
            if text is None or unicodedata.is_normalized(form, text)
            else unicodedata.normalize(form, text)
        )

    return normalized


def unicode_form(value: Column | str, form: str = "NFC") -> Column:
    """The text in a Unicode normal form.

    Only texts with a character that the form could touch are sent to Python; for the
    others a null goes over, which costs nothing to transfer.
    """
    if form not in _TOUCHED:
        raise ValueError(f"unknown Unicode form {form!r}; use one of {sorted(_TOUCHED)}")
    text = F.col(value) if isinstance(value, str) else value
    touched = F.when(F.rlike(text, F.lit(_TOUCHED[form])), text)
    return F.coalesce(_normalizer(form)(touched), text)


def normalize_text(value: Column | str, form: str = "NFC") -> Column:
    """Normal form, no zero-width characters, single spaces, stripped; null becomes empty."""
    return collapse_spaces(drop_zero_width(unicode_form(text_or_empty(value), form)))
