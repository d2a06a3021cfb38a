"""Text functions as Columns, with the Unicode rules of Python strings."""

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The 29 code points that Python counts as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java character class. The intersection lets the regex engine dismiss
# most non-Latin characters with one range test; it halves the time of a split.
SPACE = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)
# Whatever may be whitespace other than U+0020. Few texts hold any, and the test for it is cheap.
_OTHER_SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680-\u3000]"
# Zero-width characters, marks of direction and the byte-order mark.
ZERO_WIDTH = r"[\u200b-\u200f\ufeff]"
# A character that Python's \w matches and \d does not.
CONTENT = r"[\p{L}\p{Nl}\p{No}_]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_or_empty(value: Column | str) -> Column:
    return F.coalesce(_col(value).cast("string"), F.lit(""))


def strip(value: Column | str) -> Column:
    return F.trim(_col(value), F.lit(WHITESPACE))


def words(value: Column | str) -> Column:
    """The whitespace-separated words, as an array without empty strings."""
    text = _col(value)
    one_kind = F.when(F.rlike(text, F.lit(_OTHER_SPACE)), F.regexp_replace(text, SPACE, " ")).otherwise(text)
    return F.array_remove(F.split(one_kind, " ", -1), "")


def word_count(value: Column | str) -> Column:
    return F.size(words(value))


def collapse_spaces(value: Column | str) -> Column:
    return strip(F.regexp_replace(_col(value), SPACE + "+", " "))


def drop_zero_width(value: Column | str) -> Column:
    return F.regexp_replace(_col(value), ZERO_WIDTH, "")


def has_content(value: Column | str) -> Column:
    """True if there is a letter, a number other than a decimal digit, or ``_``."""
    return F.rlike(_col(value), F.lit(CONTENT))


def ascii_letters(value: Column | str) -> Column:
    return F.length(F.regexp_replace(_col(value), "[^A-Za-z]+", ""))


def length_without_spaces(value: Column | str) -> Column:
    """Code points other than U+0020."""
    return F.length(F.replace(_col(value), F.lit(" "), F.lit("")))


def ascii_share(value: Column | str) -> Column:
    """ASCII letters per non-space character of the stripped text; null if there is none."""
    stripped = strip(value)
    total = length_without_spaces(stripped)
    return F.when(total > 0, ascii_letters(stripped) / total)


def repair_question_mark(value: Column | str) -> Column:
    return F.translate(_col(value), "\u061f", "?")


def sha256_hex(value: Column | str) -> Column:
    return F.sha2(_col(value), 256)


def in_script(code: Column | str, codes) -> Column:
    """True if the language code is one of ``codes``; a missing code is not."""
    return F.coalesce(_col(code).isin(list(codes)), F.lit(False))


def raw_direction(src_lang: Column | str = "src_lang", tgt_lang: Column | str = "tgt_lang") -> Column:
    return F.concat(_col(src_lang), F.lit(" -> "), _col(tgt_lang))


def display_name(code: Column | str, names: Mapping[str, str]) -> Column:
    """The name of a language, or its code if it has none."""
    code = _col(code)
    if not names:
        return code
    entries = [F.lit(item) for pair in names.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), code), code)


def display_direction(
    names: Mapping[str, str],
    src_lang: Column | str = "src_lang",
    tgt_lang: Column | str = "tgt_lang",
) -> Column:
    return F.concat(display_name(src_lang, names), F.lit(" -> "), display_name(tgt_lang, names))


def metric_key(direction: Column | str, metric: str = "") -> Column:
    """``English -> Nepali`` and ``bleu`` give ``English_to_Nepali/bleu``."""
    joined = F.replace(_col(direction), F.lit(" "), F.lit("_"))
    key = F.replace(joined, F.lit("->"), F.lit("to"))
    return F.concat(key, F.lit("/" + metric)) if metric else key


def tagged_input(
    text: Column | str = "src",
    src_lang: Column | str = "src_lang",
    tgt_lang: Column | str = "tgt_lang",
) -> Column:
    """The text with its direction in front, as a translation model reads it."""
    return F.concat_ws(" ", text_or_empty(src_lang), text_or_empty(tgt_lang), text_or_empty(text))
