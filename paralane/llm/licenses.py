"""License scans: a positional index of the rarest licence words, in DataFrame functions alone."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """A licence's wording. ``key`` must stand word for word; ``least`` is the share of words, at
    their places in the template, from which on the rest counts as found (0 if the key is enough)."""

    label: str
    text: str
    key: str
    least: float = 0.8

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


#: Phrases that stand for a licence wherever their words follow each other (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Openings of public licence texts, and short notices whose key phrase is enough (fixed values).
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "licensed under the apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "distribute this software for any purpose"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    Template("mit", "the mit license", "mit license", 0.0),
    Template("apache-2", "the apache license 2 0", "apache license 2", 0.0),
    Template("bsd", "under the bsd license", "the bsd license", 0.0),
    Template("bsd", "the 3 clause bsd license", "clause bsd license", 0.0),
    Template("bsd", "the bsd 3 clause license", "bsd 3 clause", 0.0),
    Template("bsd", "the bsd 2 clause license", "bsd 2 clause", 0.0),
    Template("gpl", "licensed under the gnu general public license version", "gnu general public license", 0.0),
    Template("gpl", "under the gnu gpl version", "the gnu gpl", 0.0),
    Template("gpl", "licensed under the gpl version", "under the gpl", 0.0),
    Template("isc", "under the isc license", "the isc license", 0.0),
    Template("mpl-2", "the mozilla public license version 2 0", "mozilla public license version 2", 0.0),
    Template("mpl-2", "the mozilla public license v 2 0", "mozilla public license v 2", 0.0),
    Template("mpl-2", "the mozilla public license 2 0", "mozilla public license 2", 0.0),
    Template("cc-by-nc", "under the creative commons attribution noncommercial license", "creative commons attribution noncommercial", 0.0),
)

#: Words that deny a licence which is named shortly after them (fixed values).
DENIALS = ("not", "never", "neither", "nor", "isn", "aren", "cannot", "without")
#: How many words before a key phrase are read for a denial.
DENIAL_REACH = 4
#: By how many of its words, those with the highest IDF, a wording is looked up.
ANCHORS = 3

#: What separates words: all of ASCII but letters and digits (fixed value).
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null as empty.

    Only two other characters have an ASCII letter in their lower case; they are taken for others first.
    """
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("İ"), F.lit("ı")), F.lit("K"), F.lit("ĸ"))
    return F.filter(F.split(F.lower(plain), _GAPS), lambda word: word != "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rarest(docs: DataFrame, text_column: str, vocabulary: Sequence[str]) -> dict[str, int]:
    """In how many documents each word of a (short) vocabulary occurs."""
    present = F.explode(F.array_intersect(words_of(F.col(text_column)), F.lit(list(vocabulary))))
    counts = docs.select(present.alias("word")).groupBy("word").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in counts}


def _anchors(words: Sequence[str], frequency: dict[str, int], most: int = ANCHORS) -> list[tuple[str, int]]:
    """The words of a phrase with the highest IDF, that is in the fewest documents, and their first places.

    A phrase stands nowhere if no document has one of them.
    """
    rarest_first = sorted(set(words), key=lambda word: (frequency[word], word))
    return [(word, list(words).index(word)) for word in rarest_first[:most]]


def _starts(hits: Column, anchors: Sequence[tuple[str, int]]) -> Column:
    """Where a phrase would begin: the places on which the postings of its words agree, taken relative to
    the word's place in the phrase. Rarer words come first, so what is intersected is short."""
    found = None
    for word, place in anchors:
        own = F.transform(F.filter(hits, lambda hit: hit["word"] == word), lambda hit: hit["at"] - F.lit(place))
        found = own if found is None else F.array_intersect(found, own)
    return found


def _denied(words: Column, key: Column, reach: int = DENIAL_REACH) -> Column:
    """Whether one of the ``reach`` words before a key phrase denies it."""
    begin = F.greatest(key - reach, F.lit(0))
    return F.arrays_overlap(F.slice(words, begin + 1, key - begin), F.lit(list(DENIALS)))


def _share(words: Column, start: Column, template: Sequence[str]) -> Column:
    """The share of a template's words that stand at their places after ``start``."""
    same = F.filter(
        F.transform(F.lit(list(template)), lambda word, i: F.get(words, start + i).eqNullSafe(word)), lambda x: x
    )
    return F.size(same) / F.lit(float(len(template)))


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: dict[str, str] | None = None,
    templates: Sequence[Template] = TEMPLATES,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document.

    A first scan counts in how many documents each licence word occurs. In a second one, every text's
    postings of the words with the highest IDF are looked up: ``ANCHORS`` words of each phrase and of each
    template's mandatory key phrase. Their positions relative to the wording are intersected, which gives
    the places where it would begin, and there all its words are verified. A wording that stands whole has
    all its words at one start, so no place is lost. Then the share of the template's words at their places
    around its key phrase is tested. A template whose key phrase is denied up to ``DENIAL_REACH`` words
    before it ("this is not under the gpl") gives no label at that place; phrases count wherever they
    stand. Nothing is shuffled but the counts.

    n_base counts the places of all phrases; first_word and last_word are the smallest and largest word
    (from 0) at which one begins, null if there is none. base_labels has the phrases' labels, labels also
    those of templates: distinct, sorted, joined by commas, empty if there are none. score is 1 for a
    phrase, else the largest share of a template that was found, else 0. Null texts count as empty; texts
    are scanned whole, and repeated rows give repeated results. Other columns are not read.
    """
    phrases = PHRASES if phrases is None else phrases
    wordings = [phrase.split() for phrase in phrases] + [t.key.split() for t in templates]
    vocabulary = sorted({word for words in wordings for word in words})
    frequency = rarest(docs, text_column, vocabulary)
    by_phrase = [(label, phrase.split(), _anchors(phrase.split(), frequency)) for phrase, label in phrases.items()]
    by_template = [(t, _anchors(t.key.split(), frequency)) for t in templates]
    looked_up = sorted({word for *_, anchors in (*by_phrase, *by_template) for word, _ in anchors})

    def places(words: Column, hits: Column, wording: list[str], anchors: list[tuple[str, int]]) -> Column:
        whole = F.lit(wording)
        return F.filter(
            _starts(hits, anchors),
            lambda start: (start >= 0) & (F.slice(words, F.greatest(start, F.lit(0)) + 1, len(wording)) == whole),
        )

    def share(words: Column, hits: Column, template: Template, anchors: list[tuple[str, int]]) -> Column:
        verified = F.filter(places(words, hits, template.key.split(), anchors), lambda key: ~_denied(words, key))
        shares = F.transform(verified, lambda key: _share(words, key - template.key_at, template.words))
        return F.coalesce(F.array_max(F.filter(shares, lambda x: x >= template.least)), F.lit(0.0))

    def scanned(words: Column) -> Column:
        hits = F.filter(
            F.transform(words, lambda word, i: F.struct(word.alias("word"), i.alias("at"))),
            lambda hit: hit["word"].isin(looked_up),
        )
        return _let(hits, lambda found: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.array(*(places(words, found, wording, anchors) for _, wording, anchors in by_phrase)).alias("places"),
            F.array(*(share(words, found, t, anchors) for t, anchors in by_template)).cast("array<double>").alias("shares"),
        ))

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    found = rows.select("doc_id", _let(words_of(F.col("text")), scanned).alias("found"))
    starts = F.flatten("found.places")
    base = F.array_compact(F.array(*(
        F.when(F.size(F.get("found.places", F.lit(i))) > 0, F.lit(label)) for i, (label, _, _) in enumerate(by_phrase)
    )))
    more = F.array_compact(F.array(*(
        F.when(F.get("found.shares", F.lit(i)) > 0, F.lit(t.label)) for i, (t, _) in enumerate(by_template)
    )))
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(base))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(base, more)))).alias("labels"),
        F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("found.shares"), F.lit(0.0))).alias("score"),
    )
