import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from paralane.llm.bloom import Bloom
from paralane.llm.divergence import audit_sources, hashes_of, kept_terms, shares, term_blocks

COLUMNS = "doc_id long, text string, lang string, source string, place string, rank int, n long, terms string"


def brute(rows, least, most):
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) for text, _, _ in rows]
    langs = [lang or "" for _, lang, _ in rows]
    sources = [source or "" for _, _, source in rows]
    docs, counts, whole = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for own, lang, source in zip(words, langs, sources):
        docs[lang].update(set(own))
        counts[lang, source].update(own)
        whole[lang].update(own)
    out = []
    for lang, source in counts:
        kept = [term for term, n in docs[lang].items() if n >= least]

        def share(counted):
            total = sum(counted[term] for term in kept)
            return {term: 1 + 10**9 * (counted[term] + 2) // (total + 2 * len(kept)) for term in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = share(counts[lang, source]), share(whole[lang])
        pairs = [(other, sum(gap(p[t], o[t]) for t in kept)) for one, other in counts if one == lang and other != source for o in [share(counts[lang, other])]]
        terms = [(t, gap(p[t], q[t])) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, rank + 1) for rank, (item, value) in enumerate(ranked) if part == "pair" or rank < most]
    return sorted(out)


ROWS = [
    ("Alpha beta alpha émile zoë", "en", "a"), ("alpha beta gamma", "en", "a"), ("ALPHA-beta_x 12 gamma", "en", "b"), ("alphabet beta x", "en", None),
    ("", "en", "c"), (None, "en", "d"), ("alpha beta", None, "a"), ("alpha beta", None, "a"), ("alpha", None, None), ("x" * 70 + " y", "fr", "a"),
    ("x" * 70, "fr", "b"), ("only once here", "de", "a"), ("other words", "de", "b"), ("漢字 漢字 漢", "zh", "a"), ("漢字 漢字漢", "zh", "b"),
]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, *row, "p", 1, 2, "t") for i, row in enumerate(ROWS)], COLUMNS)
    for least, most, block_bytes in ((2, 10, 1), (1, 2, 1 << 20), (3, 10, 200)):
        found = audit_sources(df, least=least, most=most, block_bytes=block_bytes)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, found.collect())) == brute(ROWS, least, most)


def test_many_sources_and_no_rows(spark):
    rows = [(f"w{i % 7} " * (1 + i % 3) + f"u{i % 5}x", "en", f"s{i % 90:02d}") for i in range(400)]
    rows += [(" ".join(chr(97 + i % 26) + chr(97 + j) for j in range(26)), "en", f"s{i % 90:02d}") for i in range(30)]
    df = spark.createDataFrame([(i, *row, "p", 1, 2, "t") for i, row in enumerate(rows)], COLUMNS)
    assert sorted(map(tuple, audit_sources(df).collect())) == brute(rows, 10, 10)
    assert audit_sources(df.limit(0)).collect() == []


def test_prefixes_are_refined_and_rare_ones_discarded(spark):
    rows = [("shared" + "x" * (i % 2), "en", "a") for i in range(40)] + [(f"junk{i:04d}word", "en", "a") for i in range(9)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    kept = kept_terms(term_blocks(df), least=10)
    assert sorted(map(tuple, kept.collect())) == [("en", bytearray(b"shared"), 20), ("en", bytearray(b"sharedx"), 20)]


def test_bloom_and_shares(spark):
    rows = [("en", f"t{i}".encode()) for i in range(500)]
    df = spark.createDataFrame(rows, "lang string, term binary").select(F.xxhash64("lang", "term").alias("hash"))
    bloom = Bloom.of(df, 500)
    assert bloom.holds(hashes_of("en", [t for _, t in rows])).all()
    assert bloom.holds(hashes_of("de", [f"o{i}".encode() for i in range(5000)])).mean() < 0.05
    assert hashes_of("en", [b"x"])[0] == xxhash.xxh64_intdigest(b"x", xxhash.xxh64_intdigest(b"en", 42))
    import numpy as np

    n, over = np.array([0, 5, 9 * 10**14]), np.array([3, 11, 9 * 10**14 + 2])
    assert shares(n, over).tolist() == [1 + 10**9 * (int(a) + 2) // int(b) for a, b in zip(n, over)]
