"""Every stage of the pipeline against brute force, on given and awkward rows with hostile column names."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from helpers import ROWS
from paralane.llm.quality import fit_quality, statistics_of
from paralane.session import materialize
from test_exact import expected
from test_packing import PATH
from test_simhash import brute_components, brute_print
from test_substring import brute

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
#: Names that operators use themselves.
HOSTILE = [
    "__block", "__kept", "__n_removed", "__n_words", "__score", "__sha256", "__hash", "__points", "__spilled",
    "__text_hash", "__label", "__row", "c0", "kept", "score", "fingerprint", "component_id", "root", "length",
]
PASSAGE = " ".join(f"passage{i}" for i in range(70))
BASE = [f"near{i}" for i in range(500)]
EXTRA = [
    (2001, f"begin {PASSAGE} end"), (2002, f"other {PASSAGE}"), (2003, PASSAGE), (2004, None), (None, f"x {PASSAGE} y"),
    (2010, " ".join(BASE)), (2011, " ".join([*BASE[:250], "changed", *BASE[251:]])), (2012, " ".join(BASE) + " \n"),
    (2013, "Only Case"), (2014, "only case"), (2015, "short"),
]


def with_hostile(docs):
    """Each extra column holds the row's number, so that a test sees values that moved."""
    docs = materialize(docs.withColumn("tag", F.monotonically_increasing_id()))
    return docs.select("*", *[F.concat(F.lit(name), F.col("tag")).alias(name) for name in HOSTILE])


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = spark.createDataFrame(ROWS + EXTRA, "doc_id long, text string")
    more = rows.withColumn("n_chars", F.char_length("text"))
    return materialize(with_hostile(given.unionByName(more.select(
        *[F.col(f.name).cast(f.dataType) if f.name in more.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in given.schema]
    ))))


def applied(spark, docs, name):
    """Input and output rows of a stage; columns stay, and each row's extra columns are its own."""
    done = materialize(STAGES[name](spark, docs, FOLDER))
    assert done.columns == docs.columns
    before, after = docs.collect(), done.collect()
    by_tag = {r["tag"]: r for r in before}
    assert len({r["tag"] for r in after}) == len(after)
    changing = {"text", "n_chars"} if name == "substring dedup" else set()
    for r in after:
        assert all(r[c] == by_tag[r["tag"]][c] for c in docs.columns if c not in changing)
    return before, after, done


def test_quality(spark, docs):
    before, after, _ = applied(spark, docs, "quality classifier")
    model = fit_quality(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = model.score(statistics_of(pd.Series([r["text"] for r in before])))
    assert {r["tag"] for r in after} == {r["tag"] for r, s in zip(before, scores) if s >= 0.3}
    assert 0 < len(after) < len(before)


def test_the_stages_after_it(spark, docs):
    before, after, docs = applied(spark, docs, "exact dedup")
    groups = expected([(r["doc_id"], r["text"]) for r in before])
    plain = {re.sub("[\x20\x09-\x0d]", "", r["text"] or ""): r["doc_id"] for r in after}
    assert plain == {text: keep for text, (keep, _) in groups.items()} and len(after) == len(groups) < len(before)

    before, after, docs = applied(spark, docs, "SimHash near-dedup")
    prints = {r["tag"]: brute_print(r["text"]) for r in before}
    roots = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    members, stay = defaultdict(list), defaultdict(list)
    for rows, found in ((before, members), (after, stay)):
        for r in rows:
            found[roots[prints[r["tag"]]]].append((r["doc_id"] is None, r["doc_id"] or 0))
    assert {root: [min(ids)] for root, ids in members.items()} == stay and len(after) < len(before)

    before, after, docs = applied(spark, docs, "substring dedup")
    wanted = brute([(r["doc_id"], r["text"]) for r in before])
    split = {r["tag"]: re.findall("[^\x20\x09-\x0d]+", r["text"] or "") for r in before}
    given = {r["tag"]: r["text"] for r in before}
    found = []
    for r in after:
        kept = re.findall("[^\x20\x09-\x0d]+", r["text"] or "")
        removed = len(split[r["tag"]]) - len(kept)
        found.append((r["doc_id"], len(split[r["tag"]]), removed, hashlib.sha256(" ".join(kept).encode()).hexdigest()))
        assert r["text"] == (" ".join(kept) if removed else given[r["tag"]])
        assert not removed or r["n_chars"] == len(r["text"])
    assert sorted(found, key=str) == wanted and any(n for _, _, n, _ in wanted)

    library, pieces = Tokenizer.from_file(PATH), Counter()
    for r in after:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], dtype="<u4")
            pieces[r["doc_id"], k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    packed = STAGES["best-fit packing"](spark, docs, FOLDER).collect()
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in packed) == pieces
    sequences = defaultdict(list)
    for p in packed:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_empty_table(spark, docs):
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, empty, FOLDER)
        assert done.count() == 0, name
