import hashlib
import random
import re

import numpy as np
import pytest

from helpers import ROWS, awkward
from paralane.llm import substring
from paralane.llm.fm_index import FMIndex, WaveletMatrix
from paralane.llm.substring import Runs, first_ids, substring_dedup, substring_digests


def brute(rows, window=13):
    split = [re.findall("[^\x20\x09-\x0d]+", text or "") for _, text in rows]
    rank = [2**63 if i is None else i for i, _ in rows]
    first = {}
    for r, words in zip(rank, split):
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            first[key] = min(first.get(key, r), r)
    out = []
    for (i, _), r, words in zip(rows, rank, split):
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < r:
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed, n=60, words=30):
    random.seed(seed)
    shared = [" ".join(random.choice("abcdefgh") for _ in range(random.randint(5, 60))) for _ in range(12)]
    for i in range(n):
        parts = [random.choice(shared) if random.random() < 0.5 else " ".join(f"u{random.randrange(10**6)}" for _ in range(random.randint(0, words))) for _ in range(5)]
        yield random.randrange(10**6), random.choice([" ", "\n", "\t "]).join(parts)


def run(spark, rows, window=13, **options):
    return sorted(map(tuple, substring_digests(awkward(spark, rows), window=window, **options).collect()), key=str)


@pytest.mark.parametrize("window", [13, 3])
def test_shared_passages(spark, window):
    rows = list(passages(window))
    assert run(spark, rows, window) == brute(rows, window)


def test_awkward_rows(spark):
    rows = [*ROWS, (20, "a " * 500), (21, "a " * 300 + "b"), (19, "b " + "a " * 20), (None, "a " * 15)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("hot_blocks", [1, 3])
def test_hot_anchors_and_small_indexes(spark, hot_blocks):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [*passages(7), *((10**7 + i, f"before{i} {passage} after{i} " + "a " * (i % 20)) for i in range(60)), (None, passage)]
    assert run(spark, rows, hot_blocks=hot_blocks, index_words=100) == brute(rows)


def test_rows_of_one_id_are_dealt_to_several_blocks(spark):
    rows = [(None if i % 3 else 7, text) for i, (_, text) in enumerate(passages(8))] + list(passages(9, 20))
    blocks = substring._dealt(awkward(spark, rows), "doc_id", "text")[0].groupBy("doc_id").agg({"__block": "collect_set"}).collect()
    found = {r[0]: len(r[1]) for r in blocks}
    assert found[None] > 3 and found[7] > 3
    assert run(spark, rows) == brute(rows)


def test_anchors_are_hot_by_their_share_of_blocks(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(substring, "_hot_from", lambda blocks, of=substring._hot_from: asked.append((blocks, of(blocks))) or of(blocks))
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"before{i} {passage} after{i}") for i in range(200)]
    assert run(spark, rows) == brute(rows)
    [(blocks, hot)] = asked
    held = {r[0] for r in substring._dealt(awkward(spark, rows), "doc_id", "text")[0].select("__block").distinct().collect()}
    assert 2 <= hot <= len(held) == blocks
    assert [substring._hot_from(n) for n in (1, 10, 100, 4000)] == [2, 9, 90, 3600]


def test_first_ids():
    rows = list(passages(5, 40))
    split = [text.split() for _, text in rows if len(text.split()) >= 13]
    low = [i for i, text in rows if len(text.split()) >= 13]
    firsts = first_ids([[w.encode() for w in words] for words in split], low, 13)
    best = {}
    for words, i in zip(split, low):
        for k in range(len(words) - 12):
            key = tuple(words[k : k + 13])
            best[key] = min(best.get(key, i), i)
    for words, found in zip(split, firsts):
        assert found.tolist() == [best[tuple(words[k : k + 13])] for k in range(len(words) - 12)]


def test_runs_hold_every_window_once():
    texts = [text.encode() for _, text in passages(6, 20)] + [b"", b"a b c", b"x " * 200]
    runs = Runs.of(texts, 13)
    windows = sorted(b + j for b, c in zip(runs.begin.tolist(), runs.count.tolist()) for j in range(c))
    wanted, at = [], 0
    for text in texts:
        n = len(text.split())
        wanted += range(at, at + max(0, n - 12))
        at += n
    assert windows == wanted and max(runs.count) <= substring.RUN_WINDOWS


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 23, 500)
    tree = WaveletMatrix(symbols, 22)
    places, asked = rng.integers(0, 501, 400), rng.integers(0, 23, 400)
    assert tree.rank(asked, places).tolist() == [int((symbols[:p] == s).sum()) for s, p in zip(asked, places)]


def test_backward_search_finds_all_windows():
    rng = np.random.default_rng(4)
    text = rng.integers(1, 4, 300)
    text[::60] = 0
    index = FMIndex(text, 5)
    begins = np.array([i for i in range(296) if 0 not in text[i : i + 5]])
    alive, low, high = index.shared(begins, 5)
    found = {int(begins[a]): sorted(index.order[x:y].tolist()) for a, x, y in zip(alive, low, high)}
    for i in begins.tolist():
        same = [j for j in begins.tolist() if np.array_equal(text[i : i + 5], text[j : j + 5])]
        assert found.get(i, [i]) == same


def test_stage_keeps_columns_and_clean_texts(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"one\ttwo {passage}"), (2, f"{passage}  tail  of it"), (3, "clean\n text"), (4, passage)]
    docs = awkward(spark, rows).selectExpr("*", "99L as n_chars")
    done = substring_dedup(docs, length_column="n_chars")
    assert done.columns == docs.columns
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in done.collect()}
    assert found == {1: (rows[0][1], 99), 2: ("tail of it", 10), 3: ("clean\n text", 99), 4: ("", 0)}


def test_no_rows(spark):
    assert run(spark, []) == []
