import random
import re

import numpy as np
import pytest

from helpers import ROWS, awkward
from paralane.llm.jaccard import Bands, jaccard_groups, routes
from paralane.llm.signature_tree import SignatureTree


def brute_set(text, words):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not parts:
        return frozenset()
    return frozenset(" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1)))


def brute_labels(sets, linked):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and linked(sets[i], sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


def linked_by(n, d):
    return lambda a, b: d * len(a & b) >= n * len(a | b)


def near_texts(count, seed):
    rng = random.Random(seed)
    out = []
    while len(out) < count:
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 2, 5, 9, 12, 20, 40, 90, 250]))]
        for _ in range(rng.randrange(1, 8)):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = [f"n{rng.randrange(10)}"]
            out.append(" ".join(words))
            base = words if rng.random() < 0.5 else base  # chains as well as stars
    return out


def wanted(rows, words, n, d):
    sets = [brute_set(text, words) for _, text in rows]
    labels = brute_labels(sets, linked_by(n, d))
    least = {}
    for (i, _), label in zip(rows, labels):
        least[label] = i if least.get(label) is None else least[label] if i is None else min(least[label], i)
    return sorted(((i, len(s), least[label] if s else i) for (i, _), s, label in zip(rows, sets, labels)), key=str)


@pytest.mark.parametrize("share,words,tree_sets", [((90, 100), 3, 4096), ((90, 100), 3, 3), ((80, 100), 5, 64)])
def test_against_brute_force(spark, share, words, tree_sets):
    rows = list(ROWS) + [(100 + i, text) for i, text in enumerate(near_texts(150, 5))]
    found = jaccard_groups(awkward(spark, rows), words=words, share=share, tree_sets=tree_sets)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == wanted(rows, words, *share)


def test_no_rows_and_only_empty_texts(spark):
    assert jaccard_groups(awkward(spark, [])).collect() == []
    rows = [(1, None), (2, ""), (2, " "), (None, "\t")]
    assert sorted(map(tuple, jaccard_groups(awkward(spark, rows)).collect()), key=str) == sorted(((i, 0, i) for i, _ in rows), key=str)


def test_linked_sets_have_an_equal_part():
    rng = np.random.default_rng(3)
    for above, below in ((90, 100), (80, 100), (1, 2)):
        bands = Bands((above, below))
        for size in [*range(1, 60), 400, 3000]:
            tokens = np.unique(rng.integers(-(2**63), 2**63 - 1, size=size))
            other = np.concatenate((tokens, rng.integers(-(2**63), 2**63 - 1, size=size)))
            # as different as linked sets can be: some tokens dropped, others added
            for dropped in range(0, size, max(1, size // 9)):
                most = (below * (size - dropped) - above * size) // above  # union = size + added
                if most < 0:
                    break
                near = np.unique(np.concatenate((tokens[dropped:], other[len(tokens) : len(tokens) + most])))
                assert set(routes(tokens, bands).tolist()) & set(routes(near, bands).tolist()), (size, dropped, most)


def test_tree_prunes_and_agrees_with_brute_force():
    texts = near_texts(400, 6)
    rng = random.Random(1)
    names = {}
    sets = list({brute_set(text, 3) for text in texts})
    arrays = [np.unique([names.setdefault(t, rng.getrandbits(64) - 2**63) for t in s]) for s in sets]
    tree = SignatureTree(arrays)
    label = tree.components((90, 100)).tolist()
    brute = brute_labels(sets, linked_by(90, 100))
    assert len({*zip(label, brute)}) == len(set(label)) == len(set(brute))
    assert tree.compared < len(sets) * len(sets) / 20
    sides = np.arange(len(sets)) % 2
    across = SignatureTree(arrays).components((90, 100), side=sides).tolist()
    only = brute_labels([(s, side) for s, side in zip(sets, sides)], lambda a, b: a[1] != b[1] and linked_by(90, 100)(a[0], b[0]))
    assert len({*zip(across, only)}) == len(set(across)) == len(set(only))
