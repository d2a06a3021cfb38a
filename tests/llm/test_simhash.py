import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from helpers import ROWS, awkward
from paralane.llm.components import components, forest
from paralane.llm.simhash import BITS, ball_links, bucket_links, near_links, simhash_dedup, simhash_groups


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for run in runs:
        hash_ = xxhash.xxh64_intdigest(run, 42)
        for bit in range(64):
            counts[bit] += hash_ >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(runs))


def brute_components(nodes, linked):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {x: find(x) for x in nodes}


def near_prints(n, seed):
    """Chains and balls of close fingerprints among random ones."""
    random.seed(seed)
    out = set()
    while len(out) < n:
        x = random.getrandbits(64)
        out.add(x)
        for _ in range(random.randint(0, 6)):
            for _ in range(random.randint(1, 5)):
                x ^= 1 << random.randrange(64)
            out.add(x)
    return sorted(out)


def test_fingerprints_and_groups(spark):
    base = [f"word{i}" for i in range(400)]
    rows = list(ROWS)
    random.seed(4)
    for i in range(40):
        words = list(base)
        for _ in range(i % 4):
            words[random.randrange(400)] = "other"
        rows.append((100 + i, " ".join(words)))
    prints = [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    roots = brute_components(distinct, lambda a, b: (a ^ b).bit_count() <= 4)
    least = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        least[roots[p]].append(i)
    wanted = sorted(
        ((i, f"{p:016x}", min((x for x in least[roots[p]] if x is not None), default=None)) for (i, _), p in zip(rows, prints)), key=str
    )
    assert sorted(map(tuple, simhash_groups(awkward(spark, rows)).collect()), key=str) == wanted
    kept = simhash_dedup(awkward(spark, rows))
    assert kept.columns == awkward(spark, []).columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in wanted}
    assert brute_print(None) == 0 and brute_print("A b") == brute_print("a B")


def test_links_join_what_is_near(spark):
    prints = near_prints(400, 8)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    links = near_links(spark.createDataFrame([(x,) for x in signed], "fingerprint long")).collect()
    assert len(links) < 40 * len(prints)
    found = {x: x for x in prints}

    def find(x):
        while found[x] != x:
            x = found[x]
        return x

    for r in links:
        a, b = find(r["a"] % 2**64), find(r["b"] % 2**64)
        assert ((r["a"] ^ r["b"]) % 2**64).bit_count() >= 1
        found[max(a, b)] = min(a, b)
    assert {x: find(x) for x in prints} == roots


def test_a_full_bucket_is_worked_on_in_parts():
    prints = np.array(near_prints(60, 9), dtype=np.uint64)
    whole = set(zip(*(x.tolist() for x in ball_links(prints, 0, 0, 4))))
    label = forest(*map(np.array, zip(*whole)), len(prints))
    parts = [pair for left, right in bucket_links(prints, 0, 0, 4, 9000) for pair in zip(left.tolist(), right.tolist())]
    assert all(int(prints[a] ^ prints[b]).bit_count() <= 4 for a, b in parts)
    assert np.array_equal(forest(*map(np.array, zip(*parts)), len(prints)), label)
    assert BITS == 64


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7), (300, 300)]
    random.seed(1)
    random.shuffle(links)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}, 201: 200, 202: 200}


def test_no_rows(spark):
    assert simhash_groups(awkward(spark, [])).count() == 0
    assert simhash_dedup(awkward(spark, [])).count() == 0


def test_ids_that_repeat_or_are_null_keep_one_row_of_each_group(spark):
    text = " ".join(f"word{i}" for i in range(400))
    near, other = text + " more", "quite another text of some words " * 3
    rows = [(3, text), (5, near), (5, other), (None, near + " x"), (None, other + "y z"), (None, "alone here"), (7, None), (7, "")]
    prints = [brute_print(t) for _, t in rows]
    assert all((prints[0] ^ prints[i]).bit_count() <= 4 for i in (1, 3))
    kept = sorted((r["doc_id"], r["text"]) for r in simhash_dedup(awkward(spark, rows)).collect() if r["doc_id"] is not None)
    assert [i for i, _ in kept] == [3, 5, 7] and kept[1][1] == other
    assert [r["text"] for r in simhash_dedup(awkward(spark, [(None, text), (None, near)])).collect()] in ([text], [near])
    assert [r["text"] for r in simhash_dedup(awkward(spark, [(3, text), (None, near), (None, other)])).collect() if r["doc_id"] is None] == [other]
