import random
import zlib
from collections import Counter, defaultdict

from helpers import ROWS, awkward
from paralane.llm.sharding import cut, plan, shard_by_bytes, smallest_capacity


def brute_capacity(sizes, shards):
    capacity = max(sizes, default=0)
    while True:
        used, room = 1, capacity
        for size in sizes:
            if size > room:
                used, room = used + 1, capacity
            room -= size
        if used <= shards:
            return capacity
        capacity += 1


def test_smallest_capacity_and_cut():
    random.seed(3)
    for _ in range(300):
        sizes = [random.randint(0, 9) for _ in range(random.randint(1, 30))]
        shards = random.randint(1, 8)
        capacity = smallest_capacity(sizes, shards)
        assert capacity == brute_capacity(sizes, shards)
        cuts = [0, *cut(sizes, shards), len(sizes)]
        assert len(cuts) == shards + 1 and cuts == sorted(cuts)
        assert max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])) <= capacity


def test_large_groups_go_alone():
    alone, starts = plan({0: 5, 1: 100, 2: 5, 3: 5, 4: 60, 5: 5}, 4)
    assert alone == {1: 0, 4: 1}
    assert starts == [3]
    assert plan({}, 3) == ({}, [1, 1])


def test_shards_of_awkward_rows(spark):
    rows = shard_by_bytes(awkward(spark, ROWS), shards=5).collect()
    text = defaultdict(list)
    for i, t in ROWS:
        text[i].append(t or "")
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in ROWS)
    found = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    assert found == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ROWS)
    slots, shards_of = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        shards_of[r["size"], r["text_crc32"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 5
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards_of.values())


def test_shards_are_nearly_equal_with_a_hot_text(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('text ', id)) as text")
    sums = Counter()
    for r in shard_by_bytes(docs, shards=8).collect():
        sums[r["shard"]] += r["size"]
    hot = max(sums.values())
    rest = sorted(sums.values())[:-1]
    assert hot == 2000 * 19 and len(sums) == 8
    assert rest[-1] - rest[0] <= 0.05 * rest[-1]


def test_no_rows(spark):
    empty = shard_by_bytes(awkward(spark, []))
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "size"]
