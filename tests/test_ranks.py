import hashlib
from math import floor

import pytest
from pyspark.sql import functions as F

from paralane.operators.dedup import keep_first
from paralane.operators.ranks import (
    exact_sample, exact_split, global_rank, grouped_split, proportional_split, shuffle_hash, stratified_split,
)


def place(*keys, seed=42):
    parts = [str(seed), *("-" if key is None else f"{len(str(key))}:{key}" for key in keys)]
    return hashlib.sha256("|".join(parts).encode()).hexdigest()


def in_order(keys, seed=42):
    return sorted(keys, key=lambda key: place(key, seed=seed))


def labels(n, train, val):
    a, b = floor(train * n), floor((train + val) * n)
    return ["train"] * a + ["val"] * (b - a) + ["test"] * (n - b)


@pytest.mark.parametrize("n, sizes", [(1, (0, 0, 1)), (10, (9, 0, 1)), (20, (18, 1, 1)), (1000, (900, 50, 50)), (995, (895, 50, 50))])
def test_split_sizes(spark, n, sizes):
    rows = exact_split(spark.range(n), ["id"]).collect()
    found = {row.id: row.split for row in rows}
    assert tuple(list(found.values()).count(s) for s in ("train", "val", "test")) == sizes
    assert found == dict(zip(in_order(range(n)), labels(n, 0.9, 0.05)))


@pytest.mark.parametrize("train, val", [(1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.5, 0.5)])
@pytest.mark.parametrize("digits", [1, 3])
def test_split_at_the_ends(spark, train, val, digits):
    rows = exact_split(spark.range(57), ["id"], train, val, digits=digits).collect()
    assert {row.id: row.split for row in rows} == dict(zip(in_order(range(57)), labels(57, train, val)))


def test_split_of_an_empty_table(spark):
    assert exact_split(spark.range(0), ["id"]).count() == 0


def test_seed_and_partitions(spark):
    one = exact_split(spark.range(500), ["id"], seed=1).collect()
    again = exact_split(spark.range(500).repartition(7), ["id"], seed=1).collect()
    other = exact_split(spark.range(500), ["id"], seed=2).collect()
    assert sorted(one) == sorted(again) != sorted(other)


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_stratified_split(spark, limit):
    """Whether the cuts are broadcast or joined does not matter."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        check_strata(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check_strata(spark):
    # One stratum with most rows, small ones, and one of nulls.
    df = spark.range(1000).withColumn(
        "s", F.when(F.col("id") < 700, "big").when(F.col("id") < 980, F.concat(F.lit("s"), F.col("id") % 40))
    )
    found = {row.id: row.split for row in stratified_split(df, ["id"], ["s"], 0.8, 0.1).collect()}
    assert len(found) == 1000
    members = {}
    for row in df.collect():
        members.setdefault(row.s, []).append(row.id)
    for ids in members.values():
        assert {i: found[i] for i in ids} == dict(zip(in_order(ids), labels(len(ids), 0.8, 0.1)))


@pytest.mark.parametrize("train, val", [(1.0, 0.0), (0.0, 0.0)])
def test_stratified_split_at_the_ends(spark, train, val):
    df = spark.range(20).withColumn("s", F.col("id") % 3)
    found = stratified_split(df, ["id"], ["s"], train, val).select("split").distinct().collect()
    assert [row.split for row in found] == ["train" if train else "test"]


@pytest.mark.parametrize("size", [1, 10, 99, 100, 101])
def test_sample(spark, size):
    rows = exact_sample(spark.range(100), size, ["id"], order_column="place").orderBy("place").collect()
    assert [row.id for row in rows] == in_order(range(100))[:size]


def test_no_sample(spark):
    assert exact_sample(spark.range(9), None, ["id"]).count() == 9
    assert exact_sample(spark.range(9), 0, ["id"], order_column="o").columns == ["id", "o"]


@pytest.mark.parametrize("digits", [1, 4])
def test_rank(spark, digits):
    ranked = global_rank(spark.range(3000).repartition(5), shuffle_hash(["id"]), digits=digits)
    assert [row.id for row in ranked.orderBy("rank").collect()] == in_order(range(3000))
    assert [row["rank"] for row in ranked.orderBy("rank").collect()] == list(range(3000))


def test_several_keys(spark):
    df = spark.range(50).select((F.col("id") % 5).alias("a"), F.col("id").alias("b"))
    rows = exact_sample(df, 7, ["a", "b"]).collect()
    keys = sorted(((i % 5, i) for i in range(50)), key=lambda k: place(*k))[:7]
    assert sorted((r.a, r.b) for r in rows) == sorted(keys)


AWKWARD = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None), ("", "x"), ("x", ""), (None, None), ("-", "x"), ("1:a", "b"), ("a", "1:b")]


def test_keys_that_read_alike_are_told_apart(spark):
    df = spark.createDataFrame(AWKWARD, "a string, b string")
    for size in range(1, 11):
        assert exact_sample(df, size, ["a", "b"]).count() == size
    for rows in (exact_split(df, ["a", "b"], 0.2, 0.3), stratified_split(df, ["a", "b"], [], 0.2, 0.3)):
        sizes = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
        assert sizes == {"train": 2, "val": 3, "test": 5}
    ranked = global_rank(df, shuffle_hash(["a", "b"])).orderBy("rank").collect()
    assert [(r.a, r.b) for r in ranked] == sorted(AWKWARD, key=lambda key: place(*key))


def test_rows_of_equal_keys_cannot_be_parted(spark):
    df = spark.createDataFrame([("k",)] * 4 + [("l",)], "a string")
    with pytest.raises(Exception, match="have the same key"):
        exact_sample(df, 2, ["a"]).collect()
    whole = 4 if place("k") < place("l") else 1
    assert exact_sample(df, whole, ["a"]).count() == whole


def test_splits_do_not_shuffle_the_table(spark):
    df = spark.range(100).withColumn("payload", F.lit("x"))
    plan = exact_split(df, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    main = plan.split("\n")[0] + "\n".join(line for line in plan.split("\n") if "payload" in line)
    assert "Join" not in main and "Window" not in main


def test_keep_first(spark):
    df = spark.createDataFrame(
        [(1, "e", "n"), (2, "n", "e"), (3, "e", "m"), (4, "m", "e"), (5, None, "x"), (6, None, "y")],
        "i int, src string, tgt string",
    )
    assert sorted(r.i for r in keep_first(df, ["src"], ["i"]).collect()) == [1, 2, 4, 5]
    assert sorted(r.i for r in keep_first(df, ["src"], [F.desc("i")]).collect()) == [2, 3, 4, 6]
    assert keep_first(df, ["src", "tgt"], ["i"]).count() == 6
    once = keep_first(df, ["src"], ["i"])
    assert sorted(keep_first(once, ["src"], ["i"]).collect()) == sorted(once.collect())


def test_a_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(10000, numPartitions=4).withColumn("src", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    first = keep_first(df, ["src"], ["id"])
    assert "Partial" in first._jdf.queryExecution().executedPlan().toString()
    assert first.where("src = 'hot'").collect()[0].id == 0
    assert first.count() == 10000 - 3334 + 1


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("train, val", [(0.8, 0.1), (0.9, 0.05), (0.0, 0.0), (1.0, 0.0), (0.0, 1.0)])
def test_grouped_split(spark, digits, train, val):
    """One group with a third of all rows, one of nulls, and small ones."""
    group = [None if i < 7 else "hot" if i < 340 else f"g{i % 150}" for i in range(1000)]
    df = spark.createDataFrame(list(enumerate(group)), "id long, g string")
    found = grouped_split(df, ["g"], train, val, digits=digits)
    assert found.columns == ["id", "g", "split"]
    of_group, sizes = {}, {"train": 0, "val": 0, "test": 0}
    for row in found.collect():
        assert of_group.setdefault(row.g, row.split) == row.split
        sizes[row.split] += 1
    wanted, before = {}, 0
    for g in sorted(set(group), key=lambda g: place(g)):
        wanted[g] = "train" if before < floor(train * 1000) else "val" if before < floor((train + val) * 1000) else "test"
        before += group.count(g)
    assert of_group == wanted
    assert sum(sizes.values()) == 1000


def test_grouped_split_of_few_rows(spark):
    assert grouped_split(spark.range(0), ["id"]).collect() == []
    assert [row.split for row in grouped_split(spark.range(1), ["id"]).collect()] == ["test"]
    one = spark.range(50).withColumn("g", F.lit(1))
    assert {row.split for row in grouped_split(one, ["g"]).collect()} == {"train"}


@pytest.mark.parametrize("train, val", [(0.8, 0.1), (0.9, 0.05), (1.0, 0.0), (0.0, 0.0), (0.5, 0.5)])
def test_proportional_split(spark, train, val):
    """Strata of one to ten rows, a large one and one of nulls."""
    stratum = [None if i < 5 else "big" if i < 300 else f"s{i % 97}" if i < 900 else f"one{i}" for i in range(1000)]
    df = spark.createDataFrame(list(enumerate(stratum)), "id long, s string")
    found = proportional_split(df, ["id"], ["s"], train, val)
    assert found.columns == ["id", "s", "split"]
    rows = found.collect()
    whole = [row.split for row in rows]
    a, b = floor(train * 1000), floor((train + val) * 1000)
    assert [whole.count(name) for name in ("train", "val", "test")] == [a, b - a, 1000 - b]
    for s in set(stratum):
        own = {row.id: row.split for row in rows if row.s == s}
        counts = [list(own.values()).count(name) for name in ("train", "val", "test")]
        assert abs(counts[0] - train * len(own)) < 1 and abs(counts[1] - val * len(own)) < 2
        ordered = [own[i] for i in in_order(own)]
        assert ordered == ["train"] * counts[0] + ["val"] * counts[1] + ["test"] * counts[2]


def test_proportional_split_of_no_rows(spark):
    df = spark.range(0).withColumn("s", F.lit("a"))
    assert proportional_split(df, ["id"], ["s"]).collect() == []
