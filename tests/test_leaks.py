import random

import pytest

from paralane.operators.leaks import BITMAP_BITS, key_filter, leak_report, leaked_rows, possible_leaks, without_leaks
from paralane.session import materialize

SCHEMA = "id long, src string, tgt string, split string"


def tables(spark, seed=0):
    """Keys of which many repeat, some are null or empty, and some differ only in where they are parted."""
    rng = random.Random(seed)
    words = [None, "", "a", "ab", "b", "é", " a", *(f"w{i}" for i in range(400))]
    rows = [(i, rng.choice(words), rng.choice(words[:8]), rng.choice(["train", "val"])) for i in range(3000)]
    locked = [(i, rng.choice(words), rng.choice(words[:8]), "test") for i in range(60)]
    return rows, locked, spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(locked, SCHEMA)


@pytest.mark.parametrize("keys", [["src"], ["tgt"], ["src", "tgt"]])
@pytest.mark.parametrize("bits", [1, 16, 4096])
def test_against_brute_force(spark, keys, bits):
    rows, locked, df, test = tables(spark)
    at = [SCHEMA.replace(" long", "").replace(" string", "").split(", ").index(k) for k in keys]
    known = {tuple(r[i] for i in at) for r in locked}
    wanted = sorted(r[0] for r in rows if tuple(r[i] for i in at) in known)
    found = leaked_rows(df, test, keys, bits_per_key=bits)
    assert found.columns == df.columns and sorted(r.id for r in found.collect()) == wanted
    left = without_leaks(df, test, keys, bits_per_key=bits)
    assert left.columns == df.columns
    assert sorted(r.id for r in left.collect()) == sorted({r[0] for r in rows} - set(wanted))


def test_a_full_filter_changes_no_result(spark):
    """One bitmap for a hundred thousand keys lets nearly all rows through."""
    locked = spark.range(100_000).selectExpr("cast(id * 3 as string) as src")
    df = spark.range(3000).selectExpr("id", "cast(id as string) as src")
    filter_, blocks = key_filter(locked, ["src"], max_bytes=1)
    assert blocks == 1 and filter_.count() == 1
    assert possible_leaks(df, locked, ["src"], max_bytes=1).where("__leak").count() > 2900
    assert sorted(r.id for r in leaked_rows(df, locked, ["src"], max_bytes=1).collect()) == list(range(0, 3000, 3))


def test_few_foreign_rows_pass(spark):
    locked = spark.range(20_000).selectExpr("cast(id as string) as src")
    foreign = spark.range(1_000_000, 1_050_000).selectExpr("cast(id as string) as src")
    _, blocks = key_filter(locked, ["src"])
    assert blocks == -(-20_000 * 16 // BITMAP_BITS)
    assert possible_leaks(foreign, locked, ["src"]).where("__leak").count() < 50_000 / 100
    assert leaked_rows(foreign, locked, ["src"]).isEmpty()


@pytest.mark.parametrize("operator", [leaked_rows, without_leaks])
def test_only_hits_are_shuffled(spark, tmp_path, operator):
    """Between the scan of the large table and its exchange stands the filter."""
    _, _, df, test = tables(spark)
    df, test = materialize(df, str(tmp_path / "df")), materialize(test, str(tmp_path / "test"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = operator(df, test)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hits = plan[plan.index("SortMergeJoin"):]
    assert hits.index("Exchange hashpartitioning") < hits.index("BroadcastHashJoin") < hits.index("FileScan")
    assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan


def test_empty_tables(spark):
    _, _, df, test = tables(spark)
    assert leaked_rows(df, test.limit(0)).isEmpty() and leaked_rows(df.limit(0), test).isEmpty()
    assert without_leaks(df, test.limit(0)).count() == 3000


def test_report(spark):
    rows, locked, df, test = tables(spark, 5)
    found = {r.split: r for r in leak_report(df, test, {"pairs": ["src", "tgt"], "sources": ["src"]}).collect()}
    pairs, sources = {r[1:3] for r in locked}, {r[1] for r in locked}
    for split in ("train", "val"):
        ours = [r for r in rows if r[3] == split]
        assert found[split].n_rows == len(ours)
        assert found[split].pairs == sum(r[1:3] in pairs for r in ours)
        assert found[split].sources == sum(r[1] in sources for r in ours)
