import json
import re

import pytest
from pyspark.sql import functions as F

from paralane.operators.rules import build_rules, kept, tag_rejections
from paralane.operators.runs import run_record
from paralane.operators.transforms import apply_transforms, build_transforms
from paralane.plans.evaluate import evaluate, evaluate_and_record
from paralane.plans.prepare import prepare
from paralane.registry import ENGLISH, MAITHILI, NEPALI
from paralane.session import materialize, new_folder, remove_materialized, shared_folder, spread
from paralane.sinks.files import lock_test_split
from paralane.sources.tables import read_pairs


@pytest.fixture
def folder(tmp_path):
    words = {"english": "word", "nepali": "शब्द", "maithili": "शबद"}
    for domain in ("A", "B"):
        for language, word in words.items():
            lines = [f"{word} {domain} {i} {word}\t{word} e\u0301" for i in range(100)] + ["short"]
            (tmp_path / f"{domain}_{language}.txt").write_text("\n".join(lines), encoding="utf-8")
    return str(tmp_path)


KEYS = ["domain", "line_no", "direction_no"]


def test_from_files_to_scores(spark, folder, tmp_path):
    pairs = read_pairs(spark, "local", data_dir=folder)
    assert pairs.count() == 2 * 4 * 101
    done = prepare(pairs, KEYS, build_rules(max_ascii_ratio_devanagari=0.5))
    report = done.report.first()
    # English lines go to two languages; the later row of the two is a duplicate.
    assert report.total_input == 808 and report.rejected_too_short == 8
    assert report.duplicates_removed == 200 and report.total_output == 600
    rows = done.rows.cache()
    assert sorted(r.asDict()["count"] for r in rows.groupBy("split").count().collect()) == [30, 30, 540]
    assert not rows.where(F.rlike("src", F.lit(r"[\t\u0301]"))).count()
    assert rows.where(F.contains("src", F.lit("\u00e9"))).count() == 600
    assert not rows.where((F.col("src_lang") == ENGLISH) & (F.col("tgt_lang") == MAITHILI)).count()

    def copy():
        return lambda texts, src_lang, tgt_lang: texts

    test = lock_test_split(rows, str(tmp_path / "locked"))
    assert test.count() == 30
    truth = evaluate(test, copy).collect()
    assert {r.direction for r in truth} <= {"English -> Nepali", "Nepali -> English", "Maithili -> English"}
    assert sum(r.n_samples for r in truth) == 30

    runs = str(tmp_path / "runs")
    first = evaluate_and_record(test, copy, runs, run_record(pairs, run_id="first000"), 1.5)
    assert first.comparison.count() == 0
    second = evaluate_and_record(test, copy, runs, run_record(pairs, run_id="second00"))
    rows = second.comparison.collect()
    assert len(rows) == len(truth) and all(r.bleu_delta == 0 and r.previous_runs == 1 for r in rows)
    document = json.loads(spark.read.text(f"{runs}/eval_results.json").first().value)
    assert document["metadata"]["run_id"] == "second00" and len(document["results"]) == len(truth)
    alone = evaluate_and_record(test, copy, runs)
    assert alone.comparison is None


def test_preparing_by_strata_and_with_own_transforms(spark, folder):
    pairs = read_pairs(spark, "local", data_dir=folder)
    upper = build_transforms("NFC", [lambda df: df.withColumn("src", F.upper("src"))])
    rows = prepare(pairs, KEYS, transforms=upper, strata=["src_lang", "domain"], train=0.5, val=0.25).rows
    sizes = rows.groupBy("src_lang", "domain", "split").count().collect()
    assert {(r.split, r["count"]) for r in sizes} == {("train", 50), ("val", 25), ("test", 25)}
    assert rows.where(F.col("src_lang") == ENGLISH).first().src.startswith("WORD")
    assert {r.src_lang for r in sizes} == {ENGLISH, NEPALI, MAITHILI}


def test_rules_and_transforms_on_a_stream(spark, folder, tmp_path):
    pairs = read_pairs(spark, "local", data_dir=folder).drop("line_no", "direction_no")
    path = str(tmp_path / "in")
    pairs.write.parquet(path)
    rules = build_rules()
    stream = spark.readStream.schema(pairs.schema).parquet(path)
    found = apply_transforms(kept(tag_rejections(stream, rules)))
    query = found.writeStream.format("memory").queryName("kept_stream").trigger(availableNow=True).start()
    query.awaitTermination(120)
    whole = apply_transforms(kept(tag_rejections(pairs, rules)))
    assert sorted(spark.table("kept_stream").collect()) == sorted(whole.collect())


def test_spread(spark):
    assert spread(spark.range(10, numPartitions=1), "id").rdd.getNumPartitions() == 4
    many = spark.range(10, numPartitions=9)
    assert spread(many, "id") is many


def test_the_shared_folder_is_that_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == named if named else folder
    assert materialize(spark.range(3)).count() == 3
    assert new_folder(spark, "x").startswith(f"{folder}/x-")


def test_materialized_tables_have_an_owner(spark, tmp_path):
    own = str(tmp_path / "own")
    materialize(spark.range(2), own)
    made = materialize(spark.range(3))
    (path,) = {f.rsplit("/", 1)[0] for f in made.inputFiles()}
    assert remove_materialized(spark) >= 1 and remove_materialized(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert spark.read.parquet(own).count() == 2


def test_rules_run_once_for_rows_and_report(spark, folder):
    pairs = read_pairs(spark, "local", data_dir=folder)
    done = prepare(pairs, KEYS, build_rules())
    for df in done:
        assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_code_points_are_no_python_numbers(spark, monkeypatch):
    """Ids of texts, and texts of ids, as Arrow arrays."""
    from paralane.plans import queries as Q

    texts = ["a b", "", "क😀\n", "é" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    ids = df.select("t", Q._code_points(F.col("t")).alias("ids"))
    assert [r.ids for r in ids.collect()] == [[*map(ord, t), -100, -100] for t in texts]
    back = ids.select("t", Q._from_code_points(F.slice("ids", 1, F.size("ids") - 2)).alias("back"))
    assert [r.back for r in back.collect()] == texts
    plan = back._jdf.queryExecution().toString()
    assert set(re.findall(r"ArrowEvalPython .*, (\d+)$", plan, re.M)) == {"250"}
