import hashlib
import json
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paralane.operators import runs as R
from paralane.operators.fingerprint import dataset_hash, row_hash, whole_dataset_hash
from paralane.sinks.files import write_results_csv, write_results_json, write_run
from paralane.sinks.tracker import Tracker
from paralane.sources.run_history import read_runs

RESULTS = "direction string, n_samples long, bleu double, chrf_pp double, domain string"


@pytest.fixture
def results(spark):
    return spark.createDataFrame(
        [("English -> Nepali", 10, 30.5, 50.25, None), ("Nepali -> English", 5, 20.0, 40.0, None),
         ("Nepali -> English", 5, 99.0, 99.0, "one domain")], RESULTS,
    )


def python_hash(rows, n, seed=42, digits=4):
    def one(row):
        parts = ["-" if v is None else f"{len(str(v))}:{v}" for _, v in sorted(row.items())]
        return hashlib.sha256("|".join(parts).encode()).hexdigest()

    hashes = [one(row) for row in rows]
    place = {h: hashlib.sha256(f"{seed}|{h}".encode()).hexdigest() for h in hashes}
    taken = Counter(sorted(hashes, key=place.get)[:n])
    buckets = defaultdict(list)
    for h, copies in taken.items():
        buckets[place[h][:digits]].append(f"{h}:{copies}")
    lines = sorted(f"{b}:{hashlib.sha256(chr(10).join(sorted(x)).encode()).hexdigest()}" for b, x in buckets.items())
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 37, 5000])
def test_dataset_hash(spark, n):
    rows = [{"src": f"w{i % 200}" if i % 3 else "hot", "tgt": None if i % 3 else "same"} for i in range(900)]
    df = spark.createDataFrame([(r["src"], r["tgt"]) for r in rows], "src string, tgt string")
    for given in (df, df.repartition(7), df.select("tgt", "src")):
        for digits in (1, 4):
            assert dataset_hash(given, n, digits=digits).first().dataset_hash == python_hash(rows, n, digits=digits)
    assert dataset_hash(df, n, seed=7).first().dataset_hash == python_hash(rows, n, 7)


def test_hashes_tell_tables_apart(spark):
    def both(rows):
        df = spark.createDataFrame(rows, "a string, b string")
        return dataset_hash(df).first()[0], whole_dataset_hash(df).first().dataset_hash

    tables = [
        [("x", "y")], [("x", "y")] * 2, [("x", "y")] * 3, [("xy", "")], [("", "xy")], [(None, "xy")],
        [("x|1:y", "")], [("-", "xy")], [],
    ]
    assert len({both(rows)[0] for rows in tables}) == len({both(rows)[1] for rows in tables}) == len(tables)
    assert both([("a", "b"), ("c", "d")]) == both([("c", "d"), ("a", "b")])


def test_row_hash_of_any_type(spark):
    df = spark.range(3).select("id", (F.col("id") / 2).alias("half"))
    assert df.select(row_hash(df.columns)).distinct().count() == 3


def test_record(spark, results):
    df = spark.createDataFrame([("a", "b")], "src string, tgt string")
    record = R.run_record(df, {"b": 1, "a": [2]}, {"python": "3"}, git_commit="abc")
    one, two = record.first(), record.first()
    assert one == two and len(one.run_id) == 36 and one.timestamp.endswith("+00:00")
    assert one.config_hash == hashlib.sha256(b'{"a": [2], "b": 1}').hexdigest()
    assert one.environment == {"python": "3"} and one.final_metrics == {}
    assert one.dataset_hash == dataset_hash(df).first()[0]
    assert R.run_record(df, hash_rows=False).first().dataset_hash == ""
    done = R.with_results(record, results, 3).first()
    assert done.training_duration_seconds == 3.0
    assert done.final_metrics == {
        "English_to_Nepali/bleu": 30.5, "English_to_Nepali/chrf++": 50.25,
        "Nepali_to_English/bleu": 20.0, "Nepali_to_English/chrf++": 40.0,
    }


def history_of(spark, folder, runs):
    for name, content in runs.items():
        (folder / name).mkdir()
        (folder / name / "run_metadata.json").write_text(content, encoding="utf-8")
    return read_runs(spark, str(folder))


def test_comparison(spark, tmp_path, results):
    def run(name, metrics):
        return json.dumps({"run_id": name, "final_metrics": metrics}, indent=2)

    history = history_of(spark, tmp_path, {
        "r1": run("r1", {"English_to_Nepali/bleu": 31.0, "English_to_Nepali/chrf++": 10.0}),
        "r2": run("r2", {"English_to_Nepali/bleu": 12.0, "English_to_Nepali/chrf++": 60.0, "English_to_Nepali/other": 99.0}),
        "r3": run("r3", {}), "bad": "{not json", "now": run("now", {"English_to_Nepali/bleu": 99.0}),
    })
    assert [r.run_id for r in history.collect()] == ["now", "r1", "r2", "r3"]
    rows = {r.direction: r for r in R.compare_runs(results, history, "now", "t").collect()}
    nepali = rows["English -> Nepali"]
    assert (nepali.best_prev_bleu, nepali.best_prev_chrf) == (31.0, 60.0)
    assert (nepali.bleu_delta, nepali.chrf_delta) == (-0.5, -9.75)
    assert (nepali.current_run_id, nepali.current_timestamp, nepali.previous_runs) == ("now", "t", 3)
    english = rows["Nepali -> English"]
    assert (english.best_prev_bleu, english.bleu_delta) == (0.0, 20.0) and len(rows) == 2


def test_no_history(spark, tmp_path, results):
    history = read_runs(spark, str(tmp_path / "none"))
    assert history.count() == 0 and R.compare_runs(results, history).count() == 0


def test_stored_run(spark, tmp_path, results):
    df = spark.createDataFrame([("é", "b")], "src string, tgt string")
    record = R.with_results(R.run_record(df, run_id="12345678-90", environment={"ö": "ß"}), results)
    path = write_run(record, str(tmp_path), "12345678-90")
    assert path.endswith("/12345678-90/run_metadata.json")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_run(record, str(tmp_path), "12345678-90")
    write_run(record.withColumn("run_id", F.lit("12345678-91")), str(tmp_path), "12345678-91")
    assert read_runs(spark, str(tmp_path)).count() == 2
    write_run(record, str(tmp_path), "12345678-90", overwrite=True)
    back = read_runs(spark, str(tmp_path)).first()
    assert back.run_id == "12345678-90" and back.environment == {"ö": "ß"}
    assert back.final_metrics == record.first().final_metrics and "12345678" in back._source_file


def test_exports(spark, tmp_path, results):
    write_results_json(results, str(tmp_path / "a"))
    document = json.loads(spark.read.text(str(tmp_path / "a")).first().value)
    assert document["metadata"] == {} and len(document["results"]) == 3
    assert document["results"][0] == {
        "direction": "English -> Nepali", "n_samples": 10, "bleu": 30.5, "chrf_pp": 50.25, "domain": None,
    }
    record = R.run_record(results.select("direction"), run_id="x")
    write_results_json(results, str(tmp_path / "b"), record)
    assert json.loads(spark.read.text(str(tmp_path / "b")).first().value)["metadata"]["run_id"] == "x"
    write_results_csv(results.where("domain is null").coalesce(1), str(tmp_path / "c"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "c")).collect()]
    assert lines[0] == "direction,n_samples,bleu,chrf_pp,domain" and "English -> Nepali,10,30.5,50.25," in lines


def test_tracker(spark, tmp_path, results):
    tracker = Tracker(spark, str(tmp_path / "store"), "r", project="p")
    tracker.log_config({"seed": 1})
    tracker.log_metrics({"loss": 2}, step=3)
    tracker.log_metrics({"best": 0.5})
    tracker.log_metrics_table(results.select(F.lit(9).alias("step"), F.create_map("direction", "bleu").alias("metrics")))
    tracker.log_eval_results(results)
    tracker.log_artifact("report", results.limit(1), "validation")
    tracker.log_checkpoint(R.run_record(results.select("direction"), run_id="r"), 1000, 0.5)
    metrics = {(r.step, r.key): r.value for r in tracker.read("metrics").collect()}
    assert metrics[3, "loss"] == 2.0 and metrics[None, "best"] == 0.5 and len(metrics) == 4
    tables = [json.loads(r.row) for r in tracker.read("tables").collect()]
    assert len(tables) == 3 and set(tables[0]) == {"direction", "n_samples", "bleu", "chrf++"}
    kinds = {r.type: json.loads(r.json) for r in tracker.read("artifacts").collect()}
    assert kinds["config"] == {"seed": 1} and kinds["run"]["project"] == "p"
    assert kinds["checkpoint"]["global_step"] == 1000 and kinds["checkpoint"]["run_id"] == "r"
    Tracker(spark, str(tmp_path / "store"), "other").log_metrics({"loss": 1})
    assert tracker.read("metrics").count() == 5 - 0


def test_no_tracker(spark, tmp_path, results):
    tracker = Tracker(spark, str(tmp_path / "store"), "r", backend="none")
    tracker.log_metrics({"loss": 1})
    tracker.log_eval_results(results)
    assert not (tmp_path / "store").exists()
    with pytest.raises(ValueError):
        Tracker(spark, str(tmp_path), "r", backend="web")
