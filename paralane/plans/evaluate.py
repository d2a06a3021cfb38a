"""From a locked test split to scores and their comparison with earlier runs."""

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame

from paralane.operators.runs import compare_runs, with_results
from paralane.operators.scores import evaluate_directions
from paralane.operators.translate import Translate, translate_table
from paralane.registry import DISPLAY_NAMES
from paralane.session import materialize
from paralane.sinks.files import write_results_csv, write_results_json, write_run
from paralane.sources.run_history import read_runs


class Evaluated(NamedTuple):
    results: DataFrame
    comparison: DataFrame | None


def evaluate(
    test: DataFrame,
    make_translator: Callable[[], Translate],
    names: Mapping[str, str] = DISPLAY_NAMES,
    batch_size: int = 32,
    repair_question_marks: bool = False,
    by_domain: bool = False,
) -> DataFrame:
    """Predict and score each direction; the predictions are scored as they come by default."""
    predicted = translate_table(
        test, make_translator, batch_size, repair_question_marks=repair_question_marks
    )
    return evaluate_directions(predicted, names, by_domain=by_domain)


def evaluate_and_record(
    test: DataFrame,
    make_translator: Callable[[], Translate],
    folder: str,
    record: DataFrame | None = None,
    duration: float = 0.0,
    names: Mapping[str, str] = DISPLAY_NAMES,
    batch_size: int = 32,
) -> Evaluated:
    """``evaluate``, then export; with a run record also compare and store the run.

    The results and the record are computed a single time, so the translator and the fingerprint run once. The run is stored after it is
    compared, so it never meets itself.
    """
    results = materialize(evaluate(test, make_translator, names, batch_size))
    record = None if record is None else materialize(record)
    write_results_json(results, f"{folder}/eval_results.json", record)
    write_results_csv(results, f"{folder}/eval_results.csv")
    if record is None:
        return Evaluated(results, None)
    run = record.select("run_id", "timestamp").first()
    history = read_runs(results.sparkSession, folder)
    comparison = materialize(compare_runs(results, history, run["run_id"], run["timestamp"]))
    write_run(with_results(record, results, duration), folder, run["run_id"])
    return Evaluated(results, comparison)
