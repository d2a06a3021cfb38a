"""Records of runs, and the comparison of a run with those before it."""

import hashlib
import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, functions as F

from paralane.functions import text as X
from paralane.operators.fingerprint import dataset_hash
from paralane.session import materialize


def config_hash(config: Mapping[str, Any]) -> str:
    canonical = json.dumps(config, sort_keys=True, default=str)
    return hashlib.sha256(canonical.encode("utf-8")).hexdigest()


def run_record(
    df: DataFrame,
    config: Mapping[str, Any] | None = None,
    environment: Mapping[str, str] | None = None,
    git_commit: str = "unknown",
    seed: int = 42,
    hash_rows: bool = True,
    run_id: str | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """One row that describes a run on the table ``df``.

    Id and time are set when the record is made, not when it is computed, so that each
    evaluation of it gives the same record.
    """
    run_id = run_id or str(uuid.uuid4())
    timestamp = timestamp or datetime.now(timezone.utc).isoformat()
    if hash_rows:
        base = dataset_hash(df, seed=seed)
    else:
        base = df.sparkSession.range(1).select(F.lit("").alias("dataset_hash"))
    entries = [F.lit(item) for pair in (environment or {}).items() for item in pair]
    environment_map = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return base.select(
        F.lit(run_id).alias("run_id"),
        F.lit(git_commit).alias("git_commit"),
        F.lit(config_hash(config) if config is not None else "").alias("config_hash"),
        "dataset_hash",
        F.lit(timestamp).alias("timestamp"),
        F.lit(0.0).alias("training_duration_seconds"),
        F.create_map().cast("map<string,double>").alias("final_metrics"),
        environment_map.alias("environment"),
    )


def _totals(results: DataFrame) -> DataFrame:
    """A direction's own row, without those of its domains."""
    if "is_total" in results.columns:
        return results.where("is_total")
    return results.where(F.col("domain").isNull()) if "domain" in results.columns else results


def final_metrics(results: DataFrame) -> DataFrame:
    """One row: the map of all scores of a result table, one entry per direction and metric."""
    entries = F.array(
        F.struct(X.metric_key("direction", "bleu").alias("key"), F.col("bleu").alias("value")),
        F.struct(X.metric_key("direction", "chrf++").alias("key"), F.col("chrf_pp").alias("value")),
    )
    gathered = F.array_sort(F.flatten(F.collect_list(entries)))
    return _totals(results).agg(F.map_from_entries(gathered).alias("final_metrics"))


def with_results(record: DataFrame, results: DataFrame, duration: float = 0.0) -> DataFrame:
    """The record with its scores, one per direction, and the time its training took."""
    scores = final_metrics(results).select("final_metrics").scalar()
    return record.withColumns(
        {"final_metrics": scores, "training_duration_seconds": F.lit(float(duration))}
    )


def best_scores(history: DataFrame) -> DataFrame:
    """The best earlier score of each direction and metric, in long form."""
    scores = history.select(F.explode("final_metrics").alias("key", "value"))
    # The metric follows the last slash; a direction may have slashes of its own.
    split = scores.select(
        F.regexp_extract("key", "^(.*)/([^/]*)$", 1).alias("direction_key"),
        F.lower(F.regexp_extract("key", "^(.*)/([^/]*)$", 2)).alias("metric"),
        "value",
    )
    kind = F.when(F.contains("metric", F.lit("bleu")), "bleu").when(
        F.contains("metric", F.lit("chrf")), "chrf"
    )
    return (
        split.withColumn("metric", kind)
        .where(F.col("metric").isNotNull())
        .groupBy("direction_key", "metric")
        .agg(F.greatest(F.lit(0.0), F.max("value")).alias("best"))
    )


def compare_runs(
    results: DataFrame, history: DataFrame, run_id: str = "current", timestamp: str = ""
) -> DataFrame:
    """Each direction's scores beside the best of earlier runs; empty if there are none.

    The history, a row per run, is read and written once, when this is called; it is reduced to a
    row per direction before it meets the results.
    """
    earlier = history.where(F.col("run_id").isNull() | (F.col("run_id") != run_id))
    earlier = materialize(earlier.select("run_id", "final_metrics"))
    runs = earlier.agg(F.count(F.lit(1)).alias("n")).scalar()
    best = (
        best_scores(earlier)
        .groupBy("direction_key")
        .agg(
            F.max(F.when(F.col("metric") == "bleu", F.col("best"))).alias("best_bleu"),
            F.max(F.when(F.col("metric") == "chrf", F.col("best"))).alias("best_chrf"),
        )
    )
    current = _totals(results).withColumn("direction_key", X.metric_key("direction"))
    best_bleu, best_chrf = F.coalesce("best_bleu", F.lit(0.0)), F.coalesce("best_chrf", F.lit(0.0))
    return (
        current.join(best, "direction_key", "left")
        .withColumn("previous_runs", runs)
        .where(F.col("previous_runs") > 0)
        .select(
            "direction",
            F.col("bleu").alias("current_bleu"),
            F.col("chrf_pp").alias("current_chrf"),
            best_bleu.alias("best_prev_bleu"),
            best_chrf.alias("best_prev_chrf"),
            F.round(F.col("bleu") - best_bleu, 2).alias("bleu_delta"),
            F.round(F.col("chrf_pp") - best_chrf, 2).alias("chrf_delta"),
            F.lit(run_id).alias("current_run_id"),
            F.lit(timestamp).alias("current_timestamp"),
            "previous_runs",
        )
    )
