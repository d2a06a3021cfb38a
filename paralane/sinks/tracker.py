"""An experiment store of three Parquet tables: metrics, tables and artifacts."""

from collections.abc import Mapping, Sequence
from typing import Any

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

METRICS = "run_id string, step long, key string, value double"
ARTIFACTS = "run_id string, name string, type string, json string"


class Tracker:
    """Appends to the store. The ``none`` backend drops all it is given."""

    def __init__(
        self, spark: SparkSession, folder: str, run_id: str, backend: str = "table",
        project: str = "", run_name: str = "",
    ):
        if backend not in ("table", "none"):
            raise ValueError(f"unknown backend {backend!r}; use 'table' or 'none'")
        self.spark, self.folder, self.run_id, self.backend = spark, folder.rstrip("/"), run_id, backend
        self.log_artifact("run", {"project": project, "run_name": run_name}, "run")

    def _append(self, name: str, rows: DataFrame) -> None:
        if self.backend == "table":
            rows.write.mode("append").parquet(f"{self.folder}/{name}")

    def log_config(self, config: Mapping[str, Any]) -> None:
        self.log_artifact("config", config, "config")

    def log_metrics(self, metrics: Mapping[str, float], step: int | None = None) -> None:
        rows = [(self.run_id, step, key, float(value)) for key, value in metrics.items()]
        self._append("metrics", self.spark.createDataFrame(rows, METRICS))

    def log_metrics_table(self, rows: DataFrame) -> None:
        """Metrics that are already a table ``step, metrics map``."""
        long = rows.select(
            F.lit(self.run_id).alias("run_id"), F.col("step").cast("long").alias("step"),
            F.explode("metrics").alias("key", "value"),
        )
        self._append("metrics", long.withColumn("value", F.col("value").cast("double")))

    def log_table(self, name: str, table: DataFrame, columns: Sequence[str] | None = None) -> None:
        """Each row as JSON, so that tables of any columns share one store."""
        rows = table.select(*columns) if columns else table
        self._append(
            "tables",
            rows.select(
                F.lit(self.run_id).alias("run_id"), F.lit(name).alias("name"),
                F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"),
            ),
        )

    def log_artifact(self, name: str, data: Mapping[str, Any] | DataFrame, type: str = "result") -> None:
        if isinstance(data, DataFrame):
            rows = data.select(
                F.lit(self.run_id).alias("run_id"), F.lit(name).alias("name"),
                F.lit(type).alias("type"), F.to_json(F.struct("*")).alias("json"),
            )
        else:
            text = json.dumps(data, ensure_ascii=False, default=str)
            rows = self.spark.createDataFrame([(self.run_id, name, type, text)], ARTIFACTS)
        self._append("artifacts", rows)

    def log_eval_results(self, results: DataFrame) -> None:
        shown = results.select("direction", "n_samples", "bleu", F.col("chrf_pp").alias("chrf++"))
        self.log_table("evaluation/results_table", shown)

    def log_checkpoint(self, record: DataFrame, global_step: int, epoch: float) -> None:
        """The run's record at a saved step."""
        saved = record.withColumns(
            {"global_step": F.lit(global_step).cast("long"), "epoch": F.lit(float(epoch))}
        )
        self.log_artifact("checkpoint", saved, "checkpoint")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}").where(F.col("run_id") == self.run_id)
