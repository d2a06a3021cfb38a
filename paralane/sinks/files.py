"""Files that a run leaves: the locked test split, reports, results and run records."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

RESULT_COLUMNS = ("direction", "n_samples", "bleu", "chrf_pp", "domain")


def lock_test_split(
    df: DataFrame, path: str, format: str = "parquet", overwrite: bool = False
) -> DataFrame:
    """Write the rows of the test split once; return what was written, read back with its types."""
    test = df.where(F.col("split") == "test").drop("split") if "split" in df.columns else df
    writer = test.write.mode("overwrite" if overwrite else "errorifexists")
    if format == "csv":
        writer.options(
            header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
    else:
        writer.format(format).save(path)
    from paralane.sources.tables import read_locked_test

    return read_locked_test(df.sparkSession, path, format, test.schema)


def write_text_files(lines: DataFrame, path: str, order_by: Sequence[str]) -> None:
    """Write ``file, line`` as text files, each a folder of parts in the order of its lines.

    A sort by range splits large files among tasks.
    """
    ordered = lines.orderBy("file", *order_by).select("file", "line")
    ordered.write.partitionBy("file").text(path)


def write_results_json(results: DataFrame, path: str, record: DataFrame | None = None) -> None:
    """One document ``{"metadata": ..., "results": [...]}``. A result table is a few rows."""
    rows = F.array_sort(F.collect_list(F.struct(*RESULT_COLUMNS)))
    document = results.agg(rows.alias("results"))
    if record is None:
        metadata = F.create_map().cast("map<string,string>")
    else:
        metadata = record.select(F.struct("*").alias("metadata")).scalar()
    text = F.to_json(
        F.struct(metadata.alias("metadata"), F.col("results")), {"ignoreNullFields": "false"}
    )
    document.select(text.alias("value")).write.mode("overwrite").text(path)


def write_results_csv(results: DataFrame, path: str) -> None:
    results.select(*RESULT_COLUMNS).write.mode("overwrite").csv(path, header=True)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def write_run(record: DataFrame, folder: str, run_id: str, overwrite: bool = False) -> str:
    """Write a run record to ``<folder>/<run id>/run_metadata.json``.

    The whole id names the folder, so no run takes the place of another; a second record of one
    run is an error unless ``overwrite`` is set.
    """
    path = f"{folder.rstrip('/')}/{run_id}/run_metadata.json"
    record.write.mode("overwrite" if overwrite else "errorifexists").json(path, ignoreNullFields=False)
    return path
