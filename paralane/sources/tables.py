"""Pair tables in files of other formats, and the choice of a source."""

from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.sql import DataFrame, SparkSession, types as T

from paralane.operators.ranks import exact_sample
from paralane.operators.shape import require_columns, to_pairs
from paralane.registry import PAIR_SCHEMA
from paralane.sources.csv_blocks import read_csv_blocks
from paralane.sources.text_files import read_text_pairs

# No field of a CSV file reads as null: "NA" and "null" are words like others.
_NO_NULL = "\x00"
CSV_OPTIONS = {
    "header": True,
    "enforceSchema": False,
    "quote": '"',
    "escape": '"',
    "nullValue": _NO_NULL,
    "emptyValue": "",
    "encoding": "UTF-8",
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, multi_line: bool | Literal["split"]
) -> DataFrame:
    """A CSV file with a header. All columns are text, unless a schema is given, which must have
    the header's names.

    ``multi_line`` says whether quoted fields may hold line breaks: if so, a file is read by one
    task; if not, Spark splits large files. There is no default, as either may be wrong. ``"split"``
    takes such fields from large files that are split, see ``read_csv_blocks``. Parquet has no such
    limits and is better between jobs.
    """
    if multi_line == "split":
        return read_csv_blocks(spark, path, schema)
    reader = spark.read.options(**{**CSV_OPTIONS, "multiLine": multi_line})
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_table(
    spark: SparkSession,
    path: str | None = None,
    table: str | None = None,
    format: str = "parquet",
    mapping: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    multi_line: bool | Literal["split"] | None = None,
) -> DataFrame:
    """A columnar, JSON or CSV dataset, or a table of the catalog, in the pair shape.

    CSV needs ``multi_line``, see ``read_csv``.
    """
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    if format == "csv" and multi_line is None:
        raise ValueError("say whether fields of the CSV files may hold line breaks: multi_line")
    if table is not None:
        df = spark.table(table)
    elif format == "csv":
        df = read_csv(spark, path, schema, multi_line=multi_line)
    else:
        reader = spark.read.format(format)
        df = (reader.schema(schema) if schema else reader).load(path)
    return to_pairs(df, mapping)


def read_pairs(
    spark: SparkSession,
    source: str,
    *,
    data_dir: str | None = None,
    csv_path: str | None = None,
    sample_size: int | None = None,
    sample_keys: Sequence[str] | None = None,
    seed: int = 42,
    **options,
) -> DataFrame:
    """The pair table of a source: ``local`` text files or CSV, or a ``table``.

    A sample needs ``sample_keys``, columns that tell the rows apart; it adds ``sample_order``.
    """
    if source == "local":
        if csv_path:
            mapping = options.pop("mapping", None)
            if "multi_line" not in options:
                raise ValueError("say whether fields of the CSV file may hold line breaks: multi_line")
            df = to_pairs(read_csv(spark, csv_path, **options), mapping)
        elif data_dir:
            df = read_text_pairs(spark, data_dir, **options)
        else:
            raise ValueError("a local source needs data_dir or csv_path")
    elif source == "table":
        df = read_table(spark, **options)
    else:
        raise ValueError(f"unknown source {source!r}; use 'local' or 'table'")
    require_columns(df)
    if not sample_size:
        return df
    if not sample_keys:
        raise ValueError("a sample needs sample_keys")
    return exact_sample(df, sample_size, sample_keys, seed, order_column="sample_order")


def read_locked_test(
    spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType = PAIR_SCHEMA
) -> DataFrame:
    """The test split as it was locked. CSV has no types of its own: ``schema`` says which columns
    it holds, by default those of the pair table, and texts may hold line breaks."""
    if format == "csv":
        return read_csv(spark, path, schema, multi_line=True)
    return spark.read.format(format).load(path)
