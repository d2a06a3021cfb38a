"""The records of earlier runs."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paralane.registry import RUN_SCHEMA

_CORRUPT = "_corrupt"


def read_runs(spark: SparkSession, folder: str, name: str = "run_metadata.json") -> DataFrame:
    """All ``<run>/run_metadata.json`` below a folder, unreadable ones left out, by path.

    A folder without any gives an empty table.
    """
    schema = T.StructType([*RUN_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).options(
        multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT
    )
    try:
        runs = reader.json(f"{folder.rstrip('/')}/*/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], RUN_SCHEMA)
        return empty.withColumn("_source_file", F.lit(None).cast("string"))
    readable = runs.withColumn("_source_file", F.col("_metadata.file_path"))
    # Always true. Spark refuses a query that needs no field but the corrupt one, such as a count.
    some_field = F.length(F.coalesce("run_id", F.lit(""))) >= 0
    return readable.where(F.col(_CORRUPT).isNull() & some_field).drop(_CORRUPT).orderBy("_source_file")
