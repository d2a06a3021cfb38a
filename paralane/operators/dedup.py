"""Keep the first row of each key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, on: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the order of ``order_by``, which must be unique per row.

    A filter on ``row_number() = 1`` limits each group on the map side before the shuffle, so
    a key that holds a third of all rows sends one row per map task. Null keys are one key.
    """
    first = Window.partitionBy(*on).orderBy(*order_by)
    numbered = df.withColumn("__nth", F.row_number().over(first))
    return numbered.where(F.col("__nth") == 1).drop("__nth")
