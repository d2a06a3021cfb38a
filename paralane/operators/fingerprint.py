"""Fingerprints of a table's content, independent of the order of its rows and partitions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paralane.operators.ranks import BUCKET, HASH, encoded, histogram


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of a row. Lengths go before values, so no two rows read the same."""
    return F.sha2(F.concat_ws("|", *encoded(columns)), 256)


def dataset_hash(
    df: DataFrame,
    sample_n: int = 5000,
    seed: int = 42,
    columns: Sequence[str] | None = None,
    digits: int = 4,
) -> DataFrame:
    """One row: SHA-256 over ``sample_n`` rows, or over all rows if there are no more.

    The sample is the rows with the smallest seeded hashes; a histogram of the hashes' first digits
    tells which rows can be among them. Each bucket of rows is hashed by itself (copies of a row as
    their number), and then the hashes of the buckets, at most 16 ** digits: no task gets the whole
    sample, whatever its size.
    """
    names = sorted(columns or df.columns)
    hashes = df.select(row_hash(names).alias("h"))
    hashes = hashes.withColumn(HASH, F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("h")), 256))
    sizes = histogram(hashes, [], digits).where(F.col("__before") < sample_n).select(BUCKET, "__before")
    counted = (
        hashes.groupBy(HASH, "h").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn(BUCKET, F.substring(HASH, 1, digits))
        .join(F.broadcast(sizes), BUCKET)
    )
    before = Window.partitionBy(BUCKET).orderBy(HASH).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("__before") + F.coalesce(F.sum("copies").over(before), F.lit(0))
    taken = F.least("copies", F.lit(sample_n) - earlier)
    sample = counted.withColumn("taken", taken).where(F.col("taken") > 0)
    lines = F.sort_array(F.collect_list(F.concat("h", F.lit(":"), F.col("taken").cast("string"))))
    buckets = sample.groupBy(BUCKET).agg(F.sha2(F.concat_ws("\n", lines), 256).alias("b"))
    joined = F.concat_ws("\n", F.sort_array(F.collect_list(F.concat(BUCKET, F.lit(":"), "b"))))
    return buckets.agg(F.sha2(joined, 256).alias("dataset_hash"))


def whole_dataset_hash(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: a hash of all rows, from the sums of eight slices of the row hashes.

    Sums add up in any order and tell one copy of a row from two, unlike XOR.
    """
    names = sorted(columns or df.columns)
    hashes = df.select(row_hash(names).alias("h"))
    slices = [
        F.sum(F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).alias(f"s{i}")
        for i in range(8)
    ]
    sums = hashes.agg(F.count(F.lit(1)).alias("n"), *slices)
    text = F.concat_ws("|", F.col("n").cast("string"), *[F.col(f"s{i}").cast("string") for i in range(8)])
    return sums.select(F.sha2(text, 256).alias("dataset_hash"), F.col("n").alias("n_rows"))
