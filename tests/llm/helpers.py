"""Small tables with what may go wrong: nulls, empty and long texts, ties, repeats, clashing names."""

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "doc_id long, text string, lang string, shard int, slot string, fingerprint string, kept string, ids string"


def awkward(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """(doc_id, text) rows with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, text, None, 7, "x", None, "y", "z") for i, text in rows], COLUMNS)


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))

ROWS: list[tuple[int | None, str | None]] = [
    (1, "Alpha beta\tgamma delta"), (2, "alpha  beta gamma delta"), (3, "Alpha beta gamma delta"),
    (4, None), (5, ""), (6, " \n\t"), (7, LONG), (8, LONG + " "), (9, "x" * 5000),
    (10, "é漢字 😀 ’s it's"), (11, "<|endoftext|> inside"), (None, "Alpha beta gamma delta"), (None, None),
    (12, "same row"), (12, "same row"), (13, "b a"), (14, "ba"),
]
