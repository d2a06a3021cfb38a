"""CSV files whose quoted fields hold line breaks, read by many tasks.

Lines are read by blocks. Whether a line break is inside quotes depends only on whether the number
of quotes before it is odd: each block says how many quotes and lines it has, sums over the blocks
before it give the state in which it begins, and from that every line knows whether it begins a
record. Only the lines of records that hold line breaks are shuffled, to be joined.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from paralane.sources.text_files import BROADCAST_BLOCKS

BOM = "\ufeff"
#: Lines of a file that are numbered together.
SLICE = 100_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files, parted at line feeds alone, so that a carriage return in a field stays."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"')))


def _sums_within_blocks(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """How many lines and quotes a line's block has before it. Lines of a block come in order, and a
    task reads one block after the other, so only the sums of the last block are carried on."""
    last, lines, quotes = None, 0, 0
    for block, found in batches:
        blocks, own = block.to_numpy(), found.to_numpy(dtype=np.int64)
        if not len(blocks):
            yield pd.DataFrame({"line_no": np.array([], np.int64), "quotes_before": np.array([], np.int64)})
            continue
        starts = np.concatenate([[0], np.flatnonzero(np.diff(blocks) != 0) + 1])
        sizes = np.diff(np.append(starts, len(blocks)))
        before = np.cumsum(own) - own
        before, place = before - np.repeat(before[starts], sizes), np.arange(len(own)) - np.repeat(starts, sizes)
        if blocks[0] == last:
            before[: sizes[0]] += quotes
            place[: sizes[0]] += lines
        last, lines, quotes = blocks[-1], int(place[-1]) + 1, int(before[-1] + own[-1])
        yield pd.DataFrame({"line_no": place, "quotes_before": before})


def records(spark: SparkSession, path: str) -> DataFrame:
    """``path, at, record``: whole records, and the number of the line in its file where each begins.

    Quotes must stand around fields, and be doubled inside them. A file that ends inside a quoted field is
    an error. Blank lines between records are left out, and so is a byte-order mark.
    """
    lines = _lines(spark, path)
    counted = lines.groupBy("path", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(_quotes(F.col("line"))).alias("quotes")
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    offsets = counted.select(
        "path", "block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_ahead") for c in ("lines", "quotes")],
        (F.sum("quotes").over(whole) % 2 == 1).alias("open"),
    )
    blocks_at_most = len(lines.inputFiles()) + 2 * lines.rdd.getNumPartitions()
    if blocks_at_most <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    sums = F.pandas_udf(_sums_within_blocks, "line_no bigint, quotes_before bigint").asNondeterministic()
    placed = lines.withColumn("sums", sums(F.xxhash64("path", "block"), _quotes(F.col("line"))))
    placed = placed.join(offsets, ["path", "block"], "left")
    ahead = F.when(F.col("open"), F.raise_error(F.concat(F.lit("a quoted field has no end in "), "path")).cast("bigint"))
    ahead = ahead.otherwise(F.coalesce(
        "quotes_ahead", F.raise_error(F.lit("a file was split differently in two scans of it")).cast("bigint")
    ))
    placed = placed.select(
        "path", (F.col("lines_ahead") + F.col("sums.line_no")).alias("at"), "line",
        ((ahead + F.col("sums.quotes_before")) % 2 == 1).alias("inside"), (_quotes(F.col("line")) % 2 == 1).alias("turns"),
    )
    # A line outside quotes that opens none is a record; the others belong to one of several lines.
    single = placed.where(~F.col("inside") & ~F.col("turns")).select("path", "at", F.col("line").alias("record"))
    parts = placed.where(F.col("inside") | F.col("turns"))
    begin = F.col("turns") & ~F.col("inside")
    end = F.col("turns") & F.col("inside")
    # A record of several lines has the number of such records that begin before it, summed by slices of lines.
    sliced = parts.withColumn("slice", F.floor(F.col("at") / SLICE))
    begins = sliced.groupBy("path", "slice").agg(F.count_if(begin).alias("n"))
    begins = begins.select("path", "slice", F.coalesce(F.sum("n").over(
        Window.partitionBy("path").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ), F.lit(0)).alias("begun"))
    so_far = Window.partitionBy("path", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = sliced.join(begins, ["path", "slice"]).withColumn("no", F.col("begun") + F.count_if(begin).over(so_far))
    joined = numbered.groupBy("path", "no").agg(
        F.min("at").alias("at"), F.count_if(end).alias("ends"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("record"),
    )
    return single.unionAll(joined.select("path", "at", "record")).where(~F.col("record").isin("", "\r", BOM))


def read_csv_blocks(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of ``read_csv(multi_line=True)``, with a file split among tasks.

    Every file has a header of one line, and all have the same; else it is an error. Without a schema,
    all columns are text. A record that does not fit the schema is an error. The files are scanned three
    times: for the sums of the blocks, for records of one line, and for those of several.
    """
    from paralane.sources.tables import CSV_OPTIONS

    options = {name: str(value).lower() if isinstance(value, bool) else value for name, value in CSV_OPTIONS.items()}
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    schema = schema or T.StructType([T.StructField(name, T.StringType()) for name in names])
    if schema.fieldNames() != names:
        raise ValueError(f"the CSV header has {names}, the schema {schema.fieldNames()}")
    text = T.StructType([T.StructField(f"h{i}", T.StringType()) for i in range(len(names))])
    parse = {k: v for k, v in options.items() if k not in ("header", "enforceSchema", "encoding")} | {"multiLine": "true"}

    def parsed(fields: T.StructType) -> Column:
        bare = F.regexp_replace(F.col("record"), f"^{BOM}", "")
        bare = F.regexp_replace(bare, "\r$", "")
        ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
        return F.from_csv(bare, F.lit(ddl), parse | {"mode": "FAILFAST"})

    header = F.to_json(parsed(text)) == F.to_json(F.struct(*[F.lit(name).alias(f"h{i}") for i, name in enumerate(names)]))
    other = F.raise_error(F.concat(F.lit("another CSV header in "), "path")).cast("boolean")
    body = records(spark, path).where(F.when(F.col("at") > 0, True).otherwise(~F.when(header, True).otherwise(other)))
    return body.select(parsed(schema).alias("row")).select("row.*")
