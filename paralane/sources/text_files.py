"""Line-aligned text files, one per domain and language, as a pair table.

Files are read by blocks, so one file may be larger than any task can hold. A line's number
is its place within its block, plus the lines of the blocks before it, minus the blank lines
that the file begins with. A byte-order mark is not part of the text.

A file may also be a folder of part files, as Spark writes them; the parts follow each other in
the order of their names.
"""

import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paralane.functions import text as X
from paralane.operators.shape import fan_out
from paralane.registry import DIRECTIONS, FILE_LANGUAGES

# Offsets of this many blocks, of 128 MB each by default, take some 200 MB.
BROADCAST_BLOCKS = 1_000_000


def _scan(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def _places_within_blocks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Number the rows of each block, given by a hash. A task reads a block's lines in order, one
    block after the other, so only the place in the last block is carried from batch to batch."""
    last, seen = None, 0
    for batch in batches:
        blocks = batch.to_numpy()
        if not len(blocks):
            yield pd.Series(dtype="int64")
            continue
        starts = np.concatenate([[0], np.flatnonzero(np.diff(blocks) != 0) + 1])
        sizes = np.diff(np.append(starts, len(blocks)))
        place = np.arange(len(blocks)) - np.repeat(starts, sizes)
        if blocks[0] == last:
            place[: sizes[0]] += seen
        last, seen = blocks[-1], int(place[-1]) + 1
        yield pd.Series(place)


def _place_in_block() -> Column:
    """The place of a line in its block. Only a hash of the block goes to Python, not the line."""
    places = F.pandas_udf(_places_within_blocks, "bigint").asNondeterministic()
    return places(F.xxhash64("path", "block"))


def _file_of(path: Column | str, suffix: str) -> Column:
    """The file, or folder of parts, that a path belongs to."""
    ending = re.escape(suffix)
    return F.regexp_extract(path, f"^(.*{ending})(/[^/]*)?$", 1)


def domain_of(path: Column | str, suffix: str) -> Column:
    """The name of the file or folder without its suffix.

    Percent escapes of the path are undone, and so is the ``column=`` that Spark puts before
    the name of a folder of parts.
    """
    path = F.col(path) if isinstance(path, str) else path
    file = _file_of(path, suffix)
    name = F.element_at(F.split(file, "/"), -1)
    name = F.when(path == file, name).otherwise(F.regexp_replace(name, "^[^=]*=", ""))
    # A plus sign is itself in a path, but a space to url_decode.
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.left(decoded, F.length(decoded) - F.lit(len(suffix)))


def numbered_lines(spark: SparkSession, paths: str | Sequence[str], suffix: str = ".txt") -> DataFrame:
    """``domain, line_no, line``: lines from the first that is not blank, numbered from 0.

    The lines are not shuffled, unless there are too many blocks to broadcast. The blocks are
    summed up in a second scan, one row each, and the number of lines before a block depends only on where it begins. Should the two scans
    cut a file at different places, the query fails; it never misaligns lines.
    """
    scan = _scan(spark, paths)
    # Row ids grow in reading order; here they only compare rows of one block in one scan.
    row = F.monotonically_increasing_id()
    blocks = (
        scan.select("path", "block", row.alias("row"), (X.strip("line") != "").alias("filled"))
        .groupBy("path", "block")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            (F.min(F.when(F.col("filled"), F.col("row"))) - F.min("row")).alias("blanks"),
        )
        .withColumn("file", _file_of("path", suffix))
    )
    whole = Window.partitionBy("file")
    before = whole.orderBy("path", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("before", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    offsets = offsets.withColumn("skipped", F.min(F.col("before") + F.col("blanks")).over(whole))
    offset = F.col("before") - F.coalesce("skipped", F.lit(0))
    offsets = offsets.select("path", "block", domain_of("path", suffix).alias("domain"), offset.alias("offset"))
    # Two partitions that follow each other hold more than a block between them.
    blocks_at_most = len(scan.inputFiles()) + 2 * scan.rdd.getNumPartitions()
    if blocks_at_most <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    lines = scan.withColumn("in_block", _place_in_block())
    known = F.coalesce(
        "offset", F.raise_error(F.lit("a file was split differently in two scans of it")).cast("bigint")
    )
    return (
        lines.join(offsets, ["path", "block"], "left")
        .select("domain", (known + F.col("in_block")).alias("line_no"), "line")
        .where(F.col("line_no") >= 0)
    )


def _files(folder: str, language: str) -> str:
    return f"{folder.rstrip('/')}/*_{language}.txt"


def zip_lines(
    sides: Mapping[str, DataFrame], keys: Sequence[str] = ("domain", "line_no"), text: str = "line"
) -> DataFrame:
    """Put the lines with equal keys of several tables side by side, stripped, none blank.

    The tables are joined on the same unique keys, so each is shuffled once.
    """
    joined = None
    for name, lines in sides.items():
        side = lines.select(*keys, X.strip(text).alias(name)).where(F.col(name) != "")
        joined = side if joined is None else joined.join(side, list(keys))
    return joined


def read_aligned_lines(
    spark: SparkSession, folder: str, languages: Mapping[str, str] = FILE_LANGUAGES
) -> DataFrame:
    """``domain, line_no`` and a column per language code.

    Lines past the end of the shortest file, and domains without all files, have no partner
    and drop out of the join.
    """
    sides = {}
    for number, (name, code) in enumerate(languages.items()):
        try:
            sides[code] = numbered_lines(spark, _files(folder, name), f"_{name}.txt")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            if number == 0:
                raise FileNotFoundError(f"no *_{name}.txt files in {folder}") from error
            raise ValueError(f"no domain in {folder} has a file for each language") from error
    return zip_lines(sides)


def read_text_pairs(
    spark: SparkSession,
    folder: str,
    directions: Sequence[tuple[str, str]] = DIRECTIONS,
    languages: Mapping[str, str] = FILE_LANGUAGES,
    require_rows: bool = False,
) -> DataFrame:
    """The pair table of a folder, with its order in ``domain, line_no, direction_no``."""
    lines = read_aligned_lines(spark, folder, languages)
    pairs = fan_out(lines, directions, keep=["domain", "line_no"])
    if require_rows and pairs.isEmpty():
        raise ValueError(f"no sentence pairs in {folder}")
    return pairs.select("src", "tgt", "src_lang", "tgt_lang", "domain", "line_no", "direction_no")


def incomplete_domains(
    spark: SparkSession, folder: str, languages: Mapping[str, str] = FILE_LANGUAGES
) -> DataFrame:
    """Domains of the first language that lack a file, with the languages that are missing.

    Only file names are looked at, not their content.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    names = files.select(F.col("_metadata.file_path").alias("path"))
    found = None
    for language in languages:
        suffix = f"_{language}.txt"
        ours = names.where(_file_of("path", suffix) != "")
        side = ours.select(domain_of("path", suffix).alias("domain"), F.lit(language).alias("language"))
        found = side if found is None else found.unionByName(side)
    wanted = F.array(*[F.lit(language) for language in languages])
    first = next(iter(languages))
    return (
        found.groupBy("domain")
        .agg(F.collect_set("language").alias("present"))
        .where(F.array_contains("present", first) & (F.size("present") < len(languages)))
        .select("domain", F.array_except(wanted, "present").alias("missing"))
        .orderBy("domain")
    )
