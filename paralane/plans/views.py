"""Tables of translation pairs made from general text tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paralane.functions import text as X
from paralane.operators.rules import build_rules
from paralane.operators.scores import scores_of, sum_groups, with_row_sums
from paralane.registry import FILE_LANGUAGES
from paralane.session import spread
from paralane.sources.text_files import zip_lines

# Limits under which every rule but one rejects some of the lines.
LINE_RULES = {
    "min_word_len": 3,
    "max_word_len": 40,
    "max_length_ratio": 3.5,
    "max_ascii_ratio_devanagari": 0.93,
    "devanagari": ("fr", "de"),
}
LANGUAGE_NAMES = {"en": "English", "fr": "French", "de": "German"}


def line_rules():
    return build_rules(**LINE_RULES)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(table, table.columns[0])


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    lines = F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    return documents.select("doc_id", "lang", "source", lines).withColumn("pos", F.col("pos").cast("long"))


def line_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of each document beside the lines of the next one, by position.

    Documents are joined, not lines, so that a text is shuffled once on each side.
    """
    documents = read_table(spark, folder, "documents")
    left = documents.select(
        "doc_id", F.split("text", "\n", -1).alias("src"), F.col("lang").alias("src_lang"),
        F.col("source").alias("domain"),
    )
    right = documents.select(
        (F.col("doc_id") - 1).alias("doc_id"), F.split("text", "\n", -1).alias("tgt"),
        F.col("lang").alias("tgt_lang"),
    )
    both = left.join(right, "doc_id")
    shorter = F.least(F.size("src"), F.size("tgt"))
    lines = F.arrays_zip(F.slice("src", 1, shorter).alias("src"), F.slice("tgt", 1, shorter).alias("tgt"))
    paired = both.select("doc_id", F.posexplode(lines).alias("pos", "line"), "src_lang", "tgt_lang", "domain")
    return paired.select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "line.src", "line.tgt", "src_lang", "tgt_lang", "domain"
    )


# The ids of a block differ in this many last bits: 16 documents meet, beside copies of the next ones.
BLOCK_BITS = 4


def beside_next(documents: DataFrame, count: int) -> DataFrame:
    """Each document as a struct ``d0``, beside the next ones by id as ``d1``, ``d2``, ...: rows as of a
    join for each.

    Blocks of ids are grouped. A document is shuffled once, and a second time if it follows one of
    another block.
    """
    homes = [F.shiftright(F.col("doc_id") - shift, BLOCK_BITS) for shift in range(count)]
    placed = documents.where(F.col("doc_id").isNotNull()).select(
        F.explode(F.array_distinct(F.array(*homes))).alias("block"), F.struct("*").alias("document")
    )
    blocks = placed.groupBy("block").agg(F.collect_list("document").alias("documents"))
    own = F.filter("documents", lambda document: F.shiftright(document["doc_id"], BLOCK_BITS) == F.col("block"))
    rows = F.transform(own, lambda document: F.struct(document.alias("d0")))
    for shift in range(1, count):
        rows = F.flatten(F.transform(rows, lambda row: _with_next(row, shift)))
    return blocks.select(F.inline(rows))


def _with_next(row: Column, shift: int) -> Column:
    others = F.filter("documents", lambda other: other["doc_id"] - shift == row["d0"]["doc_id"])
    known = [row[f"d{i}"].alias(f"d{i}") for i in range(shift)]
    return F.transform(others, lambda other: F.struct(*known, other.alias(f"d{shift}")))


def target_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``line_pairs`` without the source lines, of which only the number is joined: a text is shuffled once.

    Scoring takes long for the size of its input, so its partitions are as many as the session names, not joined.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    documents = read_table(spark, folder, "documents").where("text IS NOT NULL")
    left = documents.select(
        "doc_id", F.size(F.split("text", "\n", -1)).alias("n_src"), F.col("lang").alias("src_lang"),
        F.col("source").alias("domain"),
    )
    right = documents.select((F.col("doc_id") - 1).alias("doc_id"), "text", F.col("lang").alias("tgt_lang"))
    right = right.repartition(partitions, "doc_id")
    tgt = F.split("text", "\n", -1)
    lines = F.posexplode(F.slice(tgt, 1, F.least("n_src", F.size(tgt)))).alias("pos", "tgt")
    paired = left.join(right, "doc_id").select("doc_id", lines, "src_lang", "tgt_lang", "domain")
    return paired.withColumn("pos", F.col("pos").cast("long"))


def scored_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Target lines with a faulty prediction: the target without each fifth word."""
    pairs = target_lines(spark, folder)
    without_fifth = F.filter(X.words("tgt"), lambda word, i: (i % 5) != 4)
    return pairs.withColumn("prediction", F.concat_ws(" ", without_fifth))


def line_triplets(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of three documents in a row, by position; a column per language code."""
    lines = document_lines(spark, folder)
    sides = {
        code: lines.select((F.col("doc_id") - shift).alias("doc_id"), "pos", "line")
        for shift, code in enumerate(FILE_LANGUAGES.values())
    }
    return zip_lines(sides, ["doc_id", "pos"])


BY_SOURCE = ("domain", "src_lang", "tgt_lang")


def score_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The additive parts of the scores, by source and direction."""
    return sum_groups(with_row_sums(scored_pairs(spark, folder)), BY_SOURCE)


def score_history(summed: DataFrame) -> DataFrame:
    """Run records as if each source had been a run: the scores of its own rows."""
    by_source = scores_of(summed, BY_SOURCE)
    key = X.metric_key(X.display_direction(LANGUAGE_NAMES))
    entries = F.array(
        F.struct(F.concat(key, F.lit("/bleu")).alias("key"), F.round("bleu", 2).alias("value")),
        F.struct(F.concat(key, F.lit("/chrf++")).alias("key"), F.round("chrf_pp", 2).alias("value")),
    )
    metrics = F.map_from_entries(F.flatten(F.collect_list(entries)))
    runs = by_source.groupBy(F.col("domain").alias("run_id")).agg(metrics.alias("final_metrics"))
    return runs


def chat_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each turn of a user beside the answer."""
    turns = read_table(spark, folder, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("src"))
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt")
    )
    return asked.join(answered, ["conv_id", "turn"])
