"""Joins of the given tables: what they return, and how often they are made."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paralane.plans import queries as Q, views as V

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("count", [1, 2, 3])
def test_documents_beside_the_next_ones(spark, count):
    choose = random.Random(count)
    rows = [(choose.choice([choose.randint(-40, 40), None]), f"t{i}") for i in range(120)]
    found = V.beside_next(spark.createDataFrame(rows, "doc_id long, text string"), count)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    expected = [(row,) for row in rows if row[0] is not None]
    for shift in range(1, count):
        expected = [(*known, row) for known in expected for row in rows if row[0] == known[0][0] + shift]
    assert sorted(tuple(map(tuple, row)) for row in found.collect()) == sorted(expected)


def test_text_files_shuffle_a_document_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(Q, "write_text_files", lambda rows, *_: plans.append(rows))
    Q._written_text_files(spark, FOLDER)
    assert plans[0]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(block") == 1
    assert "Join" not in plans[0]._jdf.queryExecution().executedPlan().toString()


def test_batches_are_made_of_pairs_that_were_joined_once(spark):
    files = Q.padded_token_batches(spark, FOLDER).inputFiles()
    assert files and not any("documents.parquet" in file for file in files)


def test_formats_are_made_of_pairs_that_were_joined_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    pairs = V.line_pairs(spark, FOLDER)

    @F.udf("string")
    def seen(text):
        made.add(1)
        return text

    monkeypatch.setattr(Q.V, "line_pairs", lambda *_: pairs.withColumn("src", seen.asNondeterministic()("src")))
    counted = Q.table_formats(spark, FOLDER).groupBy("format").agg(F.sum("n").alias("n")).collect()
    assert made.value == pairs.count()
    assert {row.format: row.n for row in counted} == dict.fromkeys(("parquet", "orc", "json"), made.value)


def test_scored_lines_are_those_of_line_pairs(spark, monkeypatch):
    rows = [
        (1, "a b\nc", "en", "s"), (2, "d e f g h i\nj\nk", "fr", "s"), (3, None, "de", "t"), (4, "", "en", None),
        (5, "\n\nx", "de", "t"), (6, "y\u00a0z w v u t", None, "t"), (8, "last", "en", "s"), (None, "m", "en", "s"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(V, "read_table", lambda *_: table)
    expected = V.line_pairs(spark, FOLDER).drop("src").collect()
    found = V.scored_pairs(spark, FOLDER)
    assert len(expected) == 4
    assert sorted(map(str, found.drop("prediction").select(*expected[0].__fields__).collect())) == sorted(map(str, expected))
    assert {(row.tgt, row.prediction) for row in found.collect()} >= {("d e f g h i", "d e f g i"), ("", "")}


def test_scored_lines_join_the_number_of_source_lines(spark):
    plan = V.scored_pairs(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert " AS src#" not in plan and " AS n_src#" in plan
    assert re.search(r"REPARTITION_BY_NUM[^\n]*\n[^\n]*Project \[\(doc_id#\d+L - 1\) AS doc_id#\d+L, text#", plan)
