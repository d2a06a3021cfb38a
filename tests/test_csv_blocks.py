import csv
import random

import pytest

from paralane.sources.csv_blocks import read_csv_blocks, records
from paralane.sources.tables import read_csv


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name in names:
        spark.conf.set(name, "700")
    yield
    for name in names:
        spark.conf.unset(name)


def written(path, rows, end="\n", names=("a", "b", "c")):
    with open(path, "w", encoding="utf-8", newline="") as file:
        csv.writer(file, lineterminator=end).writerows([names, *rows])


def awkward_rows(seed, n=300):
    rng = random.Random(seed)
    parts = ["x", '"', ",", "\n", "\n\n", " ", "é漢😀", "NA", "null", "\\", "word word", "\r\n", "'"]
    return [tuple("".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) + "." for _ in range(3)) for _ in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_split_file_gives_the_rows_that_were_written(spark, tmp_path, small_blocks, end):
    rows = awkward_rows(1)
    written(tmp_path / "a.csv", rows, end)
    assert records(spark, str(tmp_path)).count() == len(rows) + 1
    read = read_csv_blocks(spark, str(tmp_path))
    assert read.columns == ["a", "b", "c"]
    assert sorted(map(tuple, read.collect())) == sorted(rows)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8


def test_several_files_equal_the_reader_of_whole_files(spark, tmp_path, small_blocks):
    for i in range(3):
        written(tmp_path / f"{i}.csv", awkward_rows(i, 60) + [("", "x", "")])
    whole = read_csv(spark, str(tmp_path), multi_line=True)
    assert sorted(map(str, read_csv_blocks(spark, str(tmp_path)).collect())) == sorted(map(str, whole.collect()))


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f"line {i}, \"quoted\"" for i in range(500))
    written(tmp_path / "a.csv", [("1", long, "z"), ("2", "", "end")])
    assert sorted(r["b"] or "" for r in read_csv_blocks(spark, str(tmp_path)).collect()) == ["", long]


def test_mark_blank_lines_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,text\n\n1,"a\nb"\n\n2,c\n', encoding="utf-8")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    assert sorted(map(tuple, read_csv_blocks(spark, str(tmp_path), schema).collect())) == [(1, "a\nb"), (2, "c")]


def test_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"open\n2,3\n', encoding="utf-8")
    with pytest.raises(Exception, match="has no end"):
        read_csv_blocks(spark, str(tmp_path)).collect()
    (tmp_path / "a.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n", encoding="utf-8")
    with pytest.raises(Exception, match="another CSV header"):
        read_csv_blocks(spark, str(tmp_path)).collect()


def test_header_alone(spark, tmp_path):
    written(tmp_path / "a.csv", [])
    assert read_csv_blocks(spark, str(tmp_path)).count() == 0
