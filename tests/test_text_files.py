import random

import pytest

from paralane.registry import DIRECTIONS
from paralane.sources.text_files import (
    incomplete_domains, numbered_lines, read_aligned_lines, read_text_pairs,
)


def write(folder, name, content):
    (folder / name).write_bytes(content.encode("utf-8"))


def python_pairs(folder):
    """The same on Python strings. A byte-order mark is not text."""
    rows = []
    for english in sorted(folder.glob("*_english.txt")):
        domain = english.name[: -len("_english.txt")]
        files = [folder / f"{domain}_{name}.txt" for name in ("english", "nepali", "maithili")]
        if not all(f.is_file() for f in files):
            continue
        texts = [f.read_text(encoding="utf-8-sig").strip().split("\n") for f in files]
        for triplet in zip(*texts):
            line = dict(zip(("eng_Latn", "npi_Deva", "mai_Deva"), (t.strip() for t in triplet)))
            if all(line.values()):
                rows += [(line[a], line[b], a, b, domain) for a, b in DIRECTIONS]
    return rows


def spark_pairs(spark, folder):
    pairs = read_text_pairs(spark, str(folder)).orderBy("domain", "line_no", "direction_no")
    return [tuple(row)[:5] for row in pairs.collect()]


@pytest.fixture
def folder(tmp_path):
    write(tmp_path, "Bank_english.txt", "one\ntwo\n\nfour\nfive\n")
    write(tmp_path, "Bank_nepali.txt", "एक\nदुई\nतीन\n  \nपाँच\nछ")
    write(tmp_path, "Bank_maithili.txt", "m1\nm2\nm3\nm4\nm5\n\n\n")
    # Leading blank lines move the alignment; other line ends; a byte-order mark.
    write(tmp_path, "Farm_english.txt", "\n \n a one \r\na two\ra three\r\n")
    write(tmp_path, "Farm_nepali.txt", "﻿n one\nn two\nn three")
    write(tmp_path, "Farm_maithili.txt", "\tq one\nq\x85two\nq three\nq four")
    write(tmp_path, "Odd name+%_english.txt", "x")
    write(tmp_path, "Odd name+%_nepali.txt", "y")
    write(tmp_path, "Odd name+%_maithili.txt", "z")
    write(tmp_path, "Lost_english.txt", "a\nb")
    write(tmp_path, "Lost_nepali.txt", "c\nd")
    write(tmp_path, "Empty_english.txt", "")
    write(tmp_path, "Empty_nepali.txt", "\n\n")
    write(tmp_path, "Empty_maithili.txt", "x")
    return tmp_path


def test_pairs(spark, folder):
    expected = python_pairs(folder)
    assert len(expected) == 4 * (3 + 3 + 1)
    assert spark_pairs(spark, folder) == expected


def test_incomplete_domains(spark, folder):
    found = [(r.domain, r.missing) for r in incomplete_domains(spark, str(folder)).collect()]
    assert found == [("Lost", ["maithili"])]


@pytest.fixture
def small_blocks(spark):
    old = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(block):
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield use
    for name, value in old.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("block", [17, 64, 1000])
def test_files_of_many_blocks(spark, tmp_path, small_blocks, block):
    choose = random.Random(block)
    for domain in ("A", "B"):
        for language in ("english", "nepali", "maithili"):
            lines = ["", " "] * choose.randint(0, 20)
            lines += ["".join(choose.choice("ab क") for _ in range(choose.randint(0, 30))) for _ in range(120)]
            end = choose.choice(["\n", "\r\n"])
            write(tmp_path, f"{domain}_{language}.txt", end.join(lines))
    small_blocks(block)
    assert spark.read.text(f"{tmp_path}/A_english.txt").rdd.getNumPartitions() > 1
    assert spark_pairs(spark, tmp_path) == python_pairs(tmp_path)


def test_several_blocks_in_one_partition(spark, tmp_path, small_blocks):
    for i in range(30):
        write(tmp_path, f"{i:02}_english.txt", "\n".join(f"{i} {j}" for j in range(i % 7 + 1)))
    small_blocks(4000)
    lines = numbered_lines(spark, f"{tmp_path}/*_english.txt").collect()
    assert sorted((int(l.line.split()[0]), l.line_no) for l in lines) == [
        (i, j) for i in range(30) for j in range(i % 7 + 1)
    ]
    assert all(l.line_no == int(l.line.split()[1]) for l in lines)


def test_batches_within_a_block(spark, tmp_path):
    write(tmp_path, "A_english.txt", "\n".join(str(i) for i in range(25_000)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 999)
    try:
        lines = numbered_lines(spark, f"{tmp_path}/A_english.txt").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(lines) == 25_000 and all(l.line_no == int(l.line) for l in lines)


def test_a_folder_of_parts_is_a_file(spark, tmp_path, small_blocks):
    from paralane.sinks.files import write_text_files

    lines = spark.range(300).selectExpr(
        "id", "explode(array('english', 'nepali', 'maithili')) AS l"
    ).selectExpr("concat('A b_', l, '.txt') AS file", "id", "concat(l, ' ', id) AS line")
    path = str(tmp_path / "parts")
    write_text_files(lines, path, ["id"])
    small_blocks(500)
    rows = read_text_pairs(spark, path).where("direction_no = 0").orderBy("line_no").collect()
    assert [(r.src, r.tgt, r.domain) for r in rows] == [(f"english {i}", f"nepali {i}", "A b") for i in range(300)]
    assert incomplete_domains(spark, path).count() == 0


def test_lines_are_shuffled_once_per_side(spark, folder):
    plan = read_aligned_lines(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_text_pairs(spark, str(tmp_path))
    write(tmp_path, "A_english.txt", "x")
    with pytest.raises(ValueError):
        read_text_pairs(spark, str(tmp_path))
    write(tmp_path, "A_nepali.txt", " ")
    write(tmp_path, "A_maithili.txt", "x")
    assert read_text_pairs(spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError):
        read_text_pairs(spark, str(tmp_path), require_rows=True)


def test_lines_do_not_go_through_python(spark, tmp_path):
    (tmp_path / "A_english.txt").write_text("a\nb\n", encoding="utf-8")
    plan = numbered_lines(spark, str(tmp_path / "*_english.txt"), "_english.txt")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan
    (call,) = {line.split("ArrowEvalPython")[1] for line in plan.split("\n") if "ArrowEvalPython" in line}
    assert call.startswith(" [_places_within_blocks(xxhash64(") and "value" not in call.split("]")[0]
