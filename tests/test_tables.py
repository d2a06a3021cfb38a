import pytest
from pyspark.sql import functions as F

from paralane.operators import shape
from paralane.registry import PAIR_SCHEMA
from paralane.sources.tables import read_csv, read_locked_test, read_pairs, read_table

ROWS = [("a, \"b\"\nc", "NA", "null", "None", ""), (" x ", "\\y", "e", "n", "d")]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(ROWS, PAIR_SCHEMA)


def test_csv_keeps_all_words(spark, tmp_path):
    path = tmp_path / "pairs.csv"
    path.write_text(
        'src,tgt,src_lang,tgt_lang,domain,extra\n"a, ""b""\nc",NA,null,None,"",1\n" x ",\\y,e,n,d,\n', encoding="utf-8"
    )
    rows = read_csv(spark, str(path), multi_line=True).collect()
    assert [tuple(r)[:5] for r in rows] == ROWS
    assert rows[0].extra == "1"
    assert [tuple(r)[:5] for r in read_pairs(spark, "local", csv_path=str(path), multi_line=True).collect()] == ROWS


def test_csv_with_a_schema(spark, tmp_path):
    path = tmp_path / "pairs.csv"
    path.write_text("src,tgt,src_lang,tgt_lang,domain\na,b,c,d,e\n", encoding="utf-8")
    assert tuple(read_csv(spark, str(path), PAIR_SCHEMA, multi_line=True).first()) == ("a", "b", "c", "d", "e")
    path.write_text("tgt,src,src_lang,tgt_lang,domain\na,b,c,d,e\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(path), PAIR_SCHEMA, multi_line=False).collect()


def test_a_missing_csv_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_pairs(spark, "local", csv_path=str(tmp_path / "none.csv"), multi_line=True).count()
    with pytest.raises(ValueError, match="multi_line"):
        read_pairs(spark, "local", csv_path=str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="multi_line"):
        read_table(spark, str(tmp_path / "none.csv"), format="csv")


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_formats(spark, tmp_path, pairs, format):
    path = str(tmp_path / format)
    pairs.withColumnsRenamed({"src": "en", "tgt": "ne"}).drop("domain").write.format(format).save(path)
    read = read_pairs(spark, "table", path=path, format=format, mapping={"en": "src", "ne": "tgt", "gone": "domain"})
    assert sorted(read.select("src", "tgt", "domain").collect()) == sorted((r[0], r[1], "general") for r in ROWS)


def test_catalog_table(spark, pairs):
    pairs.createOrReplaceTempView("given_pairs")
    assert read_table(spark, table="given_pairs").count() == 2


def test_a_null_domain_stays(spark):
    df = spark.createDataFrame([("a", "b", "c", "d", None)], PAIR_SCHEMA)
    assert shape.to_pairs(df).first().domain is None


def test_wrong_arguments(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown source"):
        read_pairs(spark, "ftp")
    with pytest.raises(ValueError):
        read_pairs(spark, "local")
    with pytest.raises(ValueError):
        read_table(spark)
    with pytest.raises(ValueError, match="tgt_lang"):
        shape.require_columns(spark.range(1).select(F.lit(1).alias("src"), F.lit(1).alias("tgt"), F.lit(1).alias("src_lang")))


def test_sample(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(100).select(
        "id", *[F.col("id").cast("string").alias(c) for c in ("src", "tgt", "src_lang", "tgt_lang")]
    ).write.parquet(path)
    sample = read_pairs(spark, "table", path=path, sample_size=10, sample_keys=["id"])
    assert sample.count() == 10 and "sample_order" in sample.columns
    with pytest.raises(ValueError):
        read_pairs(spark, "table", path=path, sample_size=10)


def test_locked_csv(spark, tmp_path, pairs):
    from paralane.sinks.files import lock_test_split

    split = pairs.withColumn("split", F.when(F.col("domain") == "d", "test").otherwise("train"))
    path = str(tmp_path / "locked")
    assert [tuple(r) for r in lock_test_split(split, path, format="csv").collect()] == [ROWS[1]]
    assert read_locked_test(spark, path, "csv").count() == 1
    typed = split.withColumn("n", F.lit(7)).withColumn("split", F.lit("test"))
    back = lock_test_split(typed, str(tmp_path / "typed"), format="csv")
    assert dict(back.dtypes)["n"] == "int" and back.count() == 2
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        lock_test_split(split, path, format="csv")
    assert lock_test_split(pairs, path, format="csv", overwrite=True).count() == 2


def test_summary_and_statistics(spark, pairs):
    summary = shape.ingestion_summary(pairs).first()
    assert (summary.n_rows, summary.src_langs, summary.domains) == (2, 2, 2)
    assert shape.ingestion_summary(pairs.drop("domain")).first().domains == 1
    assert shape.ingestion_summary(pairs, approximate=True).first().n_rows == 2
    split = pairs.withColumn("split", F.lit("val"))
    stats = shape.split_statistics(split).first()
    assert (stats.train, stats.val, stats.test) == (0, 2, 0)
    assert stats.directions == ["e -> n", "null -> None"] and stats.domains == ["", "d"]
    assert shape.split_statistics(split.drop("domain")).first().domains == []


def test_fan_out_by_own_directions(spark):
    line = spark.createDataFrame([(1, "x", "y")], "k int, en string, ne string")
    rows = shape.fan_out(line, [("ne", "en")], keep=["k"]).collect()
    assert [tuple(r) for r in rows] == [(1, "y", "x", "ne", "en", 0)]
