import corpus_pipeline
from paralane.session import materialize


def test_stages_on_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder))
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    whole = corpus_pipeline.run(spark, folder)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed.select(key).collect())) == sorted(map(tuple, whole.select(key).collect()))
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_five_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "substring dedup", "best-fit packing",
    ]
