"""The pipeline end to end, with its effects checked against the operators' brute-force results."""

import corpus_pipeline


def test_pipeline(spark, folder):
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, data).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert docs.columns == names
            sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0] and sizes[-1] < sizes[0]
    survivors = spark.read.parquet(f"{folder}/personal_data")
    assert survivors.select("text").distinct().count() == survivors.count()
    assert docs.select("doc_id").distinct().count() == survivors.count()


def test_empty_corpus(spark, folder):
    data = "/root/testdata/sf0.001"
    spark.read.parquet(f"{data}/documents.parquet").limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{data}/labels.parquet").limit(0).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
