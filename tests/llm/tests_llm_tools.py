"""Plain versions that several tests of the corpus operators share."""

from test_simhash import plain_components, plain_fingerprint


def near_groups(texts):
    return plain_components({i: plain_fingerprint(t) for i, t in texts.items()})


def write_tables(spark, folder, documents, benchmark, labels):
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder
