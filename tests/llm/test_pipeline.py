import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    from cataloom.llm.scratch import Scratch

    scratch = Scratch(spark, "test")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        before, docs = rows, scratch.save(stage(spark, docs, SMALL), name)
        rows = docs.count()
        if name == "packing":
            assert docs.select("doc_id").distinct().count() == before
        else:
            assert docs.columns == columns
            assert rows == before if name in ("substring_dedup", "secret_scan") else rows < before
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in corpus_pipeline.QUERIES


def test_no_labels_no_documents_and_null_or_repeated_ids(spark, tmp_path):
    """Without labels nothing is rejected; null and repeated ids stay; an empty table runs through."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "no id at all " * 9, "en", "a", 1), (3, "some text of its own", "en", "a", 1), (3, "another text with that id", None, None, None), (4, None, "fr", "b", 0), (5, "", "fr", "b", 0)]
    for name, docs in (("some", rows), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        kept = corpus_pipeline.toxicity(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        assert kept.count() == len(docs) and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        packed = corpus_pipeline.run(spark, folder).collect()
        assert len(packed) >= min(len(docs), 4) and (not docs or {r["doc_id"] for r in packed} >= {None, 3})
