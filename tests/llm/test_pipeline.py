import corpus_pipeline
from paperloom.llm import storage

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    docs = storage.documents(spark, SF)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash", "decontamination", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = storage.staged(stage(spark, before, SF), name)
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        assert 0 < after.count() <= before.count()
        assert after.select("doc_id").distinct().count() == after.count()
        if name == "line_dedup":
            assert after.count() == before.count()
            assert after.filter("n_chars <> length(text)").count() == 0
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in before.select("doc_id").collect()}


def test_empty_tables(spark, tables, frame):
    sf = tables(
        documents=frame([], "doc_id long, text string, lang string, source string, n_chars long"),
        labels=frame([], "doc_id long, quality int, toxic int"),
        benchmark=frame([], "item_id long, text string"),
    )
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_odd_rows(spark, tables, frame, odd_documents):
    docs = odd_documents.selectExpr("doc_id", "text", "lang", "start AS source", "CAST(length(text) AS long) AS n_chars", "'clash' AS row_hash")
    sf = tables(documents=docs, labels=frame([(3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"), benchmark=frame([(1, None), (2, "x y x y x y")], "item_id long, text string"))
    assert corpus_pipeline.run(spark, sf).count() > 0
