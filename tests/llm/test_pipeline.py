"""The pipeline's stages on a small corpus with planted cases."""

import corpus_pipeline
from tickertide.llm.registry import table

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    names = docs.columns
    before = docs.collect()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
            assert 0 < len(rows) < len(before) or name == "benchmark_leaks"
            assert {tuple(r) for r in rows} <= {tuple(r) for r in before}
        if name == "exact_copies":
            best = {}
            for r in before:
                best[r.text] = max(best.get(r.text, r.doc_id), r.doc_id)
            assert {r.text: r.doc_id for r in rows} == best and len(rows) == len(best)
        if name == "benchmark_leaks":
            items = [r.text for r in table(spark, FOLDER, "benchmark").collect()]
            assert not any(i in r.text for i in items for r in rows)
            assert {r.doc_id for r in before if not any(i in r.text for i in items)} <= {r.doc_id for r in rows}
        before = rows
    assert {"pass", "shard"} <= set(docs.columns)


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_empty_documents(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
        docs = spark.createDataFrame([], table(spark, FOLDER, "documents").schema)
