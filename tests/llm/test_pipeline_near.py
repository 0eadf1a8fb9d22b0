"""The near-duplicate stage links at 80 %, op4's default at 85 %."""

import corpus_pipeline
from holdsift.llm import neardup


def test_stage_drops_a_copy_at_82_percent(spark):
    base = [f"w{i}" for i in range(204)]  # 200 shingles; a changed word takes five: 180 of 220 are common
    near = [f"z{i}" if i in (20, 60, 100, 140) else w for i, w in enumerate(base)]
    far = [f"y{i}" if i in (20, 50, 80, 110, 140) else w for i, w in enumerate(base)]  # 175 of 225
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    left = corpus_pipeline.drop_near_duplicates(spark, docs.filter("doc_id < 3"), "")
    assert [r.doc_id for r in left.collect()] == [1]
    assert corpus_pipeline.drop_near_duplicates(spark, docs.filter("doc_id <> 2"), "").count() == 2
    assert neardup.near_duplicates(docs.filter("doc_id < 3")).filter("kept").count() == 2
