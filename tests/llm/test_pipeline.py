"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from holdsift.llm import bpe, linededup, mixing, neardup, toxicity


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "bpe"]
    seen = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], sf).write.parquet(str(tmp_path / f"{i}"))
        seen.append(spark.read.parquet(str(tmp_path / f"{i}")))
    assert all(df.columns == names for df in seen[:-1])
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    judged = toxicity.toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert ids(seen[1]) == ids(judged.filter("predicted = 0"))

    lines = {r.doc_id: r for r in linededup.dedup_lines(seen[1]).collect()}
    left = {r.doc_id: r for r in seen[2].collect()}
    assert set(left) == {d for d, r in lines.items() if r.lines_dropped == 0 or r.text.strip(" \t\n\x0b\x0c\r")}
    assert all(r.text == lines[d].text and r.n_chars == len(r.text) for d, r in left.items())

    kept = neardup.near_duplicates(seen[2]).filter("kept")
    assert ids(seen[3]) == ids(kept)

    counts = {r.doc_id: r.copies for r in mixing.mix_counts(seen[3]).collect()}
    assert ids(seen[4]) == sorted(d for d, n in counts.items() for _ in range(n))

    assert sorted(map(tuple, seen[5].collect())) == sorted(map(tuple, bpe.digests(seen[4]).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, seen[5].collect()))


def test_stages_on_odd_rows(spark, sf):
    """Null and repeated ids, null and empty texts, an extra column with a name the operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int"
    rows = [(1, None, "en", "a", 0, 1), (None, "one two three", "en", None, 3, 1), (2, "", None, "a", 0, 1), (3, "x y z x y z", "de", "b", 5, 1),
            (3, "x y z x y z", "de", "b", 5, 1), (4, "word " * 20_000, "en", "b", 9, 1)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert name == "bpe" or out.columns == docs.columns
        assert name == "mixing" or out.count() == len(rows), name
    empty = spark.createDataFrame([], schema)
    assert all(stage(spark, empty, sf).count() == 0 for _, stage in corpus_pipeline.STAGES)
