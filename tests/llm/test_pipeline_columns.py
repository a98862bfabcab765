"""The pipeline's stages on columns whose names the operators use inside, and without n_chars."""

import corpus_pipeline
from shipwise.llm import tables


def test_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(1, "not in any text at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [(1, text, "en", "a"), (1, text + " token: abcdef123", "en", "b"), (2, text, "en", "c"), (None, text, "en", "d"),
            (3, "a wholly different line of words about ships and weather at sea", "en", None), (4, None, None, "e")]
    cols = ("class_", "root_", "key", "stays", "n_rows", "found", "kept_text", "id", "component_id")
    docs = spark.createDataFrame([r + tuple(f"{c}{i}" for c in cols) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in cols))
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = tables.land(stage(spark, now, str(tmp_path)))
        if name != "byte_bpe":
            assert now.columns == docs.columns
        if name == "ngram_jaccard_join":
            got = sorted((str(r["doc_id"]), r["class_"]) for r in now.collect())
            assert [d for d, _ in got] == ["1", "3", "None"] and ("None", "class_3") in got
    assert now.count() == 3
