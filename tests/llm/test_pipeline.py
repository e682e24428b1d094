"""The corpus pipeline's stages, each on its own input."""

import corpus_pipeline as pipe
from ndspark.llm import mixing, rules, setsketch, toxicity

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    seen = []
    for k, (name, stage) in enumerate(pipe.STAGES):
        before = docs
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append((name, before, docs))
        assert docs.columns == columns or k == len(pipe.STAGES) - 1
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    _, a, b = seen[0]
    assert ids(b) == ids(toxicity.judge(a, labels).where("predicted = 0"))
    _, a, b = seen[1]
    assert ids(b) == ids(rules.judge(a, labels).where("predicted = 1"))
    _, a, b = seen[2]
    assert ids(b) == ids(setsketch.near_duplicates(a, shingle=5).where("kept"))
    _, a, b = seen[3]
    plan = mixing.plan(a).collect()
    assert sum(r.n for r in b.select(mixing.n_words(b["text"]).alias("n")).collect()) == sum(r.taken for r in plan)
    _, a, b = seen[4]
    assert b.count() == a.count() and b.where("n_tokens <> size(ids)").count() == 0


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 1)] * 3 + [(2, "a b c d e f", "en", "s", 1), (None, "x", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id or 0) for r in pipe.drop_near_duplicates(spark, docs, DATA).collect()) == [0, 1]


def test_run(spark):
    assert pipe.run(spark, DATA).count() > 0
