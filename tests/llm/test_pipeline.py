"""Each stage of the pipeline against what its operator says of the same rows."""

import corpus_pipeline
from pyspark.sql import functions as F

from catloom.llm import decontaminate, factorisation, mixing, near_copies
from catloom.llm.common import table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "mix", "tokens"]
    a = stages["quality"](spark, docs, SF).cache()
    scores = factorisation.classify_digest(docs, table(spark, SF, "labels"))
    assert {r[0] for r in a.select("doc_id").collect()} == {r[0] for r in scores.where("predicted = 1").select("doc_id").collect()}
    b = stages["near_duplicates"](spark, a, SF).cache()
    assert {r[0] for r in b.select("doc_id").collect()} == {r[0] for r in near_copies.copy_groups(a).groupBy("root").agg(F.min("doc_id").alias("least")).select("least").collect()}
    c = stages["decontamination"](spark, b, SF).cache()
    bad = {r[0] for r in decontaminate.leaks(b, table(spark, SF, "benchmark")).select("doc_id").collect()}
    assert bad and {r[0] for r in c.select("doc_id").collect()} == {r[0] for r in b.select("doc_id").collect()} - bad
    d = stages["mix"](spark, c, SF).cache()
    taken = mixing.mix_digest(c).agg(F.sum("taken")).first()[0]
    assert d.columns == docs.columns and d.agg(F.sum(mixing.n_words(F.col("text")))).first()[0] == taken
    e = stages["tokens"](spark, d, SF)
    assert e.count() == d.count()


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _n int, score double, fp string, pattern string, pkey string"
    rows = [(1, None, None, None, None, 1, 1.0, "f", "p", "k"), (1, "", "en", "s", 0, 1, 1.0, "f", "p", "k"), (2, "a b " * 9000, "en", "s", 9, 1, 1.0, "f", "p", "k"), (3, "x y z q r s t u v w", "en", None, 9, 1, 1.0, "f", "p", "k"), (3, "x y z q r s t u v w", "en", None, 9, 1, 1.0, "f", "p", "k"), (None, "no id", "en", "s", 5, 1, 1.0, "f", "p", "k")]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= 3 * docs.count()
