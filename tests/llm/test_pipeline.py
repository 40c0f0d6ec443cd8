"""The five stages over the given tables of a thousand documents: what each may and may not do."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegauge.llm.common import stored, table

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
@pytest.mark.filterwarnings("ignore:mixing")
def test_stages(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    seen, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, FOLDER), "test")
        if name != "packing":
            assert out.columns == columns and out.join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
        seen[name] = (docs, out)
        docs = out
    good = labels.where("quality = 1 and toxic = 0").select("doc_id")
    before, after = seen["quality classifier"]
    assert after.join(good, "doc_id").count() >= 0.95 * before.join(good, "doc_id").count() and after.count() < before.count()
    before, after = seen["near-dedup"]
    assert after.count() == after.select("text").distinct().count() and before.select("text").distinct().count() >= after.count()
    before, after = seen["pii"]
    assert after.count() == before.count() and after.where(F.col("text").rlike("[a-z0-9]@[a-z0-9]+[.]com")).count() == 0
    before, after = seen["mixing"]
    kept = after.select("doc_id").distinct().join(good, "doc_id").count()
    assert kept >= 0.99 * before.join(good, "doc_id").count()
    before, pieces = seen["packing"]
    ends = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert ends.where("n <> end or n > 4096").count() == 0
    assert pieces.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
@pytest.mark.filterwarnings("ignore:mixing")
@pytest.mark.parametrize("rows", [0, 60])
def test_stages_on_nulls_and_on_nothing(spark, rows):
    docs = table(spark, FOLDER, "documents").where(F.col("doc_id") < rows)
    odd = [(None, None, None, None, None), (10**9, None, "en", "s", None), (10**9 + 1, "", "en", "s", 0), (10**9 + 2, " ", None, None, 1), (10**9 + 2, " ", None, None, 1)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)) if rows else docs
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "test")
        assert name == "packing" or docs.columns == columns
        assert (docs.count() > 0) == (rows > 0)
